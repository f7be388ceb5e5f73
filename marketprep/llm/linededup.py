"""Fuzzy line deduplication by MinHash.

Lines are compared as sets of seven-character shingles; two lines are near
copies at a Jaccard similarity of 0.8 or more.

1. Equal lines are one line from the start (by a 64-bit hash of the line, so
   at 10**12 distinct lines about one in 10**7 would meet a wrong partner).
2. Each distinct line has a one-permutation MinHash signature with empty bins
   filled by optimal densification; 14 bands of 5 values give each line 14
   bucket keys (0.996 of the pairs at exactly 0.8 share one, more above).
3. Rows are sorted by bucket, streamed and chained from line to line; all pairs
   of a bucket are never listed.  The chained pairs are verified exactly; the lines of buckets
   in which one fails, and which other buckets don't bring into one component,
   are verified in full over bounded leaves.
4. Union-find over the verified links; of each component the first line (by
   ``doc_id``, then line number, then text) stays.

Defined cases: lines without a word always stay; a line of fewer than seven
characters is its own only shingle; a null text has no lines; a document is
named by its id and the hash of its text, so rows that share an id (or have
none) but not the text are documents of their own, and rows alike in both are
one; a null id comes first.  Other columns of the input stay as they are,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .leaves import POINTS, point_rows, verified_links
from .shared import drop_tables, of_table, ship, write_table
from .textarrays import BLANK_SPLIT, byte_strings, hash_strings, mix, raw, slices

SHINGLE = 7
PERCENT = 80
BANDS = 14
ROWS = 5
BINS = BANDS * ROWS

_EMPTY = np.uint32(0xFFFFFFFF)
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_TRIES = 400


def split_lines(data: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lines with a word: their bytes, their text and their number in it."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return pa.array([], pa.binary()), none, none
    brk = data == 10
    begin = np.unique(np.concatenate([off[:-1][np.diff(off) > 0], np.flatnonzero(brk) + 1]))
    begin = begin[begin < len(data)]
    # a text that ends in a line break may leave its empty last line out: it has no word
    full = np.logical_or.reduceat(BLANK_SPLIT[data], begin)
    at = np.flatnonzero(brk)
    before = np.searchsorted(at, begin)
    owner = np.searchsorted(off, begin, "right") - 1
    number = before - np.searchsorted(at, off[owner])
    lines = byte_strings(data[~brk], np.append(begin - before, len(data) - len(at)))
    return lines.filter(pa.array(full)), owner[full], number[full]


def line_shingles(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the lines, and which line each is of (sorted)."""
    data, off = raw(lines)
    cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    at = off - np.searchsorted(np.flatnonzero((data & 0xC0) == 0x80), off)   # in characters
    n = np.diff(at)
    if len(cp) >= SHINGLE:
        h = cp[:-1] * _K1 + cp[1:]                           # 2 characters
        h = h[:-2] * _K2 + h[2:]                             # 4
        h = h[:-3] * _K3 + h[3:]                             # 7, the middle one twice
        inside = np.ones(len(cp), bool)
        for k in range(1, SHINGLE):                          # those that reach into the next line
            inside[at[1:][n >= k] - k] = False
        h = mix(h[inside[:len(h)]])
        owner = np.repeat(np.arange(len(n)), np.maximum(n - SHINGLE + 1, 0))
    else:
        h, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero(n < SHINGLE)
    if len(short):
        h = np.concatenate([h, hash_strings(lines.take(pa.array(short)))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        h, owner = h[order], owner[order]
    return h, owner


def shingle_sets(lines: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each line."""
    h, owner = line_shingles(lines)
    cut = np.searchsorted(owner, np.arange(len(lines) + 1))
    return [np.unique(h[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def _detours() -> np.ndarray:
    """Where an empty bin looks, try by try (the same for every line)."""
    t = np.arange(_TRIES * BINS, dtype=np.uint64)
    return (mix(t + _K1) % np.uint64(BINS)).astype(np.int64).reshape(_TRIES, BINS)


def signatures(lines: pa.Array) -> np.ndarray:
    """One-permutation MinHash of each line, ``[line, bin]``."""
    h, owner = line_shingles(lines)
    sig = np.full(len(lines) * BINS, _EMPTY, np.uint32)
    bin_ = ((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    np.minimum.at(sig, owner * BINS + bin_.astype(np.int64), (h & np.uint64(0xFFFFFFFE)).astype(np.uint32))
    sig = sig.reshape(-1, BINS)
    row, col = np.nonzero(sig == _EMPTY)
    filled, tries = sig.copy(), _detours()
    for t in range(_TRIES):
        if not len(row):
            break
        got = sig[row, tries[t, col]]
        filled[row, col] = got
        open_ = got == _EMPTY
        row, col = row[open_], col[open_]
    if len(row):                                             # all but certain never to be needed
        filled[row, col] = sig[row].min(1)
    return filled


def band_keys(lines: pa.Array) -> np.ndarray:
    """Bucket keys, ``[line, band]``."""
    sig = signatures(lines).reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + _K2), sig.shape[:2])
    for k in range(ROWS):
        key = mix(key * _K1 + sig[:, :, k])
    return key


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64), pa.int64())


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        lines, owner, number = split_lines(*raw(b.column(1)))
        d = lines.dictionary_encode()
        h = hash_strings(d.dictionary)[d.indices.to_numpy(zero_copy_only=False)] if len(lines) else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [_long(h), b.column(0).take(pa.array(owner)), pa.array(number, pa.int64()), b.column(2).take(pa.array(owner))],
            ["h", "doc_id", "line", "t"])


# Text bytes whose signatures a task finds at a time: some 50 times as much memory.
SIGNED_BYTES = 1 << 20


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, limit=SIGNED_BYTES):
        lines, _, _ = split_lines(*raw(b.column(0)))
        distinct = lines.dictionary_encode().dictionary
        if len(distinct):
            yield pa.RecordBatch.from_arrays(
                [_long(band_keys(distinct).ravel()), _long(np.repeat(hash_strings(distinct), BANDS))], ["key", "h"])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, h) rows sorted by key -> pairs of distinct lines that connect each
    bucket.  What a batch holds of a bucket is sorted; the last row of a batch
    ties the bucket to the next."""
    last_k, last_h = None, None
    for b in batches:
        k, h = b.column(0).to_numpy(), b.column(1).to_numpy()
        if not len(k):
            continue
        if last_k is not None:
            k, h = np.append(last_k, k), np.append(last_h, h)
        last_k, last_h = k[-1], h[-1]
        shared = np.zeros(len(k), bool)
        shared[1:] = k[1:] == k[:-1]
        shared[:-1] |= shared[1:]
        k, h = k[shared], h[shared]
        order = np.lexsort((h, k))
        k, h = k[order], h[order]
        same = np.flatnonzero((k[1:] == k[:-1]) & (h[1:] != h[:-1]))
        if len(same):
            yield pa.RecordBatch.from_arrays([pa.array(k[same]), pa.array(h[same]), pa.array(h[same + 1])],
                                             ["key", "a", "b"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wanted lines by hash and number) -> (h, line)."""
    for b in slices(batches):
        h, line = [], []
        for r in b.to_pylist():
            parts = r["text"].split("\n")
            for w in r["want"]:
                h.append(w["h"])
                line.append(parts[w["line"]])
        yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(line, pa.string())], ["h", "body"])


def similar(x: pa.Array, y: pa.Array) -> np.ndarray:
    """Whether each line of ``x`` and the same one of ``y`` are near copies, by
    their sets of shingles, all pairs together.  A shingle is one number: its
    pair above, and below it what bits of its hash the number of pairs leaves."""
    bits = np.uint64(max(1, len(x).bit_length()))

    def distinct(lines: pa.Array) -> np.ndarray:
        h, owner = line_shingles(lines)
        return _sorted_distinct((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (h >> bits))

    a, b = distinct(x), distinct(y)
    all_ = np.concatenate([a, b])
    all_.sort()
    both = all_[1:][all_[1:] == all_[:-1]]

    def per_pair(keys: np.ndarray) -> np.ndarray:
        first = np.arange(len(x) + 1, dtype=np.uint64)
        owner = keys >> (np.uint64(64) - bits)
        return np.diff(np.searchsorted(owner, first))

    common = per_pair(both)
    return 100 * common >= PERCENT * (per_pair(a) + per_pair(b) - common)


def _sorted_distinct(keys: np.ndarray) -> np.ndarray:
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]


# Bytes of line pairs that are compared at a time (or one pair).
COMPARE_BYTES = 1 << 20


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for big in batches:
        seen = pc.and_(big.column(2).is_valid(), big.column(3).is_valid()).to_numpy(zero_copy_only=False)
        size = np.cumsum(sum(pc.fill_null(pc.binary_length(big.column(k)), 0).to_numpy(zero_copy_only=False) for k in (2, 3)))
        lo = 0
        while lo < big.num_rows:
            done = size[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(size, done + COMPARE_BYTES, "right")))
            b = big.slice(lo, hi - lo)
            ok = similar(b.column(2).fill_null(""), b.column(3).fill_null("")) & seen[lo:hi]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], ["a", "b", "ok"])
            lo = hi


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "body"):
        yield point_rows(b.column(0), b.column(1), pa.array(np.ones(b.num_rows, np.int64)), shingle_sets(b.column(2)))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(places, removed)``: the lines with a word ``(h, doc_id, t, line)`` and
    those of them that go, ``(doc_id, t, line)``; ``t`` is ``xxhash64`` of the text.
    Both are tables that the caller may drop."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # A row is named by its id and the hash of its text, without an id by the hash alone.
    rows = src.withColumn("t", F.xxhash64("text"))
    places = write_table(rows.mapInArrow(_places, "h long, doc_id long, line long, t long"), "places")
    chain = write_table(src.select("text").mapInArrow(_buckets, "key long, h long")
                        .repartition("key").sortWithinPartitions("key")     # one long: a radix sort
                        .mapInArrow(_chain, "key long, a long, b long"), "chain")

    # Texts of the chained lines, each from one row it stands in.
    pairs = chain.select("a", "b").distinct()
    lines = chain.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    row = F.coalesce("doc_id", "t").alias("row")
    known = places.select("h", row, "t", "line").join(lines, "h").groupBy("h").agg(
        F.min(F.struct("row", "t", "line")).alias("at"))
    want = known.groupBy(F.col("at.row").alias("row"), F.col("at.t").alias("t")).agg(
        F.collect_list(F.struct("h", F.col("at.line").alias("line"))).alias("want"))
    # copies of a text without an id are one row before they meet in a task
    named = rows.where("doc_id is not null").select(row, "t", "text").unionByName(
        rows.where("doc_id is null").groupBy("t").agg(F.first("text").alias("text")).select(
            F.col("t").alias("row"), "t", "text"))
    bodies = write_table(named.join(want, ["row", "t"]).dropDuplicates(["row", "t"])
                         .select("text", "want").mapInArrow(_texts, "h long, body string"), "bodies")

    # Exact check of the chained pairs; one without a verdict is a broken one.
    one = bodies.select(F.col("h").alias("a"), F.col("body").alias("body_a"))
    two = bodies.select(F.col("h").alias("b"), F.col("body").alias("body_b"))
    checked = write_table(pairs.join(one, "a", "left").join(two, "b", "left").select("a", "b", "body_a", "body_b")
                          .mapInArrow(_compare, "a long, b long, ok boolean"), "checked")

    # What the chains verified, as components of their own.
    ok = checked.where("ok").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    chained = components(ok)
    label = write_table(chained.select(F.col("node").alias("h"), "component"), "labels")
    drop_tables(chained)

    # Buckets where a chain broke and whose lines are still in several
    # components: their lines, as far as buckets connect them, against each
    # other, each line in one cluster.  Two lines that failed need no second look.
    broken = chain.join(checked.where("not ok").select("a", "b"), ["a", "b"]).select("key").distinct()
    still = write_table(chain.join(broken, "key"), "open")
    drop_tables(chain, checked)
    several = (still.select("key", F.explode(F.array("a", "b")).alias("h")).distinct().join(label, "h", "left")
               .groupBy("key").agg(F.count("*").alias("n"), F.min(F.coalesce("component", "h")).alias("lo"),
                                   F.max(F.coalesce("component", "h")).alias("hi"))
               .where("n > 2 and lo < hi").select("key"))
    cluster = components(still.join(several, "key").select("a", "b").distinct(), "a", "b")
    drop_tables(still)
    inside = cluster.join(bodies, F.col("node") == F.col("h")).select(F.col("component").alias("cluster"), "h", "body")
    points = write_table(inside.mapInArrow(_points, POINTS), "points")
    drop_tables(cluster, bodies)
    more = verified_links(points, PERCENT)
    drop_tables(points)

    comp = components(label.select(F.col("h").alias("src"), F.col("component").alias("dst"))
                      .unionByName(more.select("src", "dst")))
    drop_tables(label, more)
    place = F.struct("doc_id", "line", "t")
    group = places.select("doc_id", "line", "t", F.col("h")).join(
        comp.select(F.col("node").alias("h"), "component"), "h", "left") \
        .select("doc_id", "line", "t", F.coalesce("component", "h").alias("g"))
    # One line of each group stays: its smallest place.
    group = write_table(group, "group")
    drop_tables(comp)
    first = write_table(group.groupBy("g").agg(F.min(place).alias("first"), F.count("*").alias("n"))
                        .where("n > 1").select("g", "first"), "first")
    removed = write_table(group.join(first, "g").where(~place.eqNullSafe(F.col("first")))
                          .select("doc_id", "t", "line").distinct(), "removed")
    drop_tables(group, first)
    return of_table(places.select("h", "doc_id", "t", "line"), places), removed


def _per_doc(removed: DataFrame, name: str) -> DataFrame:
    """Removed line numbers of each document in a column ``name``."""
    return removed.groupBy(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).agg(
        F.sort_array(F.collect_list("line")).alias(name))


def _of(left_id: Column, left_text: Column, right: DataFrame) -> Column:
    """Rows of the same document."""
    return left_id.cast("long").eqNullSafe(right["_id"]) & (F.xxhash64(left_text.cast("string")) == right["_t"])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``n_lines`` (with a word), ``n_removed``, and
    ``removed_lines`` (their numbers from 0, comma-joined)."""
    places, removed = near_copies(docs, id_col, text_col)
    gone = _per_doc(removed, "gone")
    count = places.distinct().groupBy(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).agg(F.count("*").alias("n_lines"))
    per = count.join(gone, count["_id"].eqNullSafe(gone["_id"]) & (count["_t"] == gone["_t"]), "left").select(
        count["_id"], count["_t"], "n_lines", "gone")
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("t"))
    out = ids.join(per, ids["doc_id"].eqNullSafe(per["_id"]) & (ids["t"] == per["_t"]), "left")
    return out.select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce(F.array_join(F.col("gone").cast("array<string>"), ","), F.lit("")).alias("removed_lines"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed lines cut out of their texts, all other
    columns as they were.  A document that loses its last line with a word
    goes; one that never had such a line stays."""
    places, removed = near_copies(docs, id_col, text_col)
    drop_tables(places)
    name = "gone"
    while name in docs.columns:
        name += "_"
    gone = _per_doc(removed, name)
    kept = F.filter(F.split(docs[text_col], "\n", -1), lambda x, i: ~F.array_contains(gone[name], i.cast("long")))
    cut = docs.join(gone, _of(docs[id_col], docs[text_col], gone), "left")
    new = F.when(gone[name].isNull(), docs[text_col]).otherwise(F.array_join(kept, "\n"))
    left = cut.select(*(new.alias(c) if c == text_col else docs[c] for c in docs.columns), gone[name].isNotNull().alias(name))
    return left.where(~F.col(name) | F.col(text_col).rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)
