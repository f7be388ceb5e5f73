"""N-gram Jaccard self-join with a count-vector R-tree.

A document is the set of its distinct shingles of ``words`` words (three); two
link when ``100 * |A and B| >= percent * |A or B|`` (90).  Shingles are hashed into groups; how
many fall into each group is the document's point, and the overlap of two
documents is at most the sum of the coordinate minima of their points.

1. Equal sets become one class (a hot text is one row from here on).
2. A linking pair differs in at most ``(|A| + |B|) / 19`` shingles (at 90), so
   with one group more than that some group has the same content in both.  Classes
   that share the content of a group are candidates; a star to the smallest
   class of each such block (never its pairs) keeps them connected, and the
   connected sets of candidates hold every link.  Small and large documents
   use group counts that fit their size, and neighbouring size classes meet.
3. Inside each candidate set the points are sorted and packed into R-tree
   leaves of bounded size with their bounding boxes.  Leaf pairs whose boxes
   cannot reach the needed overlap are dropped; so are pairs of points; what
   survives is verified on the whole shingle sets.
4. A task returns a spanning forest of the links it verified and their number
   per class, not the links; union-find over the forests gives components.

Defined cases: a null or blank text has no shingles and links with nothing;
fewer words than a shingle has are one shingle; rows with a null ``doc_id``
link with nothing.  A row is a document: rows that share an id but not a text
link each by its own text, and are in one component only if links join them;
rows that share both are copies of one another.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .leaves import POINTS, point_rows, verified_links
from .shared import drop_tables, ship, write_table
from .textarrays import BLANK_SPLIT, LOWER, hash_strings, mix, raw, slices, split_words

WORDS = 3
PERCENT = 90

_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _size_classes() -> list[int]:
    """Upper ends of the set-size classes, each half as large again."""
    ends = [8]
    while ends[-1] < 1 << 40:
        ends.append(ends[-1] * 3 // 2)
    return ends


SIZE_ENDS = np.array(_size_classes())


def groups_of(size_class: int, percent: int = PERCENT) -> tuple[int, int]:
    """Groups used for pairs whose smaller set is in this class, and how many
    of them the differing shingles of a linking pair can touch."""
    touched = int(SIZE_ENDS[size_class]) * (100 - percent) // percent
    return touched + 1 + (touched + 1) // 8, touched


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = split_words(data, off, BLANK_SPLIT, LOWER)
    code, distinct = w.coded()
    h = hash_strings(distinct)[code] if len(code) else np.zeros(0, np.uint64)
    n = max(0, len(h) - words + 1)
    run = mix(h[:n])
    for k in range(1, words):
        run = mix(run + h[k:k + n] * (_K2 if k % 2 == 0 else _K1))
    for a, b in zip(w.first[:-1], w.first[1:]):
        if b - a >= words:
            yield np.unique(run[a:b - words + 1])
        elif b > a:
            one = mix(h[a:a + 1] * _K3)
            for x in h[a + 1:b]:
                one = mix(one + x)
            yield mix(one * _K2 + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def _sums(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Sum modulo 2**64 of the values of each group (halves summed exactly)."""
    lo = np.bincount(group, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64)
    hi = np.bincount(group, (values >> np.uint64(32)).astype(np.float64), n).astype(np.uint64)
    return lo + (hi << np.uint64(32))


def block_keys(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of the groups by which a set with a link must meet its partner."""
    n = len(s)
    own = int(np.searchsorted(SIZE_ENDS, n))
    least = int(np.searchsorted(SIZE_ENDS, -(-n * percent // 100)))
    out = []
    for c in range(least, own + 1):
        n_groups, touched = groups_of(c, percent)
        m = mix(s + np.uint64((c * int(_K3)) & 0xFFFFFFFFFFFFFFFF))
        group = ((m >> np.uint64(32)) % np.uint64(n_groups)).astype(np.int64)
        count = np.bincount(group, minlength=n_groups)
        content = _sums(mix(m ^ _K1), group, n_groups)
        key = mix(content + mix(np.arange(n_groups, dtype=np.uint64) * _K2 + np.uint64(c)))
        # A pair touches no more of this set's groups than this, so of one more
        # the fullest some group is equal in both.  Equal contents have equal
        # counts: the set that leaves out more groups keeps none the other lacks.
        most = min(touched, n * (100 - percent) // percent)
        out.append(key[count >= np.sort(count)[n_groups - 1 - most]])
    return np.concatenate(out)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, pa.int64())


def _sketch(words: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            size, one, two, keys = [], [], [], []
            for s in shingle_sets(*raw(b.column(1)), words):
                size.append(len(s))
                one.append(int(mix(s).sum(dtype=np.uint64)))
                two.append(int(mix(s ^ _K2).sum(dtype=np.uint64)))
                keys.append(block_keys(s, percent) if len(s) else s)
            at = np.zeros(len(keys) + 1, np.int32)
            np.cumsum([len(k) for k in keys], out=at[1:])
            flat = _long(np.concatenate(keys))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(size, pa.int64()), _long(np.array(one, np.uint64)),
                 _long(np.array(two, np.uint64)), pa.ListArray.from_arrays(pa.array(at), flat)],
                ["doc_id", "t", "n_shingles", "h1", "h2", "keys"])

    return run


def _points(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield point_rows(b.column(0), b.column(1), b.column(2), list(shingle_sets(*raw(b.column(3)), words)))

    return run


def _linked(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """``(doc_id, t, n_shingles, component_id, n_links, first)``, a row per row
    of ``docs``: ``t`` is the hash of its text, ``first`` tells whether it is
    the smallest (id, ``t``) of its component."""
    ship(docs.sparkSession)
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), _text_hash(text).alias("t"))
    sketch = write_table(src.mapInArrow(
        _sketch(words, percent), "doc_id long, t long, n_shingles long, h1 long, h2 long, keys array<long>"), "sketch")
    ids = sketch.select("doc_id", "t", "n_shingles", "h1", "h2")
    full = ids.where("n_shingles > 0 and doc_id is not null")
    by = ["n_shingles", "h1", "h2"]
    # written first: a join of two tables can be split where one set has many copies
    classes = write_table(full.groupBy(*by).agg(F.min(F.struct("doc_id", "t")).alias("low"), F.count("*").alias("weight"))
                          .select(*by, F.col("low.doc_id").alias("doc_id"), F.col("low.t").alias("t"), "weight"), "classes")
    # A class goes by its smallest id; where an id stands for several, all but one need another name.
    twice = write_table(classes.groupBy("doc_id").agg(F.min("t").alias("one"), F.max("t").alias("other"))
                        .where("one < other").select("doc_id", "one"), "shared-ids")

    def named(df: DataFrame) -> DataFrame:
        return df.join(twice, "doc_id", "left").withColumn(
            "node", F.when(F.col("t") > F.col("one"), F.xxhash64("doc_id", "t")).otherwise(F.col("doc_id"))).drop("one")

    known = F.col("doc_id").isNotNull()
    low = named(classes).select(*by, "node", "weight", F.col("doc_id").alias("low"), F.col("t").alias("low_t"))
    member = write_table(ids.join(low, by, "left").select(
        "doc_id", "t", "n_shingles", *[F.when(known, F.col(c)).alias(c) for c in ("node", "weight", "low", "low_t")]), "member")

    # Blocks: group contents shared by several classes, as stars.  The keys of a
    # class are written as one list: dealt to the copies and, one by one, to
    # their blocks in one query, both shuffles would stay until it ends.
    copies = member.where("doc_id <> low or t <> low_t").select("doc_id", "t")
    blocks = write_table(named(sketch.where("n_shingles > 0 and doc_id is not null").join(copies, ["doc_id", "t"], "left_anti"))
                         .select("node", "keys"), "blocks")
    drop_tables(sketch)
    keys = blocks.select(F.explode("keys").alias("key"), "node")
    # The shared keys are few; written, they free the shuffle that found them.
    shared = write_table(keys.groupBy("key").agg(F.min("node").alias("src"), F.max("node").alias("top"))
                         .where("src < top").select("key", "src"), "shared-keys")
    # merged at every size: a broadcast that only small inputs get would hide what it costs
    stars = keys.join(shared.hint("merge"), "key").where("node <> src").select("src", F.col("node").alias("dst")).distinct()
    starred = components(stars)
    cand = write_table(starred, "candidates")
    drop_tables(starred, blocks, shared)

    # Points of the candidates, and their links over R-tree leaves.
    named_classes = named(classes).select("node", "weight", F.col("doc_id").alias("low"), F.col("t").alias("low_t"))
    wanted = cand.join(named_classes, "node").select(F.col("component").alias("cluster"), "node", "weight", "low", "low_t")
    points = (src.where("doc_id is not null").join(wanted, (src.doc_id == wanted.low) & (src.t == wanted.low_t))
              .select("cluster", "node", "weight", "text").mapInArrow(_points(words), POINTS))
    points = write_table(points, "points")
    drop_tables(cand)
    links = verified_links(points.dropDuplicates(["node", "body"]), percent)
    drop_tables(points)

    linked = components(links)
    comp = write_table(linked.join(named_classes.drop("weight"), "node"), "components")
    drop_tables(linked, classes, twice)
    least = comp.groupBy("component").agg(F.min(F.struct("low", "low_t")).alias("least"))
    comp = comp.join(least, "component").select("node", "least")
    per_class = links.groupBy(F.col("src").alias("node")).agg(F.sum("links").alias("links"))
    least = F.coalesce(F.col("least"), F.struct("low", "low_t"))
    return (member.join(comp, "node", "left").join(per_class, "node", "left")
            .select("doc_id", "t", "n_shingles", F.coalesce(least["low"], "doc_id").alias("component_id"),
                    (F.coalesce("weight", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                    F.coalesce((least["low"] == F.col("doc_id")) & (least["low_t"] == F.col("t")), F.lit(True)).alias("first")))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
         percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)``, a row per document.

    ``component_id`` is the smallest id reachable by links, ``n_links`` the
    number of other rows the document links to (rows with the same set too).
    """
    return _linked(docs, id_col, text_col, words, percent).drop("t", "first")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                percent: int = PERCENT) -> DataFrame:
    """``docs`` with the row of smallest id of each component, by text hash
    where rows share that id.  Rows that share id and text stay or go together;
    rows with a null id or no words stay."""
    gone = (_linked(docs, id_col, text_col, words, percent).where(~F.col("first"))
            .select(F.col("doc_id").alias("_gone_id"), F.col("t").alias("_gone_t")).distinct())
    same = (docs[id_col] == gone["_gone_id"]) & (_text_hash(docs[text_col].cast("string")) == gone["_gone_t"])
    return docs.join(gone, same, "left_anti")
