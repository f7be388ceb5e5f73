"""Benchmark decontamination with a distributed positional inverted index.

The index is a table in the shared folder: one row per segment and term with
the term's postings in that segment.  A segment is a bounded run of documents,
so no term's list grows with the corpus: a frequent word has one short list
per segment, and each segment is searched where its rows are.  A search reads
only the rows of the terms it asks for, starts every phrase from its rarest
term in the segment, and intersects the other terms' lists after shifting them
by their offset in the phrase (exact) or by nearest position (proximity).

Test items are turned into phrases in blocks of bounded size; each block is
searched over the whole index, so any number of items can be asked for.

Defined cases: a null text has no words; an item without words has no phrase
and never occurs; an item of fewer words than the window is one phrase;
repeated rows are documents of their own; an empty benchmark or corpus gives
no hits.  Other columns of both tables are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship, write_table
from .textarrays import ALNUM_SPLIT, LOWER, byte_strings, raw, slices, split_words

WINDOW = 10
SEGMENT_BYTES = 6 << 20
# Items whose phrases are searched together: bounds what a task is sent.
BLOCK_ITEMS = 2_000
# Stands for the id of items that have none: they count as one item and their
# passages as hits, but they add nothing to the list of ids.
NO_ID = -(1 << 63)
# Up to so many asked terms are sent to every task; more are joined by shuffle.
SENT_TERMS = 200_000
# Candidate positions a task holds at once.
CANDIDATES = 1 << 20


def pack(deltas: np.ndarray, off: np.ndarray) -> pa.Array:
    """Lists of non-negative numbers as variable-length bytes (seven bits a
    byte, the high bit says that more follow)."""
    size = np.ones(len(deltas), np.int64)
    for k in range(1, 5):
        size += deltas >= 1 << (7 * k)
    at = np.zeros(len(deltas) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    out = np.zeros(at[-1], np.uint8)
    for k in range(5):
        has = np.flatnonzero(size > k)
        if not len(has):
            break
        part = (deltas[has] >> (7 * k)) & 0x7F
        out[at[has] + k] = part | np.where(size[has] > k + 1, 0x80, 0)
    return byte_strings(out, at[off])


def unpack(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of packed lists, and how many each list has."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(off) - 1, np.int64)
    last = data < 0x80
    begin = np.append(0, np.flatnonzero(last)[:-1] + 1)
    nth = np.arange(len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data))))
    value = np.add.reduceat((data & 0x7F).astype(np.int64) << (7 * nth), begin)
    ends = np.zeros(len(data) + 1, np.int64)
    np.cumsum(last, out=ends[1:])
    return value, np.diff(ends[off])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write the index of ``docs`` to the shared folder and return it.

    ``(segment, term, n, postings, ids, sizes)``: a term's row has its number
    of places and the packed gaps between their positions in the segment; the
    row with a null term lists the segment's documents and their word counts.
    Positions run on through a segment with one free place after each document.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        names = ["segment", "term", "n", "postings", "ids", "sizes"]
        for b in slices(batches, "text", segment_bytes):
            w = split_words(*raw(b.column(1)), ALNUM_SPLIT, LOWER)
            size = np.diff(w.first)
            pos = np.arange(len(w)) + w.text_of()
            code, distinct = w.coded()
            key = np.sort((code.astype(np.int64) << 32) | pos)
            code, pos = key >> 32, key & 0xFFFFFFFF
            begin = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(key) else np.zeros(0, np.int64)
            gap = np.diff(pos, prepend=0)
            gap[begin] = pos[begin]
            off = np.append(begin, len(key))
            terms = distinct.cast(pa.string())
            n = len(terms)
            segment = (part << 32) | seq
            seq += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int64()), pa.nulls(1, pa.string()), pa.array([b.num_rows], pa.int64()),
                 pa.nulls(1, pa.binary()), pa.array([b.column(0).to_pylist()], pa.list_(pa.int64())),
                 pa.array([size.tolist()], pa.list_(pa.int64()))], names)
            for lo in range(0, n, 1 << 15):
                hi = min(n, lo + (1 << 15))
                m = hi - lo
                cut = off[lo:hi + 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, segment)), terms[lo:hi], pa.array(np.diff(cut)),
                     pack(gap[cut[0]:cut[-1]], cut - cut[0]), pa.nulls(m, pa.list_(pa.int64())),
                     pa.nulls(m, pa.list_(pa.int64()))], names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return write_table(src.mapInArrow(run, "segment long, term string, n long, postings binary, "
                                           "ids array<long>, sizes array<long>"), "index")


def words_of(text: str | None) -> list[str]:
    """Words of one (test) text, as the index has them."""
    w = split_words(*raw(pa.array([text or ""])), ALNUM_SPLIT, LOWER)
    return [x.decode() for x in byte_strings(w.body, w.off).to_pylist()]


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases of a block of items, and which item has which."""

    terms: list[str]
    words: np.ndarray      # [phrase, k]: index of its k-th term, -1 past its end
    phrase: np.ndarray     # (phrase, item) pairs
    item: np.ndarray


def phrases(items: list[tuple[int, str | None]], window: int = WINDOW) -> Phrases:
    """Windows of ``window`` consecutive words of each item; a shorter item is
    one window."""
    term: dict[str, int] = {}
    seen: dict[tuple[int, ...], int] = {}
    pairs: set[tuple[int, int]] = set()
    for item, text in items:
        w = [term.setdefault(x, len(term)) for x in words_of(text)]
        if w:
            for i in range(max(1, len(w) - window + 1)):
                pairs.add((seen.setdefault(tuple(w[i:i + window]), len(seen)), item))
    table = np.full((len(seen), window), -1, np.int64)
    for p, i in seen.items():
        table[i, :len(p)] = p
    pair = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return Phrases(list(term), table, pair[:, 0], pair[:, 1])


class Segment:
    """Postings of the asked terms in one segment."""

    def __init__(self, n_terms: int, term: np.ndarray, data: np.ndarray, off: np.ndarray) -> None:
        gaps, count = unpack(data, off)
        begin = np.cumsum(count) - count
        total = np.cumsum(gaps)
        pos = total - np.repeat(total[begin] - gaps[begin], count) if len(gaps) else gaps
        order = np.argsort(term, kind="stable")
        self.count = np.zeros(n_terms, np.int64)
        self.count[term] = count
        self.begin = np.cumsum(self.count) - self.count
        keys = (np.repeat(term, count) << 32) | pos
        self.keys = np.sort(keys) if len(order) and (np.diff(term) < 0).any() else keys

    def places(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of each of the terms, one after another, and which of the
        given terms each belongs to."""
        n = self.count[terms]
        which = np.repeat(np.arange(len(terms)), n)
        at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.begin[terms], n)
        return self.keys[at] & 0xFFFFFFFF, which

    def stands(self, terms: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Whether each term stands at that position."""
        want = (terms << 32) | np.maximum(pos, 0)
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return (self.keys[at] == want) & (pos >= 0)

    def near(self, terms: np.ndarray, pos: np.ndarray, reach: int) -> np.ndarray:
        """Whether each term stands within ``reach`` positions."""
        at = np.searchsorted(self.keys, (terms << 32) | np.maximum(pos - reach, 0))
        ok = at < len(self.keys)
        key = self.keys[np.minimum(at, len(self.keys) - 1)]
        return ok & ((key >> 32) == terms) & ((key & 0xFFFFFFFF) <= pos + reach)


def find(seg: Segment, words: np.ndarray, slop: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(phrase, position)`` of all matches in the segment.

    Exact (``slop`` None): the phrase stands at the position, its first word
    there.  Proximity: the phrase's rarest term stands at the position and
    every other one within ``slop`` positions of it.
    """
    got_p, got_at = [], []
    if not len(seg.keys) or not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = np.where(words >= 0, seg.count[words], np.iinfo(np.int64).max)
    alive = np.flatnonzero((n > 0).all(1))                 # all their terms occur here
    if not len(alive):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(n[alive], 1, kind="stable")         # offsets from the rarest term on
    load = np.cumsum(n[alive, order[:, 0]])
    block = load // CANDIDATES
    for k in np.unique(block):
        sel = np.flatnonzero(block == k)
        ph, od = alive[sel], order[sel]
        pos, which = seg.places(words[ph, od[:, 0]])
        if slop is None:
            pos = pos - od[which, 0]                       # where the phrase would begin
        for step in range(1, words.shape[1]):
            off = od[which, step]
            term = words[ph[which], off]
            real = term >= 0
            ok = np.ones(len(pos), bool)
            if slop is None:
                ok[real] = seg.stands(term[real], pos[real] + off[real])
            else:
                ok[real] = seg.near(term[real], pos[real], slop)
            pos, which = pos[ok], which[ok]
            if not len(pos):
                break
        keep = pos >= 0
        got_p.append(ph[which[keep]])
        got_at.append(pos[keep])
    return np.concatenate(got_p), np.concatenate(got_at)


def _blocks(items: DataFrame, id_col: str, text_col: str, block_items: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded number, each from a query of its own."""
    src = items.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("i"), F.col(text_col).cast("string").alias("t")) \
        .where("t is not null")
    n = -(-src.count() // block_items)
    share = F.pmod(F.xxhash64("i", "t"), F.lit(max(1, n)))
    for k in range(n):
        yield [(r["i"], r["t"]) for r in src.where(share == k).collect()]


def _segments(index: DataFrame, q: Phrases) -> DataFrame:
    """Rows of the asked terms, with their number, and the document rows."""
    spark = index.sparkSession
    asked = spark.createDataFrame(pa.table({"term": pa.array(q.terms, pa.string()),
                                            "t": pa.array(range(len(q.terms)), pa.int64())}))
    if len(q.terms) <= SENT_TERMS:
        asked = F.broadcast(asked)
    docs = index.where("term is null").select("segment", F.lit(-1).cast("long").alias("t"), "n", "postings",
                                              "ids", "sizes")
    rows = index.join(asked, "term").select("segment", "t", "n", "postings", "ids", "sizes")
    return docs.unionByName(rows)


def _open(group: pa.Table, n_terms: int) -> tuple[Segment, list, np.ndarray, np.ndarray]:
    group = group.combine_chunks()
    t = group.column("t").to_numpy()
    is_docs = t < 0
    head = group.filter(pa.array(is_docs)).slice(0, 1)
    rows = group.filter(pa.array(~is_docs)).sort_by("t")
    data, off = raw(rows.column("postings"))
    seg = Segment(n_terms, rows.column("t").to_numpy().astype(np.int64), data, off)
    ids = head.column("ids").to_pylist()[0]
    size = np.array(head.column("sizes").to_pylist()[0], np.int64)
    base = np.cumsum(size + 1) - (size + 1)
    return seg, ids, size, base


def _matcher(q: Phrases, slop: int | None) -> Callable[[pa.Table], pa.Table]:
    """All matches of one segment."""
    def run(group: pa.Table) -> pa.Table:
        seg, ids, size, base = _open(group, len(q.terms))
        p, at = find(seg, q.words, slop)
        doc = np.searchsorted(base, at, "right") - 1
        length = (q.words >= 0).sum(1)
        if slop is not None and len(p):
            # positions near a document's edge may have met the next one's words
            ok = np.ones(len(p), bool)
            for k in range(len(p)):
                lo, hi = base[doc[k]], base[doc[k]] + size[doc[k]] - 1
                for t in q.words[p[k]][q.words[p[k]] >= 0]:
                    a = max(at[k] - slop, lo)
                    i = np.searchsorted(seg.keys, (t << 32) | a)
                    ok[k] &= bool(i < len(seg.keys) and seg.keys[i] <= (t << 32) | min(at[k] + slop, hi))
            p, at, doc = p[ok], at[ok], doc[ok]
        lo, hi = np.searchsorted(q.phrase, p), np.searchsorted(q.phrase, p, "right")
        times = hi - lo
        pair = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo, times)
        rep = np.repeat(np.arange(len(p)), times)
        first = (at - base[doc])[rep]
        return pa.table({
            "doc_id": pa.array([ids[d] for d in doc[rep]], pa.int64()),
            "item_id": pa.array(q.item[pair], pa.int64()), "first_word": pa.array(first, pa.int64()),
            "last_word": pa.array(first + (length[p][rep] - 1 if slop is None else 0), pa.int64())})

    return run


def search(index: DataFrame, items: DataFrame, item_id: str = "item_id", text_col: str = "text",
           window: int = WINDOW, slop: int | None = None, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Every match: ``(doc_id, item_id, first_word, last_word)``.

    Exact phrases by default, with the span of words; with ``slop`` proximity
    matches: the position of the phrase's rarest term, for which all other
    terms stand within ``slop`` words in the same document.  The same item can
    match a place by several of its windows, each gives a row.  An item without
    an id gives rows without one.
    """
    ship(index.sparkSession)
    schema = "doc_id long, item_id long, first_word long, last_word long"
    parts = []
    for block in _blocks(items, item_id, text_col, block_items):
        q = phrases(block, window)
        parts.append(_segments(index, q).groupBy("segment").applyInArrow(_matcher(q, slop), schema))
    if not parts:
        return index.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.withColumn("item_id", F.nullif("item_id", F.lit(NO_ID)))


def _counter(q: Phrases) -> Callable[[pa.Table], pa.Table]:
    """Hit words and found items of each document of one segment."""
    def run(group: pa.Table) -> pa.Table:
        segment = group.column("segment")[0].as_py()
        seg, ids, size, base = _open(group, len(q.terms))
        p, at = find(seg, q.words)
        doc = np.searchsorted(base, at, "right") - 1
        length = (q.words >= 0).sum(1)
        hits: list[list[int]] = [[] for _ in ids]
        found: list[list[int]] = [[] for _ in ids]
        for d in np.unique(doc):
            mine = doc == d
            edge = np.zeros(size[d] + 1, np.int64)
            np.add.at(edge, at[mine] - base[d], 1)
            np.add.at(edge, at[mine] - base[d] + length[p[mine]], -1)
            hits[d] = np.flatnonzero(np.cumsum(edge) > 0).tolist()
            lo, hi = np.searchsorted(q.phrase, p[mine]), np.searchsorted(q.phrase, p[mine], "right")
            found[d] = sorted({int(x) for a, b in zip(lo, hi) for x in q.item[a:b]})
        n = len(ids)
        return pa.table({
            "segment": pa.array([segment] * n, pa.int64()), "ord": pa.array(range(n), pa.int64()),
            "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(size, pa.int64()),
            "hits": pa.array(hits, pa.list_(pa.int64())), "items": pa.array(found, pa.list_(pa.int64()))})

    return run


def contamination(index: DataFrame, items: DataFrame, item_id: str = "item_id", text_col: str = "text",
                  window: int = WINDOW, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document of the index: ``(doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated)``; a word inside any occurrence of a phrase is
    hit, an item counts when one of its phrases occurs."""
    ship(index.sparkSession)
    schema = "segment long, ord long, doc_id long, n_words long, hits array<long>, items array<long>"
    parts = []
    for block in _blocks(items, item_id, text_col, block_items):
        q = phrases(block, window)
        parts.append(_segments(index, q).groupBy("segment").applyInArrow(_counter(q), schema))
    if not parts:
        out = (index.where("term is null").select(F.posexplode(F.arrays_zip("ids", "sizes")).alias("o", "z"))
               .select(F.col("z.ids").alias("doc_id"), F.col("z.sizes").alias("n_words"),
                       F.array().cast("array<long>").alias("hits"), F.array().cast("array<long>").alias("items")))
    elif len(parts) == 1:
        out = parts[0]
    else:
        out = parts[0]
        for x in parts[1:]:
            out = out.unionByName(x)
        out = (out.groupBy("segment", "ord").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")))
    names = F.array_sort(F.filter("items", lambda i: i != NO_ID).cast("array<string>"))
    return out.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
                      F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                      (F.size("hits") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` without the contaminated ones.  A row is named by a 64-bit hash
    of its id and text, so rows that share an id, or have none, are judged each
    by its own text."""
    key = F.xxhash64(docs[id_col], docs[text_col])
    found = contamination(build_index(docs.select(key.alias("row"), docs[text_col].alias("text")), "row", "text"), items, **params)
    bad = found.where("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, key == bad["_bad"], "left_anti")


def digest(item_ids: list) -> str:
    """``items_sha256`` of a list of ids (for tests)."""
    return hashlib.sha256(",".join(sorted(map(str, item_ids))).encode()).hexdigest()
