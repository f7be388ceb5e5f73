"""Lexical retrieval packing: sequences of a fixed number of tokens, each filled
with a document and its nearest unused neighbours by BM25.

A document's ids (with the end id) are cut into whole windows, which are
sequences as they are, and a rest shorter than a window.  The rests are what is
packed: they are dealt at random into shards of a bounded number, each with an
inverted index over its rests (terms are token ids, so that statistics of the
whole corpus are an array as long as the vocabulary).  Within a shard the longest
unused rest is the next seed.  The index scores all unused rests against it;
those that share a term are taken from the best down, as far as they fit whole,
and what is still free is filled with the best one left, cut at the window's end,
whose remainder seeds the next window.  So only the last window of a shard can
fall short, and it is split into sequences of power-of-two lengths: nothing is
padded at all.

Document frequencies and the mean length are over all rests of all documents.
Encoded documents are written once; a lost executor rereads them, and their
numbers, on which shards and sequence ids depend, stay.

Defined cases: a null text is empty and has just the end id; null and repeated
ids are documents like others (nothing is keyed by id); an empty table has no
pieces; other columns are ignored.  Texts are encoded whole, however long; a
task holds a slice of some MB of text, or one text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .jsonbpe import encoder
from .shared import ship, write_table
from .textarrays import gather, raw, slices

WINDOW = 1024
SHARD_RESTS = 2048
K1, B = 1.2, 0.75
SLICE_BYTES = 4 << 20

_TASK_BITS = 33            # numbers within a task; above them the task's own
_RESTS = 1 << 62           # sequence ids of packed rests are above this


def _with_end(ids: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents with the end id behind each, and their offsets."""
    at = off + np.arange(len(off))
    out = np.empty(at[-1], np.uint32)
    ends = np.zeros(at[-1], bool)
    ends[at[1:] - 1] = True
    out[ends], out[~ends] = end_id, ids
    return out, at


def encoded(docs: DataFrame, tokenizer_json: str, end_id: int = 0, window: int = WINDOW, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Table ``(row, doc_id, doc_tokens, first_window, head, rest)`` in the shared
    folder: a number for each row, its ids (little-endian, four bytes) of whole
    windows and of the rest, and the number of its first whole window."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_json) as f:
        bc = spark.sparkContext.broadcast(f.read())               # a vocabulary file: fixed size
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(bc.value)
        base = TaskContext.get().partitionId() << _TASK_BITS
        row = first = base
        for b in slices(batches, "text", SLICE_BYTES):
            ids, at = _with_end(*encode(b.column(1)), end_id)
            windows = np.diff(at) // window
            cut = at[:-1] + windows * window
            begin = first + np.cumsum(windows) - windows
            kinds = np.zeros(2 * b.num_rows + 1, np.int64)
            kinds[0:-1:2], kinds[1::2], kinds[-1] = at[:-1], cut, at[-1]
            both = pa.Array.from_buffers(pa.large_binary(), 2 * b.num_rows,
                                         [None, pa.py_buffer(np.ascontiguousarray(4 * kinds)), pa.py_buffer(ids.astype("<u4"))])
            n = np.arange(b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + n), b.column(0), pa.array(np.diff(at)), pa.array(begin),
                 both.take(pa.array(2 * n)).cast(pa.binary()), both.take(pa.array(2 * n + 1)).cast(pa.binary())],
                ["row", "doc_id", "doc_tokens", "first_window", "head", "rest"])
            row, first = row + b.num_rows, first + int(windows.sum())

    return write_table(src.mapInArrow(
        run, f"row long, doc_id {kind}, doc_tokens long, first_window long, head binary, rest binary"), "encoded")


_PIECE = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _windows(table: DataFrame, window: int) -> DataFrame:
    """The whole windows of each document, each a sequence."""
    at = F.col("_k") * window
    per = F.sequence(F.lit(0), (F.length("head") / (4 * window)).cast("int") - 1)
    return (table.where(F.length("head") > 0)
            .select("doc_id", "doc_tokens", "first_window", "head", F.explode(per).alias("_k"))
            .select("doc_id", at.cast("long").alias("start"), F.lit(window).cast("long").alias("length"),
                    F.substring(F.col("head"), (4 * at + 1).cast("int"), F.lit(4 * window)).alias("ids"), "doc_tokens",
                    (F.col("first_window") + F.col("_k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def _terms(ids: np.ndarray, unit: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each unit: ``(unit, term, frequency)`` by unit."""
    key, count = np.unique(unit * vocabulary + ids, return_counts=True)
    return key // vocabulary, key % vocabulary, count


def _statistics(table: DataFrame, vocabulary: int) -> tuple[int, float, np.ndarray]:
    """Number and mean length of all rests, and how many hold each term; what
    comes to the driver is as long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(vocabulary, np.int64)
        for b in slices(batches, "rest", 4 << 20):
            data, off = raw(b.column(0))
            ids = np.frombuffer(data.tobytes(), "<u4").astype(np.int64)
            _, term, _ = _terms(ids, np.repeat(np.arange(b.num_rows), np.diff(off) // 4), vocabulary)
            df += np.bincount(term, minlength=vocabulary)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "n"])

    rests = table.where(F.length("rest") > 0).select("rest")
    seen = rests.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(vocabulary, np.int64)
    df[seen["term"].to_numpy(np.int64)] = seen["n"].to_numpy(np.int64)
    count, size = rests.agg(F.count(F.lit(1)), F.sum(F.length("rest"))).first()
    return count, (size or 0) / 4 / max(1, count), df


class Index:
    """Inverted index of one shard: BM25 weights of the rests that hold a term."""

    def __init__(self, ids: np.ndarray, off: np.ndarray, idf: np.ndarray, mean: float) -> None:
        self.n, size = len(off) - 1, np.diff(off)
        unit, term, tf = _terms(ids.astype(np.int64), np.repeat(np.arange(self.n), size), len(idf))
        told = idf[term] > 0                       # a term in half of all rests says nothing
        unit, term, tf = unit[told], term[told], tf[told]
        self.first = np.searchsorted(unit, np.arange(self.n + 1))
        _, self.term = np.unique(term, return_inverse=True)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[unit] / mean))
        by = np.argsort(self.term, kind="stable")
        self.unit, self.weight = unit[by], weight[by]
        self.begin = np.searchsorted(self.term[by], np.arange(len(by) and self.term[by][-1] + 2))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 score of every rest for the terms of one."""
        terms = self.term[self.first[seed]:self.first[seed + 1]]
        if not len(terms):
            return np.zeros(self.n)
        lo, size = self.begin[terms], self.begin[terms + 1] - self.begin[terms]
        end = np.cumsum(size)
        at = np.arange(end[-1]) + np.repeat(lo - end + size, size)
        return np.bincount(self.unit[at], self.weight[at], self.n)


def fill(index: Index, size: np.ndarray, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of ``(rest, begin, end)``; all but the last are full."""
    free = np.ones(len(size), bool)
    seeds = iter(np.argsort(-size, kind="stable"))
    out: list[list[tuple[int, int, int]]] = []
    left: tuple[int, int] | None = None            # a rest that was cut, and where
    while True:
        if left is None:
            seed = next((s for s in seeds if free[s]), None)
            if seed is None:
                return out
            seed, begin = int(seed), 0
        else:
            seed, begin = left
            left = None
        free[seed] = False
        held, room = [(seed, begin, int(size[seed]))], window - int(size[seed]) + begin
        if room:
            score = index.scores(seed)
            rank = np.flatnonzero(free)
            rank = rank[np.argsort(-score[rank], kind="stable")]
            near = rank[:np.searchsorted(-score[rank], 0)]          # those that share a term
            while room and len(fits := np.flatnonzero(size[near] <= room)):
                u = int(near[fits[0]])
                held.append((u, 0, int(size[u])))
                free[u], room = False, room - int(size[u])
                near = near[fits[0] + 1:]
            for u in rank:
                if not room:
                    break
                if free[u]:
                    take = min(room, int(size[u]))
                    held.append((int(u), 0, take))
                    free[u], room = False, room - take
                    left = (int(u), take) if take < size[u] else None
        out.append(held)


def _split_last(held: list[tuple[int, int, int]], window: int) -> list[list[tuple[int, int, int]]]:
    """A window that is not full as sequences of power-of-two lengths."""
    total = sum(e - b for _, b, e in held)
    if total == window:
        return [held]
    out, todo = [], list(reversed(held))
    for bit in range(total.bit_length() - 1, -1, -1):
        if not total >> bit & 1:
            continue
        room, part = 1 << bit, []
        while room:
            u, b, e = todo.pop()
            take = min(room, e - b)
            part.append((u, b, b + take))
            room -= take
            if b + take < e:
                todo.append((u, b + take, e))
        out.append(part)
    return out


def pack(table: DataFrame, vocabulary: int, window: int = WINDOW, shard_rests: int = SHARD_RESTS) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)`` of
    ``encoded`` documents; ``vocabulary`` is above every id."""
    spark = table.sparkSession
    count, mean, df = _statistics(table, vocabulary)
    idf = spark.sparkContext.broadcast(np.maximum(0, np.log((count - df + 0.5) / (df + 0.5))))   # as long as the vocabulary
    shards = max(1, -(-count // shard_rests))
    kind = table.schema["doc_id"].dataType.simpleString()

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by("row")
        data, off = raw(t["rest"])
        ids, off = np.frombuffer(data.tobytes(), "<u4"), off // 4
        size = np.diff(off)
        filled = fill(Index(ids, off, idf.value, mean), size, window)
        filled[-1:] = _split_last(filled[-1], window)
        pieces = np.array([(u, b, e, k) for k, held in enumerate(filled) for u, b, e in held], np.int64)
        u, begin, end, k = pieces.T
        length = end - begin
        at = np.cumsum(length) - length
        offset = at - at[np.searchsorted(k, k)]
        flat, where = gather(ids, np.stack([off[u] + begin, off[u] + end], 1).ravel(), 2 * np.arange(len(u)))
        body = pa.Array.from_buffers(pa.large_binary(), len(u), [None, pa.py_buffer(np.ascontiguousarray(4 * where)),
                                                                 pa.py_buffer(flat.astype("<u4"))]).cast(pa.binary())
        shard = t["shard"][0].as_py()
        total = t["doc_tokens"].to_numpy()[u]
        return pa.table([t["doc_id"].take(pa.array(u)), pa.array(total - size[u] + begin), pa.array(length), body, pa.array(total),
                         pa.array(_RESTS + (shard << _TASK_BITS) + k), pa.array(offset)],
                        ["doc_id", *(f.split()[0] for f in _PIECE.split(", "))])

    rests = (table.where(F.length("rest") > 0)
             .select("row", "doc_id", "doc_tokens", "rest", F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard")))
    packed = rests.groupBy("shard").applyInArrow(run, f"doc_id {kind}, {_PIECE}")
    return _windows(table, window).unionByName(packed)


def vocabulary_size(tokenizer_json: str, end_id: int = 0) -> int:
    """One more than the largest id of a tokenizer file."""
    with open(tokenizer_json) as f:
        told = json.load(f)
    return 1 + max([*told["model"]["vocab"].values(), *(t["id"] for t in told.get("added_tokens") or []), end_id])


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
