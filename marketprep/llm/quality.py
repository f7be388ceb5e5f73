"""Quality rules: gradient-boosted trees over document statistics.

Base rules on word counts and repeated windows come first; every other
document is scored by trees fitted here to labelled documents.  The fitted
trees are flattened into node arrays, so scoring walks all documents of a
slice through a tree level by level in numpy.  Chosen features have monotonic
constraints: more symbols, repeats or capitals never raise a score.

Defined cases: a null text counts as empty and fails the base rules (under 20
words); repeated rows each give a row; a null ``doc_id`` stays null; without
usable labels (none, or one class only) the model keeps every document that
passes the base rules.  Other columns of the input are ignored by
:func:`judge` and passed through by :func:`keep`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship
from .textarrays import BLANK_SPLIT, byte_strings, mix, per_text, raw, slices, split_words

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Labelled documents the trees are fitted to (the ones of smallest id hash).
TRAIN_ROWS = 8_000
# A document goes when its score (estimated probability of good quality) is lower.
THRESHOLD = 0.5

_BYTES = np.arange(256)
_IS_SYMBOL = np.isin(_BYTES, list(SYMBOLS))
_IS_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_IS_DIGIT = (_BYTES >= 0x30) & (_BYTES <= 0x39)
_IS_STOP = np.isin(_BYTES, list(b".,;:"))
_IS_LOUD = np.isin(_BYTES, list(b"!?"))
_IS_LEAD = (_BYTES & 0xC0) != 0x80

# Name of each feature and its constraint: -1 the score never rises with it,
# 1 it never falls, 0 free.
FEATURES: tuple[tuple[str, int], ...] = (
    ("symbols_per_word", -1), ("upper_share", -1), ("loud_per_word", -1),
    ("repeat_word_share", -1), ("dup_line_share", -1), ("digit_share", 0),
    ("stops_per_word", 0), ("word_length", 0), ("distinct_word_share", 1),
    ("top_word_share", -1), ("words_per_line", 0), ("log_words", 0),
)


def _window_repeats(code: np.ndarray, first: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Per text: words inside windows of 8 that occur twice or more in it."""
    n = len(code)
    if n < WINDOW:
        return np.zeros(len(first) - 1, np.int64)
    h = mix(code.astype(np.uint64) + np.uint64(1))
    for span, k in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9)):
        h = mix(h[:-span] * np.uint64(k) + h[span:])
    whole = owner[:n - WINDOW + 1] == owner[WINDOW - 1:]
    at = np.flatnonzero(whole)
    key = h[at] ^ mix(owner[at].astype(np.uint64) + np.uint64(0x5BD1E995))
    seen = np.sort(key)
    twice = np.unique(seen[1:][seen[1:] == seen[:-1]])
    if not len(twice):
        return np.zeros(len(first) - 1, np.int64)
    maybe = np.zeros(1 << 16, bool)
    maybe[twice & np.uint64(0xFFFF)] = True
    cand = np.flatnonzero(maybe[key & np.uint64(0xFFFF)])
    near = np.minimum(np.searchsorted(twice, key[cand]), len(twice) - 1)
    hit = at[cand[twice[near] == key[cand]]]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + WINDOW, -1)
    return per_text(np.cumsum(edge[:-1]) > 0, first)


def _duplicate_lines(data: np.ndarray, off: np.ndarray, has_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word that equal an earlier line; lines with a word."""
    brk = data == 10
    cut = np.flatnonzero(brk) + 1
    begin = np.unique(np.concatenate([off[:-1], cut[cut < len(data)]])) if len(data) else np.zeros(0, np.int64)
    begin = begin[begin < len(data)]
    if not len(begin):
        zero = np.zeros(len(off) - 1, np.int64)
        return zero, zero
    ends = np.append(begin[1:], len(data))
    word = np.zeros(len(data) + 1, np.int64)
    np.cumsum(has_word, out=word[1:])
    full = word[ends] > word[begin]
    skipped = np.zeros(len(data) + 1, np.int64)
    np.cumsum(brk, out=skipped[1:])
    lines = byte_strings(data[~brk], np.append(begin - skipped[begin], len(data) - skipped[-1]))
    code = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    owner = np.searchsorted(off, begin, "right") - 1
    key = np.sort((owner[full].astype(np.int64) << 32) | code[full])
    again = key[1:][key[1:] == key[:-1]] >> 32
    n = len(off) - 1
    return np.bincount(again, minlength=n), np.bincount(owner[full], minlength=n)


def statistics(data: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Base counts of each text, and its feature row."""
    inside = BLANK_SPLIT[data]
    w = split_words(data, off, BLANK_SPLIT)
    code, distinct = w.coded()
    owner = w.text_of()
    n = len(off) - 1
    n_words = np.diff(w.first)
    dup, n_lines = _duplicate_lines(data, off, inside)
    base = {
        "n_words": n_words,
        "word_chars": per_text(inside & _IS_LEAD[data], off),
        "n_symbols": per_text(_IS_SYMBOL[data], off),
        "n_dup_lines": dup,
        "n_repeat_words": _window_repeats(code, w.first, owner),
    }
    words = np.maximum(n_words, 1)
    chars = np.maximum(base["word_chars"], 1)
    key = np.sort((owner.astype(np.int64) << 32) | code)     # words of a text, equal ones together
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    runs = np.flatnonzero(fresh)
    n_distinct = np.bincount(key[runs] >> 32, minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, key[runs] >> 32, np.diff(np.append(runs, len(key))))
    cols = {
        "symbols_per_word": base["n_symbols"] / words,
        "upper_share": per_text(_IS_UPPER[data], off) / chars,
        "loud_per_word": per_text(_IS_LOUD[data], off) / words,
        "repeat_word_share": base["n_repeat_words"] / words,
        "dup_line_share": dup / np.maximum(n_lines, 1),
        "digit_share": per_text(_IS_DIGIT[data], off) / chars,
        "stops_per_word": per_text(_IS_STOP[data], off) / words,
        "word_length": base["word_chars"] / words,
        "distinct_word_share": n_distinct / words,
        "top_word_share": top / words,
        "words_per_line": n_words / np.maximum(n_lines, 1),
        "log_words": np.log1p(n_words),
    }
    return base, np.stack([cols[name] for name, _ in FEATURES], 1).reshape(n, len(FEATURES))


@dataclass(frozen=True)
class Trees:
    """Fitted trees as flat node arrays; a leaf points to itself."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each feature row."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.split[node],
                                self.left[node], self.right[node])
            total += self.value[node]
        return 1.0 / (1.0 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 4, rate: float = 0.15,
        min_rows: int = 10, l2: float = 1.0, bins: int = 64,
        monotone: tuple[int, ...] = tuple(m for _, m in FEATURES)) -> Trees:
    """Boosted trees for the log loss over binned features.

    A split on a constrained feature must order its two leaf values; the mean
    of the two then bounds what lies below on either side, so the order holds
    in the whole tree.
    """
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    width = max(len(e) for e in edges) + 1
    rate_good = y.mean()
    start = float(np.log(rate_good / (1 - rate_good)))
    total = np.full(len(y), start)
    nodes: list[list] = []
    roots: list[int] = []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, lo: float, hi: float) -> int:
        me = len(nodes)
        gs, hs = g[rows].sum(), h[rows].sum()
        nodes.append([0, np.inf, me, me, rate * float(np.clip(-gs / (hs + l2), lo, hi))])
        if level == depth or len(rows) < 2 * min_rows:
            return me
        best = (1e-6, -1, -1, 0.0, 0.0)
        for j, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, j]
            count = np.cumsum(np.bincount(b, minlength=width))[:len(e)]
            gl = np.cumsum(np.bincount(b, g[rows], width))[:len(e)]
            hl = np.cumsum(np.bincount(b, h[rows], width))[:len(e)]
            vl, vr = np.clip(-gl / (hl + l2), lo, hi), np.clip(-(gs - gl) / (hs - hl + l2), lo, hi)
            ok = (count >= min_rows) & (len(rows) - count >= min_rows) & (monotone[j] * (vr - vl) >= 0)
            # gain of clipped leaf values in the second-order expansion of the loss
            gain = (-(gl * vl + 0.5 * (hl + l2) * vl ** 2) - ((gs - gl) * vr + 0.5 * (hs - hl + l2) * vr ** 2)
                    - 0.5 * gs ** 2 / (hs + l2))
            gain[~ok] = -np.inf
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], j, k, vl[k], vr[k])
        _, j, k, vl, vr = best
        if j < 0:
            return me
        mid = (vl + vr) / 2
        below, above = (lo, hi), (lo, hi)
        if monotone[j] > 0:
            below, above = (lo, mid), (mid, hi)
        elif monotone[j] < 0:
            below, above = (mid, hi), (lo, mid)
        go = binned[rows, j] <= k
        nodes[me][0], nodes[me][1] = j, float(edges[j][k])
        nodes[me][2] = grow(rows[go], g, h, level + 1, *below)
        nodes[me][3] = grow(rows[~go], g, h, level + 1, *above)
        return me

    everyone = np.arange(len(y))
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(everyone, p - y, p * (1 - p), 0, -np.inf, np.inf))
        node = np.full(len(y), roots[-1])
        f, s, l, r, v = (np.array([n[i] for n in nodes]) for i in range(5))
        for _ in range(depth):
            node = np.where(x[everyone, f[node]] <= s[node], l[node], r[node])
        total = total + v[node]
    return Trees(f, s, l, r, v, np.array(roots), depth, start)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS, **params) -> Trees | None:
    """Fit the trees to at most ``max_rows`` labelled documents, the ones whose
    id has the smallest hash (the same at every size and layout).

    Of rows that share an id the one with the smallest statistics is used, so
    at most ``max_rows`` rows of a dozen numbers reach the driver."""
    ship(docs.sparkSession)
    chosen = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    rows = (docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
            .join(chosen, "_id").select("_id", F.col("_y").cast("int"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            _, x = statistics(*raw(b.column(2)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(x[:, j]) for j in range(x.shape[1]))],
                ["_id", "_y", *(f"f{j}" for j in range(x.shape[1]))])

    kinds = ", ".join(f"f{j} double" for j in range(len(FEATURES)))
    stats = rows.mapInArrow(run, f"_id long, _y int, {kinds}")
    one = stats.groupBy("_id").agg(F.min(F.struct(*stats.columns[1:])).alias("r"))
    got = one.select("_id", "r.*").toPandas()
    got = got.sort_values(list(got.columns), kind="stable")      # the same fit from any task order
    x, y = got.iloc[:, 2:].to_numpy(np.float64), got["_y"].to_numpy(np.float64)
    if not len(y) or y.min() == y.max():
        return None
    return fit(x, y, **params)


def verdicts(data: np.ndarray, off: np.ndarray, model: Trees | None,
             threshold: float) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Base counts, base failure, score and verdict of each text."""
    base, x = statistics(data, off)
    failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])
    score = model.score(x) if model else np.ones(len(failed))
    return base, failed, score, ~failed & (score >= threshold)


def judge(docs: DataFrame, model: Trees | None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: base counts, ``base_failed``, ``score``, ``kept``."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            base, failed, score, kept = verdicts(*raw(b.column(1)), model, threshold)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(v.astype(np.int64)) for v in base.values()),
                 pa.array(failed), pa.array(score), pa.array(kept)],
                ["doc_id", *base, "base_failed", "score", "kept"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                               "n_repeat_words long, base_failed boolean, score double, kept boolean")


def keep(docs: DataFrame, model: Trees | None, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col):
            kept = verdicts(*raw(b.column(b.schema.get_field_index(text_col))), model, threshold)[3]
            yield b.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
