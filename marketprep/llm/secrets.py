"""Secret scans: character Markov models beside fixed patterns.

Two first-order models over characters, one of random strings and one of
ordinary identifiers, are trained from labelled samples; a long run of
identifier characters is reported when its mean log-likelihood ratio per
character exceeds a threshold.  Spans of the fixed patterns always stay, and a
run that overlaps one is not reported again.

Defined cases: a null text counts as empty; repeated rows each give a row; a
null ``doc_id`` stays null; without samples of a kind its model is uniform.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship, write_table
from .textarrays import hash_strings, raw, slices

# --------------------------------------------------------------------------
# FIXED VALUES: kinds in the order of reports, and their patterns
# --------------------------------------------------------------------------
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LENGTH = 8
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 16
HEX_LENGTH = 32

# Runs shorter than this are too short to tell.
RUN_LENGTH = 20
# Mean log-likelihood ratio a character (natural logarithm) from which a run is random.
THRESHOLD = 0.0
# Labelled strings of each kind the models are trained from, at most.
TRAIN_STRINGS = 4_000
# One of so many documents (by hash of its id) lends its ordinary strings.
LEND_ONE_IN = 20

_B = np.arange(256)
_HEX = ((_B >= 0x30) & (_B <= 0x39)) | ((_B >= 0x61) & (_B <= 0x66))
_RUN = (((_B >= 0x30) & (_B <= 0x39)) | ((_B >= 0x41) & (_B <= 0x5A)) | ((_B >= 0x61) & (_B <= 0x7A))
        | np.isin(_B, list(b"+/_=-")))
_FOLD = np.where((_B >= 0x41) & (_B <= 0x5A), _B + 32, _B).astype(np.uint8)


def runs(data: np.ndarray, off: np.ndarray, inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of a byte class of at least ``least`` bytes, within texts."""
    w = np.zeros(len(data) + 2, np.int8)
    w[1:-1] = inside[data]
    edge = np.diff(w)
    s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long_ = e - s >= least
    s, e = s[long_], e[long_]
    cut = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]
    if len(cut) and len(s):                       # a text's end ends a run
        k = np.searchsorted(s, cut, "right") - 1
        across = cut[(k >= 0) & (s[k] < cut) & (cut < e[k])]
        if len(across):
            s, e = np.sort(np.append(s, across)), np.sort(np.append(e, across))
            long_ = e - s >= least
            s, e = s[long_], e[long_]
    return s, e


def _texts_with(flat: bytes, off: np.ndarray, parts: Sequence[bytes]) -> set[int]:
    out: set[int] = set()
    for p in parts:
        at = flat.find(p)
        while at >= 0:
            t = int(np.searchsorted(off, at, "right")) - 1
            out.add(t)
            at = flat.find(p, int(off[t + 1]))
    return out


def base_spans(data: np.ndarray, off: np.ndarray) -> list[list[tuple[int, int, int, int, int]]]:
    """Per text: ``(start, kind, end, value start, value end)`` in bytes."""
    out: list[list[tuple[int, int, int, int, int]]] = [[] for _ in range(len(off) - 1)]
    low, flat = _FOLD[data].tobytes(), data.tobytes()
    for t in _texts_with(low, off, ASSIGN_WORDS):
        for m in ASSIGN.finditer(flat[off[t]:off[t + 1]]):
            if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
                out[t].append((m.start(), 0, m.end(), m.start(2), m.end(2)))
    for t in _texts_with(flat, off, (b"AKIA",)):
        for m in ACCESS.finditer(flat[off[t]:off[t + 1]]):
            if m.end() - m.start() >= ACCESS_LENGTH:
                out[t].append((m.start(), 1, m.end(), m.start(), m.end()))
    s, e = runs(data, off, _HEX, HEX_LENGTH)
    for a, b, t in zip(s, e, np.searchsorted(off, s, "right") - 1):
        a, b = int(a - off[t]), int(b - off[t])
        out[t].append((a, 2, b, a, b))
    for x in out:
        x.sort()
    return out


class Markov:
    """Log-likelihood ratios of character steps, random against ordinary.

    Characters are bytes; the step from 0 stands for a string's begin.
    """

    def __init__(self, random: Sequence[bytes], ordinary: Sequence[bytes], smooth: float = 0.5) -> None:
        self.ratio = self._logs(random, smooth) - self._logs(ordinary, smooth)

    @staticmethod
    def _logs(samples: Sequence[bytes], smooth: float) -> np.ndarray:
        alphabet = np.flatnonzero(_RUN)
        table = np.zeros((256, 256))
        for s in samples:
            x = np.frombuffer(b"\0" + s, np.uint8)
            np.add.at(table, (x[:-1], x[1:]), 1)
        table[:, alphabet] += smooth
        total = table.sum(1, keepdims=True)
        return np.log(np.maximum(table, 1e-300) / total) * (table > 0)

    def score(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Mean ratio a character of each run ``data[s:e]``."""
        if not len(s):
            return np.zeros(0)
        step = np.zeros(len(data) + 1)
        np.cumsum(self.ratio[np.append(0, data[:-1]), data], out=step[1:])
        inner = step[e] - step[s + 1]
        return (inner + self.ratio[0, data[s]]) / (e - s)


def _made_strings(n: int, seed: int = 7) -> list[bytes]:
    """Random strings over the usual alphabets (labelled samples beside those
    the corpus has)."""
    rng = np.random.default_rng(seed)
    sets = [b"0123456789abcdef", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
            b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
            b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"]
    return [bytes(rng.choice(np.frombuffer(sets[i % len(sets)], np.uint8), int(rng.integers(20, 64))))
            for i in range(n)]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_strings: int = TRAIN_STRINGS) -> Markov:
    """Train both models from strings the fixed patterns label: values inside
    their spans are random, other runs ordinary.

    The models take at most ``max_strings`` distinct strings of each label,
    those of smallest hash (ordinary ones from one document in
    ``LEND_ONE_IN``); some four times as many reach the driver, however many
    there are.  Made random strings join the first label."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, off = raw(b.column(1))
            lends = b.column(0).to_numpy(zero_copy_only=False)
            found: dict[bytes, int] = {}
            spans = base_spans(data, off)
            s, e = runs(data, off, _RUN, 4)
            owner = np.searchsorted(off, s, "right") - 1
            free = lends[owner].astype(bool)
            for a, z, t in zip(s[free], e[free], owner[free]):
                if not spans[t]:
                    found[data[a:z].tobytes()] = 0
            for t, x in enumerate(spans):
                for _, _, _, a, z in x:
                    found[data[off[t] + a:off[t] + z].tobytes()] = 1
            keys = list(found)
            h = hash_strings(pa.array(keys, pa.binary()))
            for label in (0, 1):                  # a task never needs more than the smallest hashes
                mine = [i for i, k in enumerate(keys) if found[k] == label]
                mine = sorted(mine, key=lambda i: (int(h[i].view(np.int64)), keys[i]))[:max_strings]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mine), label), pa.int32()), pa.array(h[mine].view(np.int64)),
                     pa.array([keys[i] for i in mine], pa.binary())], ["label", "h", "s"])

    lend = F.coalesce(F.pmod(F.xxhash64(F.col(id_col)), F.lit(LEND_ONE_IN)) == 0, F.lit(False))
    rows = docs.select(lend.alias("lends"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "label int, h long, s binary").distinct()
    got: dict[int, list[bytes]] = {}
    rows = write_table(rows, "strings")
    for label in (0, 1):
        mine = rows.where(F.col("label") == label)
        n = mine.count()
        # the hashes below this bound hold about four times what is taken
        part = 4 * max_strings / max(n, 1)
        top: list = []
        while len(top) < min(n, max_strings):
            low = mine if part >= 1 else mine.where(F.col("h") <= int((part * 2 - 1) * 2 ** 63))
            top = low.orderBy("h", "s").limit(max_strings).collect()
            part *= 2
        got[label] = [bytes(r["s"]) for r in top]
    return Markov(got[1] + _made_strings(max_strings // 2), got[0])


def find(data: np.ndarray, off: np.ndarray, model: Markov | None,
         threshold: float = THRESHOLD) -> list[list[tuple[int, int, int]]]:
    """Per text: sorted ``(start, kind, end)`` in bytes."""
    base = base_spans(data, off)
    out = [[x[:3] for x in b] for b in base]
    if model is not None:
        s, e = runs(data, off, _RUN, RUN_LENGTH)
        hit = model.score(data, s, e) > threshold
        for a, z in zip(s[hit], e[hit]):
            t = int(np.searchsorted(off, a, "right")) - 1
            a, z = int(a - off[t]), int(z - off[t])
            if all(z <= x[0] or a >= x[2] for x in base[t]):
                out[t].append((a, 3, z))
        for x in out:
            x.sort()
    return out


def scan(docs: DataFrame, model: Markov | None, threshold: float = THRESHOLD, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: ``n_assign, n_access, n_hex``, ``base_sha256`` of
    the pattern spans, ``spans`` (all, ``kind:start:end`` in code points) and
    ``n_random``."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, off = raw(b.column(1))
            cols: list[list] = [[] for _ in range(6)]
            none = hashlib.sha256(b"").hexdigest()
            for t, x in enumerate(find(data, off, model, threshold)):
                if not x:
                    for c, v in zip(cols, (0, 0, 0, none, "", 0)):
                        c.append(v)
                    continue
                text = data[off[t]:off[t + 1]]
                point = np.append(0, np.cumsum((text & 0xC0) != 0x80))
                said = [f"{KINDS[k]}:{point[a]}:{point[z]}" for a, k, z in x]
                kinds = [k for _, k, _ in x]
                base = ",".join(s for s, k in zip(said, kinds) if k < 3)
                for c, v in zip(cols, (kinds.count(0), kinds.count(1), kinds.count(2),
                                       hashlib.sha256(base.encode()).hexdigest(), ",".join(said), kinds.count(3))):
                    c.append(v)
            n = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], n), pa.array(cols[1], n), pa.array(cols[2], n),
                 pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string()), pa.array(cols[5], n)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                               "spans string, n_random long")
