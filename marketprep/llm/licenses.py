"""License scans: fuzzy search of short notices.

Texts are reduced to their words, one blank between two.  A notice of length n
may be found with up to k edits; cut into k + 1 pieces, at least one piece
stands unchanged in any such place, so exact search of the pieces finds every
candidate; of twice as many pieces half stand there unchanged, which few other
places have.  Around a candidate the regex library's bounded-error matching
verifies the edits and reports the span.  Plain phrases of license names are
found beside that, by words.

Defined cases: a null text has no words; repeated rows each give a row; a null
``doc_id`` stays null; the time of a text grows with its length, however often a
notice stands in it.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship
from .textarrays import ALNUM_SPLIT, LOWER, raw, slices, split_words

# --------------------------------------------------------------------------
# FIXED VALUES: license names and their labels
# --------------------------------------------------------------------------
PHRASES: tuple[tuple[str, str], ...] = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Short notices as their words, with labels.
NOTICES: tuple[tuple[str, str], ...] = (
    ("licensed under the gnu general public license", "gpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under cc by", "cc-by"),
    ("creative commons attribution", "cc-by"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("all rights reserved", "reserved"),
)
# One edit is allowed for so many characters of a notice (and one at least).
CHARS_PER_EDIT = 10


def edits_of(notice: str) -> int:
    return max(1, len(notice) // CHARS_PER_EDIT)


def seeds_of(notice: str, pieces: int) -> list[tuple[int, bytes]]:
    """The pieces of a notice and where each begins."""
    cut = np.linspace(0, len(notice), pieces + 1).astype(int)
    return [(int(a), notice[a:b].encode()) for a, b in zip(cut[:-1], cut[1:])]


@dataclass(frozen=True)
class Match:
    """A notice found in a text: words ``first`` to ``last``, and its edits."""

    text: int
    label: str
    first: int
    last: int
    edits: int
    length: int


def _all(body: bytes, part: bytes) -> Iterator[int]:
    at = body.find(part)
    while at >= 0:
        yield at
        at = body.find(part, at + 1)


class Scanner:
    """Searches the words of several texts at once."""

    def __init__(self, phrases: Sequence[tuple[str, str]] = PHRASES,
                 notices: Sequence[tuple[str, str]] = NOTICES) -> None:
        self.phrases = [(p.encode(), label) for p, label in phrases]
        self.notices = []
        for text, label in notices:
            k = edits_of(text)
            # the best match first, then what is left of the window before and behind it
            find = regex.compile(b"(?b)(?:" + regex.escape(text.encode()) + b"){e<=%d}" % k)
            self.notices.append((text, label, k, seeds_of(text, k + 1), seeds_of(text, 2 * k + 2), find))

    def scan(self, data: np.ndarray, off: np.ndarray):
        """``(words per text, base places [(text, word, label)], [Match])``."""
        w = split_words(data, off, ALNUM_SPLIT, LOWER)
        n = len(w)
        size = np.diff(w.off)
        begin = w.off[:-1] + np.arange(n)                    # of each word in the reduced texts
        body = np.full(len(w.body) + n, 0x20, np.uint8)
        body[np.arange(len(w.body)) + np.repeat(np.arange(n), size)] = w.body
        tail = w.first[1:][np.diff(w.first) > 0] - 1         # a text's last word ends its line
        body[begin[tail] + size[tail]] = 0x0A
        flat = body.tobytes()
        words = np.diff(w.first)

        def text_of(word: int) -> int:
            return int(np.searchsorted(w.first, word, "right")) - 1

        base = []
        for phrase, label in self.phrases:
            for at in _all(flat, phrase):
                end = at + len(phrase)
                if (at == 0 or flat[at - 1] in b" \n") and flat[end] in b" \n":
                    word = int(np.searchsorted(begin, at))
                    t = text_of(word)
                    base.append((t, word - int(w.first[t]), label))

        found: list[Match] = []
        for text, label, k, seeds, halves, find in self.notices:
            spans = sorted((at - o - k, at - o + len(text) + k) for o, s in seeds for at in _all(flat, s))
            for lo, hi in _merged(spans):
                for line_at, line in _places(flat, max(lo, 0), hi, halves, len(text), k):
                    for m in _matches(find, line, len(text) - k, len(text) + k):
                        a, b = line_at + m.start(), line_at + m.end()
                        first = int(np.searchsorted(begin, a, "right")) - 1
                        last = int(np.searchsorted(begin, max(a, b - 1), "right")) - 1
                        t = text_of(first)
                        found.append(Match(t, label, first - int(w.first[t]), last - int(w.first[t]),
                                           sum(m.fuzzy_counts), len(text)))
        return words, base, found


def _matches(find: regex.Pattern, line: bytes, least: int, most: int) -> Iterator[regex.Match]:
    """Best matches that do not overlap: the best of a stretch, then those of
    the stretches before and behind it, down to ``least`` bytes.

    The stretch is searched in windows of twice ``most`` bytes, the longest a
    match can be, that overlap by half, so each match lies in one.  The best
    of all windows is the best of the stretch; taking it opens again only the
    windows that held a part of it, so time grows with the text, not its square.
    """
    taken = bytearray(len(line))
    heap: list[tuple] = []
    seen: set[tuple[int, int]] = set()

    def push(lo: int, hi: int) -> None:
        if hi - lo >= least and (lo, hi) not in seen:
            seen.add((lo, hi))
            if m := find.search(line, lo, hi):
                heappush(heap, (sum(m.fuzzy_counts), m.start(), -hi, lo, m))

    for lo in range(0, max(1, len(line) - most), most):
        push(lo, min(lo + 2 * most, len(line)))
    while heap:
        _, _, hi, lo, m = heappop(heap)
        hi = -hi
        if taken.find(1, lo, hi) < 0:
            yield m
            # a match of no bytes could be found again and again
            end = max(m.end(), m.start() + 1)
            taken[m.start():end] = b"\x01" * (end - m.start())
        # what is free of the window; only the best of the others may be stale
        while lo < hi:
            lo = taken.find(0, lo, hi)
            if lo < 0:
                break
            end = taken.find(1, lo, hi)
            end = hi if end < 0 else end
            push(lo, end)
            lo = end


def _merged(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Overlapping candidate windows as one."""
    now: tuple[int, int] | None = None
    for a, b in spans:
        if now and a < now[1]:
            now = (now[0], max(now[1], b))
        else:
            if now:
                yield now
            now = (a, b)
    if now:
        yield now


def _places(flat: bytes, lo: int, hi: int, halves: list[tuple[int, bytes]], n: int, k: int) -> Iterator[tuple[int, bytes]]:
    """The parts of a window where a notice of ``n`` bytes can stand.  Of twice
    as many pieces all but ``k`` are unchanged, moved by ``k`` at most: parts
    without so many different pieces near one another need no matching."""
    for line_at, line in _lines(flat, lo, hi):
        hits = sorted((at - o, i) for i, (o, s) in enumerate(halves) for at in _all(line, s))
        count = [0] * len(halves)
        kinds = first = 0
        spans = []
        for x, i in hits:
            kinds += not count[i]
            count[i] += 1
            while hits[first][0] < x - 2 * k:
                count[hits[first][1]] -= 1
                kinds -= not count[hits[first][1]]
                first += 1
            if kinds >= len(halves) - k:
                spans.append((hits[first][0] - k, x + n + k))
        for a, b in _merged(spans):
            a = max(a, 0)
            yield line_at + a, line[a:b]


def _lines(flat: bytes, lo: int, hi: int) -> Iterator[tuple[int, bytes]]:
    """The parts of a window by text."""
    at = lo
    for part in flat[lo:hi].split(b"\n"):
        yield at, part
        at += len(part) + 1


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         phrases: Sequence[tuple[str, str]] = PHRASES, notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """One row per document: ``n_words``, ``n_base`` places of the phrases with
    ``first_word`` and ``last_word``, ``base_labels``, ``labels`` (with those of
    the notices), ``score`` (similarity of the best match, 1 for a phrase) and
    ``spans`` (``label:first:last:edits`` of the notices, by words)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices)
        for b in slices(batches):
            words, base, found = scanner.scan(*raw(b.column(1)))
            rows = b.num_rows
            at: list[list[int]] = [[] for _ in range(rows)]
            names: list[set[str]] = [set() for _ in range(rows)]
            more: list[set[str]] = [set() for _ in range(rows)]
            spans: list[list[tuple]] = [[] for _ in range(rows)]
            score = [0.0] * rows
            for t, word, label in base:
                at[t].append(word)
                names[t].add(label)
                score[t] = 1.0
            for m in found:
                more[m.text].add(m.label)
                spans[m.text].append((m.first, m.label, m.last, m.edits))
                score[m.text] = max(score[m.text], 1 - m.edits / m.length)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words), pa.array([len(a) for a in at], pa.int64()),
                 pa.array([min(a, default=None) for a in at], pa.int64()),
                 pa.array([max(a, default=None) for a in at], pa.int64()),
                 pa.array([",".join(sorted(x)) for x in names]),
                 pa.array([",".join(sorted(x | y)) for x, y in zip(names, more)]), pa.array(score, pa.float64()),
                 pa.array([",".join(f"{l}:{a}:{z}:{e}" for a, l, z, e in sorted(x)) for x in spans])],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                               "base_labels string, labels string, score double, spans string")
