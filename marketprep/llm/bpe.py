"""Byte-level BPE with vectorised pre-tokenisation.

A text becomes an array of code points, each mapped to a symbol class; the
classes drive a small automaton with eight states.  Its transition functions
form a finite monoid, so where tokens begin is found with an associative scan
over the function of each character (doubling steps, only where the composed
function still depends on the state before it), not with a regular
expression.  The slices between the boundaries are coded once per distinct
slice, merged pair by pair (all distinct slices together), and the ids reused for
every place of the slice.

Null texts count as empty; an empty text has no tokens.  Repeated rows each
give a row.  Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship
from .textarrays import byte_strings, gather, raw, slices

# --------------------------------------------------------------------------
# FIXED VALUES (must equal those of the public pattern)
# --------------------------------------------------------------------------
# Code points of Unicode's White_Space property.
WHITE_SPACE = (0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003,
               0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F,
               0x205F, 0x3000)
# What may follow an apostrophe in a contraction.
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")

# Character classes.
LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)
# Symbols: a class plus what the next characters say.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_BLANK, S_LAST_SPACE, S_LAST_BLANK = range(8)
# States after a character: what the next one continues.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_BLANKS, ONE_LEFT, TWO_LEFT = range(8)


def _step(symbol: int, state: int) -> tuple[int, bool]:
    """Next state, and whether a token begins at this character."""
    if symbol == S_LETTER:
        if state == TWO_LEFT:
            return ONE_LEFT, False
        if state == ONE_LEFT:
            return FRESH, False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_SPACE)
    if symbol == S_NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_SPACE)
    if symbol == S_OTHER or (symbol in (S_SHORT, S_LONG) and state in (IN_OTHERS, AFTER_SPACE)):
        return IN_OTHERS, state not in (IN_OTHERS, AFTER_SPACE)
    if symbol == S_SHORT:
        return ONE_LEFT, True
    if symbol == S_LONG:
        return TWO_LEFT, True
    if symbol == S_LAST_SPACE:
        return AFTER_SPACE, True
    if symbol == S_LAST_BLANK:
        return FRESH, True
    return IN_BLANKS, state != IN_BLANKS


def _byte_table(values: list) -> bytes:
    return bytes(int(v) for v in values) + bytes(256 - len(values))


def _look(table: bytes, at: np.ndarray) -> np.ndarray:
    """``table[at]`` for bytes."""
    return np.frombuffer(at.tobytes().translate(table), np.uint8)


class _Monoid:
    """All compositions of the transition functions, and how they multiply."""

    def __init__(self) -> None:
        gens = [tuple(_step(y, s)[0] for s in range(8)) for y in range(8)]
        reset = (FRESH,) * 8
        elems = {f: i for i, f in enumerate(dict.fromkeys([*gens, reset]))}
        todo = list(elems)
        while todo:
            f = todo.pop()
            for g in gens:
                for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                    if h not in elems:
                        elems[h] = len(elems)
                        todo.append(h)
        fs = list(elems)
        assert len(fs) <= 16        # two functions fit in a byte: tables are byte to byte
        product = np.zeros((16, 16), np.uint8)
        for i, f in enumerate(fs):
            for j, g in enumerate(fs):
                product[i, j] = elems[tuple(g[x] for x in f)]
        self.product = product.tobytes()
        self.of_symbol = _byte_table([elems[g] for g in gens])
        self.reset = np.uint8(elems[reset])
        self.constant = _byte_table([len(set(f)) == 1 for f in fs])
        self.state = _byte_table([f[0] for f in fs])
        self.begins = _byte_table([_step(y, s)[1] for y in range(8) for s in range(8)])


@lru_cache(1)
def _monoid() -> _Monoid:
    return _Monoid()


@lru_cache(1)
def _classes() -> np.ndarray:
    kind = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER)
                         for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    table[list(WHITE_SPACE)] = BLANK
    table[0x20] = SPACE
    return table


def _symbols(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol of each code point; ``first`` marks where texts begin."""
    kind = _classes()[cp]
    sym = kind.copy()                       # LETTER, NUMBER, OTHER are their own symbols
    blank = kind >= BLANK
    sym[blank] = S_BLANK
    solid_next = np.zeros(len(cp), bool)    # the text goes on with a non-blank character
    solid_next[:-1] = ~blank[1:] & ~first[1:]
    last = blank & solid_next
    sym[last] = np.where(kind[last] == SPACE, S_LAST_SPACE, S_LAST_BLANK)
    at = np.flatnonzero(cp == 0x27)
    if len(at):
        n = len(cp)
        one, two = np.minimum(at + 1, n - 1), np.minimum(at + 2, n - 1)
        has_one = (at + 1 < n) & ~first[one]
        has_two = has_one & (at + 2 < n) & ~first[two]
        for e in SHORT_ENDINGS:
            sym[at[has_one & (cp[one] == ord(e))]] = S_SHORT
        for e in LONG_ENDINGS:
            sym[at[has_two & (cp[one] == ord(e[0])) & (cp[two] == ord(e[1]))]] = S_LONG
    return sym


def token_starts(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mask of the code points where a pre-token begins."""
    m = _monoid()
    if not len(cp):
        return np.zeros(0, bool)
    sym = _symbols(cp, first)
    f = _look(m.of_symbol, sym).copy()
    f[first] = _look(m.product, (m.reset << 4) | f[first])
    # Doubling: f[i] becomes the composition of the last 2, 4, ... functions.
    # A constant one stays what it is, and each text begins with one.
    for step in (1, 2):
        if len(f) > step:
            f[step:] = _look(m.product, (f[:-step] << 4) | f[step:])
    open_, step = np.flatnonzero(_look(m.constant, f) == 0), 4
    while len(open_):
        f[open_] = _look(m.product, (f[open_ - step] << 4) | f[open_])
        open_ = open_[_look(m.constant, f[open_]) == 0]
        step *= 2
    before = np.empty(len(cp), np.uint8)
    before[1:] = _look(m.state, f[:-1])
    before[first] = FRESH
    return _look(m.begins, (sym << 3) | before) != 0


def pieces(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pre-tokens of the texts ``data[off[i]:off[i+1]]``: byte offsets of all
    pieces (plus the end), and per text the index of its first piece."""
    cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    if len(lead) != len(cp):
        raise ValueError("a text is not valid UTF-8")
    first = np.zeros(len(cp), bool)
    begin = np.searchsorted(lead, off[:-1][np.diff(off) > 0])
    first[begin] = True
    at = lead[np.flatnonzero(token_starts(cp, first))]
    return np.append(at, len(data)), np.searchsorted(at, off)


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` vocabulary file (on the driver)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one long piece, with a heap over linked parts."""
    import heapq
    n = len(piece)
    end = list(range(1, n + 1))          # part i is piece[i:end[i]]
    left = list(range(-1, n - 1))
    live = [True] * n
    get = ranks.get
    heap = [(r, i) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        if not live[i] or end[i] >= n or get(piece[i:end[end[i]]]) != r:
            continue
        j = end[i]
        end[i] = end[j]
        live[j] = False
        if end[i] < n:
            left[end[i]] = i
            if (q := get(piece[i:end[end[i]]])) is not None:
                heapq.heappush(heap, (q, i))
        if left[i] >= 0 and (q := get(piece[left[i]:end[i]])) is not None:
            heapq.heappush(heap, (q, left[i]))
    return [ranks[piece[i:end[i]]] for i in range(n) if live[i]]


# Longer pre-tokens are merged one by one with a heap, shorter ones together.
LONG_PIECE = 64
_NONE = np.uint32(0xFFFFFFFF)


class PairTable:
    """Rank of two adjacent tokens joined: an open hash table in arrays, with
    an entry for every split of every token of the vocabulary into two."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.single = np.full(256, _NONE, np.uint32)
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            if len(token) == 1:
                self.single[token[0]] = rank
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = rank
        if (self.single == _NONE).any():
            raise ValueError("the vocabulary lacks a byte")
        self.fill(pairs)

    def fill(self, pairs: dict[int, int]) -> None:
        """Enter ``(left << 32) | right -> rank`` into the arrays."""
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.vals = np.full(1 << self.bits, _NONE, np.uint32)
        keys = np.fromiter(pairs, np.uint64, len(pairs))
        vals = np.fromiter(pairs.values(), np.uint32, len(pairs))
        slot, self.probes = self._slot(keys), 0
        while len(keys):
            self.probes += 1
            free = self.vals[slot] == _NONE
            _, won = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[won]
            self.keys[slot[won]], self.vals[slot[won]] = keys[won], vals[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            keys, vals, slot = keys[rest], vals[rest], (slot[rest] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or the largest number where there is none."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right
        slot = self._slot(key)
        out = np.where(self.keys[slot] == key, self.vals[slot], _NONE)
        open_ = np.flatnonzero((out == _NONE) & (self.vals[slot] != _NONE))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            at, want = slot[open_], key[open_]
            hit = self.keys[at] == want
            out[open_[hit]] = self.vals[at[hit]]
            open_ = open_[~hit & (self.vals[at] != _NONE)]
        return out

    def long(self, piece: bytes) -> list[int]:
        return merge_long(piece, self.ranks)

    def merge(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces ``data[off[i]:off[i+1]]`` and their offsets: in
        each piece join the adjacent pair of lowest rank, the leftmost among
        equals, until no pair has a rank.  All pieces advance together."""
        size = np.diff(off)
        done_ids, done_piece = [], []
        for i in np.flatnonzero(size >= LONG_PIECE):
            got = self.long(data[off[i]:off[i + 1]].tobytes())
            done_ids.append(np.array(got, np.uint32))
            done_piece.append(np.full(len(got), i))
        short = np.flatnonzero((size < LONG_PIECE) & (size > 0))
        body, at = gather(data, off, short)
        tok = self.single[body]
        begin, count = at[:-1], np.diff(at)
        piece = np.repeat(short, count)
        low = np.full(len(tok), _NONE, np.uint32)    # rank of the token and the next one
        inner = np.ones(len(tok), bool)
        inner[at[1:] - 1] = False
        inner = np.flatnonzero(inner)
        low[inner] = self.rank(tok[inner], tok[inner + 1])
        while len(begin):
            best = np.minimum.reduceat(low, begin)
            on = best != _NONE
            if not on.all():                          # pieces that are finished leave
                keep = np.repeat(on, count)
                done_ids.append(tok[~keep])
                done_piece.append(piece[~keep])
                tok, low, piece = tok[keep], low[keep], piece[keep]
                count, best = count[on], best[on]
                begin = np.cumsum(count) - count
                if not len(begin):
                    break
            hit = np.flatnonzero(low == np.repeat(best, count))
            at_hit = np.searchsorted(hit, begin)      # the first one of each piece
            i = hit[at_hit]
            tok[i] = best
            gone = np.ones(len(tok), bool)
            gone[i + 1] = False
            last = i + 1 == begin + count - 1         # nothing follows the joined pair
            low[i] = _NONE
            more = ~last
            low[i[more]] = self.rank(tok[i[more]], tok[i[more] + 2])
            back = i > begin
            low[i[back] - 1] = self.rank(tok[i[back] - 1], tok[i[back]])
            tok, low, piece = tok[gone], low[gone], piece[gone]
            count = count - 1
            begin = np.cumsum(count) - count
        if not done_ids:
            return np.zeros(0, np.uint32), np.zeros(len(size) + 1, np.int64)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_piece)
        order = np.argsort(owner, kind="stable")
        out = np.zeros(len(size) + 1, np.int64)
        np.cumsum(np.bincount(owner, minlength=len(size)), out=out[1:])
        return ids[order], out


def encode_texts(data: np.ndarray, off: np.ndarray,
                 merged: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, concatenated, and per-text offsets.

    ``merged`` gets each distinct piece of these texts once; its ids are
    reused for every place where the piece stands."""
    at, first = pieces(data, off)
    d = byte_strings(data, at).dictionary_encode()
    pool, pool_off = merged(d.dictionary)
    ids, part = gather(pool, pool_off, d.indices.to_numpy(zero_copy_only=False))
    return ids, part[first]


_TABLES: dict[bytes, PairTable] = {}


def pair_table(ranks: dict[bytes, int]) -> PairTable:
    """The table of these ranks, built once per worker process."""
    key = hashlib.sha256(b"".join(b"%d:%d:%b" % (rank, len(token), token) for token, rank in ranks.items())).digest()
    if key not in _TABLES:
        _TABLES[key] = PairTable(ranks)
    return _TABLES[key]


def merging(ranks: dict[bytes, int]) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """What :func:`encode_texts` needs to merge by these ranks."""
    table = pair_table(ranks)
    return lambda distinct: table.merge(*raw(distinct))


class Decoder:
    """Bytes of token ids, by gathering from one pool of token bytes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        by_id = {v: k for k, v in ranks.items()}
        size = max(by_id, default=-1) + 1
        parts = [by_id.get(i, b"") for i in range(size)]
        self.off = np.zeros(size + 1, np.int64)
        np.cumsum(np.fromiter(map(len, parts), np.int64, size), out=self.off[1:])
        self.pool = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, and the offsets of each text's bytes, given the
        offsets of each text's ids."""
        body, part = gather(self.pool, self.off, ids)
        return body, part[off]


def _int_lists(values: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, token_ids array<int>)`` of every document."""
    ship(docs.sparkSession)
    bc = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))  # a vocabulary file: fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = merging(bc.value)
        for b in slices(batches, "text"):
            ids, off = encode_texts(*raw(b.column(1)), merged)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(off)), _int_lists(ids, off)],
                ["doc_id", "n_tokens", "token_ids"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_tokens long, token_ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "token_ids") -> DataFrame:
    """``(doc_id, body binary)``: the bytes of each document's ids."""
    ship(encoded.sparkSession)
    bc = encoded.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = Decoder(bc.value)
        for b in batches:
            lists = b.column(1)
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            off = np.zeros(len(lists) + 1, np.int64)
            np.cumsum(size, out=off[1:])
            body, at = dec.decode(lists.flatten().to_numpy(zero_copy_only=False), off)
            yield pa.RecordBatch.from_arrays([b.column(0), byte_strings(body, at)], ["doc_id", "body"])

    return encoded.select("doc_id", F.col(ids_col).alias("token_ids")) \
        .mapInArrow(run, "doc_id long, body binary")


def digests(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encode and decode
    each slice of documents in one pass and return what identifies both."""
    ship(docs.sparkSession)
    bc = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = bc.value
        merged, dec = merging(ranks), Decoder(ranks)
        names = np.array([str(i) for i in range(len(dec.off) - 1)], object)
        sha = hashlib.sha256
        for b in slices(batches, "text"):
            ids, off = encode_texts(*raw(b.column(1)), merged)
            body, at = dec.decode(ids, off)
            shown, said, read = names[ids], [], []
            for i in range(b.num_rows):
                said.append(sha(" ".join(shown[off[i]:off[i + 1]].tolist()).encode()).hexdigest())
                read.append(sha(body[at[i]:at[i + 1]]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(off)), pa.array(said, pa.string()), pa.array(read, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
