"""Ids of a byte-level BPE file of the tokenizers library, merged in arrays.

Pre-tokens come from ``bpe`` (the public byte-level pattern) and their bytes are
merged by exactly the pairs the file lists, all distinct pre-tokens of a slice
together.  That is possible where the file says nothing else: byte-level
pre-tokenisation without a prefix space, no normaliser, and merged tokens
numbered in the order of the merges.  Any other file, and every text that holds
an added token (it may stand across pre-tokens), goes to the library itself.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa

from .bpe import PairTable, encode_texts
from .textarrays import raw
from .tokenfiles import _whole_encoder


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in such files: printable Latin-1
    characters for themselves, the other bytes from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class MergeTable(PairTable):
    """Id of two adjacent tokens joined, for the pairs that a file lists."""

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        self.single = np.full(256, 0xFFFFFFFF, np.uint32)
        for c, b in byte_alphabet().items():
            self.single[b] = vocab[c]
        self.pairs: dict[int, int] = {}
        last = -1
        for m in merges:
            a, b = m.split(" ") if isinstance(m, str) else m
            made = vocab[a + b]
            if made <= last:
                raise ValueError("ids do not follow the order of the merges")
            self.pairs[(vocab[a] << 32) | vocab[b]] = last = made
        self.fill(self.pairs)

    def long(self, piece: bytes) -> list[int]:
        """Ids of one long pre-token, with a heap over linked parts."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n, get = len(ids), self.pairs.get
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = right[i]
            if ids[i] < 0 or j >= n or get(ids[i] << 32 | ids[j]) != r:
                continue
            ids[i], ids[j], right[i] = r, -1, right[j]
            if right[i] < n:
                left[right[i]] = i
                if (q := get(r << 32 | ids[right[i]])) is not None:
                    heapq.heappush(heap, (q, i))
            if left[i] >= 0 and (q := get(ids[left[i]] << 32 | r)) is not None:
                heapq.heappush(heap, (q, left[i]))
        return [x for x in ids if x >= 0]


def table_of(told: dict) -> MergeTable | None:
    """The table of a file, or None where the library has to encode."""
    pre, model = told.get("pre_tokenizer") or {}, told["model"]
    plain = (told.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("add_prefix_space") is False
             and pre.get("use_regex", True) and model.get("type", "BPE") == "BPE"
             and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")))
    if not plain:
        return None
    try:
        return MergeTable(model["vocab"], model["merges"])
    except (ValueError, KeyError):
        return None


class Encoder:
    """Ids of whole texts as the library gives them (``add_special_tokens`` off)."""

    def __init__(self, spec: str) -> None:
        told = json.loads(spec)
        self.table = table_of(told)
        added = [t["content"] for t in told.get("added_tokens") or []]
        self.split = _whole_encoder(spec, added if self.table else [""], True)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and their offsets."""
        whole, rest = self.split(texts.fill_null(""))
        if self.table is None:
            ids, off = np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        else:
            ids, off = encode_texts(*raw(rest), lambda distinct: self.table.merge(*raw(distinct)))
        if not whole:
            return ids, off
        parts, done, size = [], 0, np.diff(off)
        for i in sorted(whole):
            parts += [ids[done:off[i]], whole[i]]
            done, size[i] = off[i], len(whole[i])
        return np.concatenate([*parts, ids[done:]]), np.append(0, np.cumsum(size))


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(spec: str) -> Encoder:
    """The encoder of a file's content, made once per worker process."""
    key = hashlib.sha256(spec.encode()).digest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]
