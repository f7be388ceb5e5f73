"""Token ids in seekable files of independent zstandard frames.

A file is a row of zstandard frames that each hold whole documents, then a
skippable frame with the document index, then a skippable frame with the seek
table: compressed size, content size and checksum of every frame, as in the
public seekable format, so any zstandard reader can decompress the file and a
reader of this module only fetches and decompresses the frames it needs.  Ids
are little-endian, two bytes each where the vocabulary allows it, else four.

Documents are range-partitioned and sorted by id before they are encoded; each
task writes one file under a name of its own attempt and reports it in a row,
and only reported files are ever read, so a lost or repeated task leaves
nothing wrong behind.

Defined cases: a null text counts as empty and yields just the end id; a null
``doc_id`` sorts first; rows that share an id follow each other, ordered by
text; an empty table makes no file.  Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encode_texts
from .shared import shared_path, ship, write_table
from .textarrays import raw, slices

# --------------------------------------------------------------------------
# FIXED VALUES (of the public zstandard and seekable formats)
# --------------------------------------------------------------------------
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

# A frame is closed once it holds this many ids.
FRAME_IDS = 1 << 16
LEVEL = 3
SLICE_BYTES = 6 << 20


class Corrupt(ValueError):
    """A frame or table does not match its checksum."""


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class FileWriter:
    """Writes one file; ``put`` takes documents in order."""

    def __init__(self, out, width: int) -> None:
        self.out, self.width = out, width
        self.kind = {2: "<u2", 4: "<u4"}[width]
        self.zip = zstandard.ZstdCompressor(level=LEVEL)
        self.held: list[bytes] = []
        self.held_ids = 0
        self.seek: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.frames: list[int] = []

    def put(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(ids))
        self.frames.append(len(self.seek))
        self.held.append(ids.astype(self.kind).tobytes())
        self.held_ids += len(ids)
        if self.held_ids >= FRAME_IDS:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            body = b"".join(self.held)
            z = self.zip.compress(body)
            self.out.write(z)
            self.seek.append((len(z), len(body), xxhash.xxh64_intdigest(body) & 0xFFFFFFFF))
            self.held, self.held_ids = [], 0

    def close(self) -> None:
        self._flush()
        n = len(self.ids)
        valid = np.array([x is not None for x in self.ids], np.uint8)
        table = b"".join((struct.pack("<QB", n, self.width), valid.tobytes(),
                          np.array([x or 0 for x in self.ids], "<i8").tobytes(),
                          np.array(self.sizes, "<u8").tobytes(), np.array(self.frames, "<u4").tobytes()))
        z = self.zip.compress(table)
        index = _skippable(SKIPPABLE_INDEX, z)
        self.out.write(index)
        entries = [*self.seek, (len(index), 0, xxhash.xxh64_intdigest(z) & 0xFFFFFFFF)]
        body = b"".join(struct.pack("<III", *e) for e in entries)
        self.out.write(_skippable(SKIPPABLE_SEEK, body + struct.pack("<IBI", len(entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)))


@dataclass
class FileReader:
    """Reads a file's tables, then only the frames asked for."""

    source: pa.NativeFile

    def __post_init__(self) -> None:
        size = self.source.size()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise Corrupt("no seek table")
        e = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.entries = e[:-1]
        self.begin = np.append(0, np.cumsum(self.entries[:, 0]))
        z = self._at(int(self.begin[-1]) + 8, int(e[-1, 0]) - 8)
        if xxhash.xxh64_intdigest(z) & 0xFFFFFFFF != e[-1, 2]:
            raise Corrupt("the document index does not match its checksum")
        self.unzip = zstandard.ZstdDecompressor()
        table = self.unzip.decompress(z)
        docs, self.width = struct.unpack_from("<QB", table)
        at = 9
        valid = np.frombuffer(table, np.uint8, docs, at)
        at += docs
        ids = np.frombuffer(table, "<i8", docs, at)
        self.ids = [int(x) if v else None for x, v in zip(ids, valid)]
        self.sizes = np.frombuffer(table, "<u8", docs, at + 8 * docs).astype(np.int64)
        self.frames = np.frombuffer(table, "<u4", docs, at + 16 * docs).astype(np.int64)

    def _at(self, pos: int, size: int) -> bytes:
        self.source.seek(pos)
        return self.source.read(size)

    def frame(self, k: int) -> np.ndarray:
        """Ids of one frame, checked."""
        z, size, check = map(int, self.entries[k])
        body = self.unzip.decompress(self._at(int(self.begin[k]), z), max_output_size=size)
        if len(body) != size or xxhash.xxh64_intdigest(body) & 0xFFFFFFFF != check:
            raise Corrupt(f"frame {k} does not match its checksum")
        return np.frombuffer(body, {2: "<u2", 4: "<u4"}[self.width])

    def documents(self, only: Sequence[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """``(number in the file, ids)`` of all documents, or of those whose
        number is in ``only`` (decompresses their frames alone)."""
        pick = np.arange(len(self.ids)) if only is None else np.array(sorted(only), np.int64)
        before = np.cumsum(self.sizes) - self.sizes
        now, ids, base = -1, np.zeros(0, np.uint16), 0
        for i in pick:
            if self.frames[i] != now:
                now = int(self.frames[i])
                ids = self.frame(now)
                base = int(before[np.searchsorted(self.frames, now)])
            lo = int(before[i]) - base
            yield int(i), ids[lo:lo + int(self.sizes[i])]


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


# Distinct pre-tokens whose ids a worker remembers; beyond that it starts anew.
CACHE_PIECES = 400_000
_ENCODERS: dict[tuple[str, int], tuple] = {}


def _piece_encoder(spec: str):
    """Ids of distinct pre-tokens by the tokenizers library, remembered within
    the worker up to a fixed number.

    Pre-tokenisation is the library's own rule applied to the whole text (see
    ``bpe``); a pre-token alone is split no further, so encoding each distinct
    one once gives the ids of the whole text."""
    import os
    key = (str(hash(spec)), len(spec))
    if key not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(spec)
        tok.encode_special_tokens = True
        _ENCODERS[key] = (tok, {})
    tok, seen = _ENCODERS[key]

    def ids(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces = distinct.cast(pa.string()).to_pylist()
        new = [p for p in pieces if p not in seen]
        if len(seen) + len(new) > CACHE_PIECES:
            seen.clear()
            new = pieces
        for lo in range(0, len(new), 8192):
            part = new[lo:lo + 8192]
            for p, e in zip(part, tok.encode_batch_fast(part, add_special_tokens=False)):
                seen[p] = np.array(e.ids, np.uint32).tobytes()
        found = [seen[p] for p in pieces]
        off = np.zeros(len(found) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4, out=off[1:])
        return np.frombuffer(b"".join(found), np.uint32), off

    return ids


def _whole_encoder(spec: str, names: Sequence[str], special: bool):
    """Ids of the texts that hold one of the added tokens ``names``, by row, and
    the column without them.  Such a token may stand across pre-tokens, so
    these texts go to the library whole."""
    made: list = []

    def split(texts: pa.Array) -> tuple[dict[int, np.ndarray], pa.Array]:
        has = np.zeros(len(texts), bool)
        for name in names:
            has |= pc.match_substring(texts, name).fill_null(False).to_numpy(zero_copy_only=False)
        if not has.any():
            return {}, texts
        if not made:
            from tokenizers import Tokenizer
            made.append(Tokenizer.from_str(spec))
            made[0].encode_special_tokens = not special
        whole = {int(i): np.array(made[0].encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
                 for i in np.flatnonzero(has)}
        return whole, pc.if_else(pa.array(has), pa.scalar("", texts.type), texts)

    return split


def write_files(docs: DataFrame, tokenizer_json: str, end_id: int, id_col: str = "doc_id",
                text_col: str = "text", folder: str | None = None, special: bool = False) -> DataFrame:
    """Encode all documents, append ``end_id`` to each, and write the files.

    With ``special``, the name of a special token in a text is that token, as
    is the library's default; without, it is text like any other.  Returns the manifest ``(file_no, path, n_docs, n_tokens)``, itself a table
    in the shared folder; ``file_no`` order is ascending ``doc_id`` order.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_json) as f:
        bc = spark.sparkContext.broadcast(f.read())               # a vocabulary file: fixed size
    folder = folder or shared_path(spark, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json
        spec = bc.value
        told = json.loads(spec)
        added = told.get("added_tokens") or []
        width = 2 if max([*told["model"]["vocab"].values(), *(t["id"] for t in added), end_id]) < 1 << 16 else 4
        encoder = _piece_encoder(spec)
        split = _whole_encoder(spec, [t["content"] for t in added if special or not t["special"]], special)
        ctx = TaskContext.get()
        writer, n_docs, n_ids = None, 0, 0
        for b in slices(batches, "text", SLICE_BYTES):
            if writer is None:
                fs, top = _filesystem(folder)
                fs.create_dir(top, recursive=True)
                name = f"part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}.zst"
                stream = fs.open_output_stream(f"{top}/{name}", compression=None)
                writer = FileWriter(stream, width)
            whole, rest = split(b.column(1))
            ids, off = encode_texts(*raw(rest), encoder)
            for i, doc in enumerate(b.column(0).to_pylist()):
                writer.put(doc, np.append(whole.get(i, ids[off[i]:off[i + 1]]), np.uint32(end_id)))
            n_docs, n_ids = n_docs + b.num_rows, n_ids + len(ids) + sum(map(len, whole.values())) + b.num_rows
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([ctx.partitionId()], pa.int64()), pa.array([f"{folder.rstrip('/')}/{name}"]),
                 pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())],
                ["file_no", "path", "n_docs", "n_tokens"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    files = (src.repartitionByRange(F.col("doc_id").asc_nulls_first())
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
             .mapInArrow(run, "file_no long, path string, n_docs long, n_tokens long"))
    return write_table(files, "manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the
    files: ``start`` counts the ids of all documents before it, the checksum is
    over its ids as little-endian unsigned 32-bit integers."""
    ship(manifest.sparkSession)
    # one row a file: small beside the data whatever the corpus
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("file_no").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    # a partition per file: the rows are tiny, what they name is not, so the
    # number is given (else Spark would gather them all in one task)
    files = manifest.select("file_no", "path", before.alias("base")).repartition(max(1, manifest.count()), "file_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                fs, path = _filesystem(r["path"])
                with fs.open_input_file(path) as source:
                    reader = FileReader(source)
                    start = r["base"] + np.cumsum(reader.sizes) - reader.sizes
                    crc = np.zeros(len(reader.ids), np.int64)
                    for i, ids in reader.documents():
                        crc[i] = zlib.crc32(ids.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.ids, pa.int64()), pa.array(start, pa.int64()),
                     pa.array(reader.sizes, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("path", "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(path: str, doc_ids: Sequence[int]) -> dict[int, np.ndarray]:
    """Ids of a few documents of one file; decompresses only their frames."""
    fs, p = _filesystem(path)
    with fs.open_input_file(p) as source:
        reader = FileReader(source)
        want = set(doc_ids)
        only = [i for i, d in enumerate(reader.ids) if d in want]
        return {reader.ids[i]: ids.copy() for i, ids in reader.documents(only)}
