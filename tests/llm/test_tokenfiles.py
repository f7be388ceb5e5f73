import io
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import zstandard
from tokenizers import Tokenizer

from marketprep.llm import tokenfiles as tf

from .helpers import SF, awkward, docs_of

PATH = P.path("byte_bpe_50k.json")


def want_of(rows):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def show(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


def test_awkward_rows(spark):
    rows = awkward() + [(800, "<|endoftext|> a"), (801, "x's 'll\n\n  y")]
    manifest = tf.write_files(docs_of(spark, rows), PATH, 2)
    assert show(tf.read_files(manifest)) == want_of(rows)
    paths = [r.path for r in manifest.collect()]
    got = {}
    for p in paths:
        got |= tf.fetch(p, [10, 800])
    assert len(got) == 2 and got[800][-1] == 2


def test_empty_table(spark):
    manifest = tf.write_files(docs_of(spark, awkward()).where("false"), PATH, 2)
    assert manifest.collect() == [] and tf.read_files(manifest).collect() == []


def test_query_on_table(spark):
    from marketprep.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert show(QUERIES["op6_token_files"](spark, SF)) == want_of(rows)


class Counting(io.BytesIO):
    read_bytes = 0

    def read(self, n=-1):
        got = super().read(n)
        self.read_bytes += len(got)
        return got

    def size(self):
        return len(self.getvalue())


def file_of(n=400, width=2):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, int(rng.integers(0, 2000))).astype(np.uint32) for _ in range(n)]
    out = io.BytesIO()
    w = tf.FileWriter(out, width)
    for i, d in enumerate(docs):
        w.put(i if i % 50 else None, d)
    w.close()
    return docs, out.getvalue()


@pytest.mark.parametrize("width", [2, 4])
def test_only_needed_frames_are_read(width):
    docs, body = file_of(width=width)
    source = Counting(body)
    r = tf.FileReader(source)
    assert len(r.entries) > 3
    assert all((a == b).all() for (_, a), b in zip(r.documents(), docs))
    source.read_bytes = 0
    (i, ids), = r.documents([7])
    assert i == 7 and (ids == docs[7]).all()
    assert source.read_bytes == r.entries[r.frames[7], 0]


def test_any_zstandard_reader_reads_it():
    docs, body = file_of()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(body), read_across_frames=True).read()
    assert whole == b"".join(d.astype("<u2").tobytes() for d in docs)


def test_damage_is_found():
    docs, body = file_of()
    r = tf.FileReader(Counting(body))
    bad = bytearray(body)
    bad[int(r.begin[1]) + 40] ^= 0xFF
    with pytest.raises((tf.Corrupt, zstandard.ZstdError)):
        list(tf.FileReader(Counting(bytes(bad))).documents())
    with pytest.raises(tf.Corrupt):
        tf.FileReader(Counting(body[:-1] + b"x"))


def test_special_tokens_as_the_library_does(spark, tmp_path):
    """The query's ids are those of an unmodified tokenizer over whole texts."""
    from marketprep.llm.queries import QUERIES
    rows = awkward() + [(800, "a <|endoftext|> b"), (801, "<|endoftext|>"), (802, "x<|endoftext|><|endoftext|>\n\n y"),
                        (803, "<|endoftext| >"), (None, "n <|endoftext|>")]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    tok = Tokenizer.from_file(PATH)
    assert tok.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    want, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert show(QUERIES["op6_token_files"](spark, str(tmp_path))) == want
