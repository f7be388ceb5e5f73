import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from marketprep.llm import bpe
from marketprep.llm.textarrays import raw

from .helpers import SF, awkward, docs_of

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
ENC = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def encode(texts):
    ids, off = bpe.encode_texts(*raw(pa.array(texts, pa.string())), bpe.merging(RANKS))
    return [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab'stremvdl SA1²½é \t\n\r.,!-中🙂́")), max_size=40)))
def test_equals_tiktoken(texts):
    assert encode(texts) == [ENC.encode_ordinary(t) for t in texts]


def test_long_runs():
    rng = random.Random(5)
    texts = ["a" * 5000, " " * 300 + "x", "'" * 100 + "s", "x's's'll've'", "\n" * 70 + " a",
             "".join(rng.choice("abc") for _ in range(3000)), None, ""]
    assert encode(texts) == [ENC.encode_ordinary(t or "") for t in texts]


def test_scan_is_the_automaton():
    """The composed functions agree with running the automaton step by step."""
    rng = random.Random(2)
    text = "".join(rng.choice("ab' s\n1.,tre") for _ in range(2000))
    cp = np.array([ord(c) for c in text], np.uint32)
    first = np.zeros(len(cp), bool)
    first[[0, 700, 701]] = True
    got = bpe.token_starts(cp, first)
    state, want = bpe.FRESH, []
    for s, f in zip(bpe._symbols(cp, first), first):
        state, begins = bpe._step(int(s), bpe.FRESH if f else state)
        want.append(begins)
    assert got.tolist() == want


def test_roundtrip_and_digests(spark):
    rows = awkward()
    docs = docs_of(spark, rows)
    enc = bpe.encode(docs, PATH)
    back = sorted((r.doc_id is None, r.doc_id, bytes(r.body)) for r in bpe.decode(enc, PATH).collect())
    assert back == sorted((i is None, i, (t or "").encode()) for i, t in rows)
    got = sorted(map(str, ((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, PATH).collect())))
    want = []
    for i, t in rows:
        ids = ENC.encode_ordinary(t or "")
        want.append(str((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest())))
    assert got == sorted(want)
    assert bpe.digests(docs.where("false"), PATH).collect() == []


def test_query_on_table(spark):
    from marketprep.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op9_bpe_roundtrip"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = ENC.encode_ordinary(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_missing_byte_is_an_error():
    with pytest.raises(ValueError):
        bpe.PairTable({b"a": 0})


def test_vocabularies_do_not_mix():
    """Two vocabularies alike in size and in their last entries keep their own ids."""
    ranks = bpe.load_ranks(PATH)
    swap = {tok: ranks[tok] for tok in (b" the", b" a")}
    other = {**ranks, b" the": swap[b" a"], b" a": swap[b" the"]}
    a, b = bpe.pair_table(ranks), bpe.pair_table(other)
    assert a is not b and bpe.pair_table(dict(ranks)) is a
