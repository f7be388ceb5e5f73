import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from marketprep.llm import packing as pk
from marketprep.llm.jsonbpe import Encoder, encoder

from .helpers import SF, awkward, docs_of

PATH = P.path("byte_bpe_50k.json")


def held_by_contract(rows, pieces, path=PATH):
    """Every id of every document lies in one piece, and every sequence is a
    gapless run of pieces, full or as long as a power of two."""
    tok = Tokenizer.from_file(path)
    docs = defaultdict(Counter)
    texts = Counter((d, t or "") for d, t in rows)
    for (d, t), n in texts.items():
        ids = (*tok.encode(t, add_special_tokens=False).ids, 0)
        docs[d][ids] += n
    runs = defaultdict(list)
    for p in pieces:
        runs[p.sequence_id].append(p)
        assert p.length > 0 and p.start + p.length <= p.doc_tokens
    for held in runs.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024 and at & (at - 1) == 0
    # cover each document by pieces (ids of rows may repeat)
    by_id = defaultdict(Counter)
    for p in pieces:
        by_id[p.doc_id][(p.start, p.length, p.ids_crc32, p.doc_tokens)] += 1
    for d, want in docs.items():
        have = by_id.pop(d)
        for ids, n in want.items():
            for _ in range(n):
                at = 0
                while at < len(ids):
                    step = next(k for k in have if k[0] == at and k[3] == len(ids) and have[k]
                                and zlib.crc32(np.array(ids[at:at + k[1]], "<u4").tobytes()) == k[2])
                    have[step] -= 1
                    at += step[1]
        assert not any(have.values())
    assert not by_id


def packed(df, path=PATH, **kw):
    return pk.digests(pk.pack(pk.encoded(df, path), pk.vocabulary_size(path), **kw))


def test_awkward_rows(spark):
    rows = awkward() + [(800, "a <|endoftext|> b"), (801, "<|endoftext|>"), (None, None), (None, None)]
    for kw in ({}, {"shard_rests": 7}):
        held_by_contract(rows, packed(docs_of(spark, rows), **kw).collect())


def test_text_ids_and_other_tokenizers(spark, tmp_path):
    """Ids keep their type; a file with a prefix space is encoded as it says."""
    told = json.load(open(PATH))
    told["pre_tokenizer"]["add_prefix_space"] = True
    own = str(tmp_path / "own.json")
    json.dump(told, open(own, "w"))
    rows = [("a", "one two"), (None, "three  four"), ("b", " five"), ("c", None)]
    assert Tokenizer.from_file(own).encode("one two").ids != Tokenizer.from_file(PATH).encode("one two").ids
    held_by_contract(rows, packed(spark.createDataFrame(rows, "doc_id string, text string"), own).collect(), own)


def odd_texts(n=400):
    rng = np.random.default_rng(9)
    signs = list("aábcdeß中🙂 \t\n'..,-_09²ⅷ\u00a0\u2028\x00\x1f") + ["'s", "'ll", "  ", "aaaa", "====", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs, int(rng.integers(0, 60)))) for _ in range(n)]
    return texts + ["a" * 5000, "=-" * 900, "é" * 700, "zq" * 333 + "中" * 200, "", None]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_library(name):
    spec = open(P.path(name)).read()
    texts = odd_texts()
    enc = Encoder(spec)
    assert (enc.table is None) == (name != "byte_bpe_50k.json")
    ids, off = enc(pa.array(texts))
    tok = Tokenizer.from_str(spec)
    for k, t in enumerate(texts):
        assert ids[off[k]:off[k + 1]].tolist() == tok.encode(t or "", add_special_tokens=False).ids


def test_vocabularies_do_not_mix():
    """Two files that differ in one merge keep their own ids."""
    told = json.load(open(PATH))
    first = encoder(json.dumps(told))(pa.array(["the thing"]))[0].tolist()
    told["model"]["merges"] = told["model"]["merges"][:100]
    other = json.dumps(told)
    assert encoder(other)(pa.array(["the thing"]))[0].tolist() == Tokenizer.from_str(other).encode("the thing").ids != first


def test_empty_table(spark):
    got = packed(docs_of(spark, awkward()).where("false"))
    assert got.collect() == [] and got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_query_on_table(spark):
    from marketprep.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    held_by_contract(rows, QUERIES["op13_retrieval_packing"](spark, SF).collect())


def bm25(units, idf, mean, seed):
    out = []
    for u in units:
        tf = Counter(u)
        out.append(sum(idf[t] * tf[t] * (pk.K1 + 1) / (tf[t] + pk.K1 * (1 - pk.B + pk.B * len(u) / mean))
                       for t in set(units[seed]) if t in tf))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_scores_and_greedy_filling(seed):
    rng = np.random.default_rng(seed)
    units = [rng.integers(0, 60, int(rng.integers(1, 40))).tolist() for _ in range(50)]
    idf = np.maximum(0, rng.normal(1, 1, 61))
    off = np.append(0, np.cumsum([len(u) for u in units]))
    index = pk.Index(np.concatenate(units).astype(np.uint32), off, idf, 20.0)
    for s in range(50):
        assert np.allclose(index.scores(s), bm25(units, idf, 20.0, s))
    size = np.diff(off)
    got = pk.fill(index, size, 64)
    assert all(sum(e - b for _, b, e in held) == 64 for held in got[:-1])
    free, left = set(range(50)), None
    for held in got:
        u, b, e = held[0]
        if left is None:
            assert b == 0 and size[u] == max(size[v] for v in free)
            free.discard(u)
        else:
            assert (u, b) == left
        left = None
        score, room = index.scores(u), 64 - (e - b)
        for v, b2, e2 in held[1:]:
            fits = [x for x in free if score[x] > 0 and size[x] <= room]
            best = max(fits or free, key=lambda x: (score[x], -x))
            assert (v, b2) == (best, 0) and e2 == min(size[v], room)
            free.discard(v)
            room -= e2
            left = (v, e2) if e2 < size[v] else None
    assert not free and left is None


def test_statistics_cover_all_rests(spark):
    table = pk.encoded(docs_of(spark, awkward()), PATH)
    rests = [np.frombuffer(r.rest, "<u4") for r in table.collect() if r.rest]
    count, mean, df = pk._statistics(table, 50257)
    assert count == len(rests) and mean == sum(map(len, rests)) / len(rests)
    assert (df == np.bincount(np.concatenate([np.unique(r) for r in rests]), minlength=50257)).all()


def test_neighbours_meet(spark):
    """Documents of one subject share windows."""
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(f"{'abcdefgh'[k % 8]}{x}" for x in rng.integers(100, 160, 60))) for k in range(160)]
    runs = defaultdict(list)
    for p in packed(docs_of(spark, rows)).collect():
        runs[p.sequence_id].append(p.doc_id % 8)
    same = sum(Counter(r).most_common(1)[0][1] for r in runs.values()) / sum(map(len, runs.values()))
    assert same > 0.7
