import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketprep.llm import components as components_module
from marketprep.llm import ngramjoin
from marketprep.llm.components import components as spark_components

from .helpers import BLANK, awkward, components, docs_of, low


def shingles(t):
    w = re.findall(BLANK, low(t))
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())


def brute(rows):
    s = [shingles(t) for _, t in rows]
    live = [i for i, (d, _) in enumerate(rows) if d is not None and s[i]]
    links = [(i, j) for a, i in enumerate(live) for j in live[a + 1:]
             if 100 * len(s[i] & s[j]) >= 90 * len(s[i] | s[j])]
    comp = components({rows[i][0] for i in live}, [(rows[i][0], rows[j][0]) for i, j in links])
    out = []
    for i, (d, _) in enumerate(rows):
        out.append((d, len(s[i]), comp.get(d, d) if i in live else d, sum(i in x for x in links)))
    return sorted(map(str, out))


def show(df):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id, r.n_links)) for r in df.collect())


def family(seed, n, size, edits):
    rng = random.Random(seed)
    base = [f"t{rng.randrange(5000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(size)] = f"u{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_awkward_rows(spark):
    rows = awkward()
    assert show(ngramjoin.join(docs_of(spark, rows))) == brute(rows)
    assert ngramjoin.join(docs_of(spark, rows).where("false")).collect() == []


def test_families(spark):
    """Groups in which many pairs lie on both sides of the threshold, of all sizes."""
    rows, k = [], 0
    for seed, (n, size, edits) in enumerate([(40, 150, 6), (30, 60, 3), (25, 30, 2), (20, 12, 1), (25, 500, 20),
                                             (6, 3000, 90), (15, 9, 1), (15, 20, 1)]):
        for t in family(seed, n, size, edits):
            rows.append((k * 7 % 1009, t))
            k += 1
    passage = " ".join(f"p{i}" for i in range(50))
    rows += [(2000 + i, passage + " " + " ".join(f"q{i}x{j}" for j in range(i))) for i in range(40)]
    want = brute(rows)
    assert sum(eval(x)[3] > 0 for x in want) > 80
    assert show(ngramjoin.join(docs_of(spark, rows))) == want


def test_linking_sets_share_a_block():
    """The block keys lose no pair: sets that just link, at many sizes."""
    rng = np.random.default_rng(4)
    for n in [*range(1, 60), 75, 100, 155, 230, 500, 1200, 5000]:
        for _ in range(6):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            for grow in (0, 1):
                d = (2 * n) // 19 if not grow else n // 9
                if grow:
                    b = np.append(a, rng.integers(0, 1 << 63, d).astype(np.uint64))
                else:
                    b = np.append(a[d // 2:], rng.integers(0, 1 << 63, d // 2).astype(np.uint64))
                o, u = len(np.intersect1d(a, b)), len(np.union1d(a, b))
                if 100 * o >= 90 * u:
                    keys = np.intersect1d(ngramjoin.block_keys(np.unique(a)), ngramjoin.block_keys(np.unique(b)))
                    assert len(keys), (n, grow)


def test_drop_copies(spark):
    rows = [r for r in awkward() if r[0] is not None]
    docs = docs_of(spark, rows)
    got = ngramjoin.drop_copies(docs)
    assert got.columns == docs.columns
    keep = {eval(x)[0] for x in brute(rows) if eval(x)[0] == eval(x)[2]}
    assert sorted(r.doc_id for r in got.collect()) == sorted(d for d, _ in rows if d in keep)


def test_rows_that_share_an_id(spark):
    """Each row links by its own text; a row of an id goes without the others; the SQL says the same."""
    import duckdb
    import pyarrow as pa

    from marketprep.llm.queries import ORACLE_SQL

    a, b, c, e = (" ".join(f"{x}{i}" for i in range(80)) for x in "abce")
    near = lambda t, k: t.replace(f"{t[0]}{k} ", "new ")
    rows = [(1, a), (2, a), (2, b), (3, near(b, 40)), (4, c), (4, e), (5, near(c, 9)), (6, near(e, 30)), (4, c), (0, near(a, 50)),
            (7, None), (7, "one"), (None, b), (7, a + " " + b), (8, b.upper()), (8, b)]
    s = [shingles(t) for _, t in rows]
    live = [i for i, (d, _) in enumerate(rows) if d is not None and s[i]]
    links = [(i, j) for i in live for j in live if i < j and 100 * len(s[i] & s[j]) >= 90 * len(s[i] | s[j])]
    comp = components(range(len(rows)), links)
    want = sorted(str((d, len(s[i]), min((rows[j][0] for j in comp if comp[j] == comp[i]), default=None) if d is not None else None,
                       sum(i in x for x in links))) for i, (d, _) in enumerate(rows))
    docs = docs_of(spark, rows)
    assert show(ngramjoin.join(docs)) == want
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]}))
    assert sorted(str(r) for r in con.sql("SELECT doc_id, n_shingles, component_id, n_links FROM (" + ORACLE_SQL["op10_ngram_join"]
                                          + ")").fetchall()) == want

    kept = [(r.doc_id, r.text) for r in ngramjoin.drop_copies(docs).collect()]
    # one text of each component, rows without words or id, and both equal rows
    assert sorted(kept, key=str) == sorted(
        [(0, near(a, 50)), (2, b), (4, c), (4, c), (4, e), (7, None), (7, "one"), (None, b), (7, a + " " + b)], key=str)


def test_components_leave_no_shuffle_files(spark, monkeypatch):
    """Whether a round was the last is found by shuffling all edges."""
    monkeypatch.setattr(components_module, "LOCAL_EDGES", 2000)

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        all_ = (found.apply(k) for k in range(found.size()))
        return {f.getName(): f.length() for f in all_ if f.getName().startswith("shuffle_")}

    df = spark.range(60_000, numPartitions=40).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    before = files()
    out = spark_components(df.orderBy(F.xxhash64("src")))
    left = {n: size for n, size in files().items() if n not in before}
    assert sum(left.values()) < 50_000, left
    assert out.select("component").distinct().count() == 1


@pytest.mark.parametrize("local", [None, 40])
def test_components(spark, monkeypatch, local):
    """In one task, and in many that leave rounds to do."""
    if local:
        monkeypatch.setattr(components_module, "LOCAL_EDGES", local)
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(350)]
    edges += [(1000 + i, 1001 + i) for i in range(120)] + [(2000, 2000 + i) for i in range(200)] + [(7, 7), (-5, 3)]
    df = spark.createDataFrame([*edges, (None, 3)], "src long, dst long").repartition(5)
    got = {r.node: r.component for r in spark_components(df).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == components({x for e in real for x in e}, real)
    assert spark_components(df.where("false")).collect() == []


def test_five_words_and_80(spark):
    """The pipeline's stage links what only five words and 0.8 link, and equals brute force."""
    import corpus_pipeline

    def five(t):
        w = re.findall(BLANK, low(t))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())

    base = [f"w{i}" for i in range(100)]
    edit = base[:30] + ["x"] + base[31:70] + ["y"] + base[71:]
    rows = [(1, " ".join(base)), (2, "\n".join(" ".join(edit[i:i + 7]) for i in range(0, 100, 7)))]
    assert len(brute(rows)) == 2 and all(eval(x)[3] == 0 for x in brute(rows))
    rows += [(3, "a"), (4, "a b"), (5, "b a"), (6, "a b c d"), (7, "A b c d"), (8, "")]
    for seed, (n, size, edits) in enumerate([(40, 150, 8), (25, 30, 2), (20, 12, 1), (25, 400, 20), (15, 9, 1)]):
        rows += [(100 * (seed + 1) + i, t) for i, t in enumerate(family(50 + seed, n, size, edits))]
    s = [five(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
             if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j])]
    comp = components([d for d, _ in rows], [(rows[i][0], rows[j][0]) for i, j in links])
    assert comp[2] == 1 and comp[7] == 6 and len(links) > 50
    got = corpus_pipeline.ngram_join(spark, docs_of(spark, rows), "")
    assert sorted(r.doc_id for r in got.collect()) == sorted(d for d, c in comp.items() if d == c)
    deep = ngramjoin.join(docs_of(spark, rows), words=5, percent=80)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in deep.collect()) == sorted(
        (d, len(s[i]), comp[d], sum(i in x for x in links)) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("percent", [80, 90])
def test_linking_sets_share_a_block_at(percent):
    rng = np.random.default_rng(7)
    for n in [*range(1, 60), 75, 100, 155, 230, 500, 1200]:
        for _ in range(6):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            for d in {n * (100 - percent) // percent, n * (100 - percent) // 100}:
                for b in (np.append(a, a[:d] + np.uint64(1)), a[d:],
                          np.append(a[d // 2:], a[:d // 2] + np.uint64(1))):
                    o, u = len(np.intersect1d(a, b)), len(np.union1d(a, b))
                    if o and 100 * o >= percent * u:
                        x, y = (ngramjoin.block_keys(np.unique(v), percent) for v in (a, b))
                        assert len(np.intersect1d(x, y)), (n, d)
