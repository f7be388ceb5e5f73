import re
from collections import Counter

import numpy as np
import pyarrow as pa

from marketprep.llm import quality
from marketprep.llm.textarrays import raw

from .helpers import BLANK, SF, awkward, docs_of


def brute(t):
    t = t or ""
    w = re.findall(BLANK, t)
    win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    c, cov = Counter(win), set()
    for i, x in enumerate(win):
        if c[x] > 1:
            cov.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(BLANK, line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), dup, len(cov)


def test_base_counts(spark):
    rows = awkward() + [(900, "a b c d e f g h a b c d e f g h x"), (901, "x\nx\n\n\nx\n"), (902, "#a*b | <é>")]
    texts = [t for _, t in rows]
    base, _ = quality.statistics(*raw(pa.array(texts, pa.string())))
    got = list(zip(*(base[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert got == [brute(t) for t in texts]


def test_constraints_hold_everywhere():
    rng = np.random.default_rng(1)
    x = rng.random((600, 3))
    y = ((x[:, 0] + 0.4 * np.sin(9 * x[:, 1]) + 0.2 * rng.standard_normal(600)) < 0.6).astype(float)
    m = quality.fit(x, y, monotone=(-1, 0, 1))
    probe = rng.random((200, 3))
    for j, sign in ((0, -1), (2, 1)):
        grid = np.repeat(probe, 25, 0)
        grid[:, j] = np.tile(np.linspace(0, 1, 25), 200)
        assert (sign * np.diff(m.score(grid).reshape(200, 25), axis=1) >= -1e-12).all()


def test_flat_trees_equal_recursion():
    rng = np.random.default_rng(2)
    x, = (rng.random((300, 4)),)
    y = (x[:, 0] > x[:, 1]).astype(float)
    m = quality.fit(x, y, n_trees=8, monotone=(0, 0, 0, 0))

    def walk(node, row):
        while m.left[node] != node:
            node = m.left[node] if row[m.feature[node]] <= m.split[node] else m.right[node]
        return m.value[node]
    want = [1 / (1 + np.exp(-(m.start + sum(walk(r, row) for r in m.roots)))) for row in x]
    assert np.allclose(m.score(x), want)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    got = quality.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r for r in got if r.quality == 1]
    assert sum(r.score >= 0.5 for r in good) >= 0.97 * len(good)
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in got)
    assert right >= 0.95 * len(got)


def test_repeated_ids_train_once(spark):
    """Rows that share an id count as one, so the fit is that of the rows without repeats."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    many = docs.unionByName(docs).unionByName(docs.where("doc_id % 2 = 0"))
    texts = [r.text for r in docs.select("text").collect()]
    _, x = quality.statistics(*raw(pa.array(texts, pa.string())))
    one, two = (quality.train(d, labels) for d in (docs, many))
    assert np.array_equal(one.score(x), two.score(x))


def test_cases_and_keep(spark):
    docs = docs_of(spark, awkward())
    none = docs.selectExpr("doc_id", "cast(null as int) as quality")
    assert quality.train(docs, none) is None
    got = quality.judge(docs, None).collect()
    assert len(got) == docs.count()
    assert all(r.kept != r.base_failed for r in got)
    kept = quality.keep(docs, None)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in got)
    assert quality.judge(docs.where("false"), None).collect() == []


def test_query_on_table(spark):
    from marketprep.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op1_quality_rules"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n, chars, sym, dup, rep = brute(r.text)
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (n, chars, sym, dup, rep)
        assert g.base_failed == (n < 20 or 100 * rep > 30 * n)
        assert not (g.base_failed and g.kept)
