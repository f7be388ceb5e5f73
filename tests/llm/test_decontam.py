import random
import re

import numpy as np

from marketprep.llm import decontam

from .helpers import ALNUM, awkward, docs_of, low


def words(t):
    return re.findall(ALNUM, low(t))


def brute(rows, items, window=10):
    out = []
    grams = []
    for i, t in items:
        w = words(t)
        if w:
            n = min(window, len(w))
            grams += [(i, w[k:k + n]) for k in range(len(w) - n + 1)]
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for i, g in grams:
            for k in range(len(w) - len(g) + 1):
                if w[k:k + len(g)] == g:
                    hit.update(range(k, k + len(g)))
                    found.add(i)
        out.append((d, len(w), len(hit), len(found), decontam.digest([i for i in found if i is not None]), bool(hit)))
    return sorted(map(str, out))


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def cases(seed=1):
    rows = [r for r in awkward() if r[0] not in (6, 7)]
    rng = random.Random(seed)
    voc = [f"v{i}" for i in range(12)]
    rows += [(500 + k, " ".join(rng.choice(voc) for _ in range(200))) for k in range(8)]
    src = words(rows[-1][1])
    items = [(1, " ".join(src[20:45])), (2, "One, TWO"), (3, None), (4, "!!"), (5, " ".join(words(rows[20][1])[5:30])),
             (6, "w1"), (7, " ".join(src[20:45])), (20, " ".join(src[5:10])), (None, "one")]
    return rows, items


def show(df):
    return sorted(str((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in df.collect())


def test_equals_brute_force(spark):
    rows, items = cases()
    index = decontam.build_index(docs_of(spark, rows), segment_bytes=4000)
    want = brute(rows, items)
    assert show(decontam.contamination(index, table(spark, items))) == want
    # the same in several blocks of items
    assert show(decontam.contamination(index, table(spark, items), block_items=2)) == want


def test_empty_tables(spark):
    rows, items = cases()
    docs = docs_of(spark, rows)
    none = table(spark, items).where("false")
    assert show(decontam.contamination(decontam.build_index(docs), none)) == brute(rows, [])
    assert show(decontam.contamination(decontam.build_index(docs.where("false")), table(spark, items))) == []


def test_search_spans_and_proximity(spark):
    rows = [(1, "a b c d e"), (2, "c x a y b"), (3, "a b"), (4, None), (5, "b q q q q q q q a c")]
    index = decontam.build_index(docs_of(spark, rows))
    item = table(spark, [(9, "A b. C")])
    got = decontam.search(index, item).collect()
    assert [(r.doc_id, r.item_id, r.first_word, r.last_word) for r in got] == [(1, 9, 0, 2)]
    near = {r.doc_id for r in decontam.search(index, item, slop=4).collect()}
    assert near == {1, 2}
    assert {r.doc_id for r in decontam.search(index, item, slop=9).collect()} == {1, 2, 5}


def test_packed_lists():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 1 << 33, 500) >> rng.integers(0, 33, 500)
    off = np.array([0, 0, 7, 400, 500])
    a = decontam.pack(v, off)
    from marketprep.llm.textarrays import raw
    got, n = decontam.unpack(*raw(a))
    assert got.tolist() == v.tolist() and n.tolist() == [0, 7, 393, 100]


def test_clean(spark):
    rows, items = cases()
    docs = docs_of(spark, rows)
    got = decontam.clean(docs, table(spark, items))
    assert got.columns == docs.columns
    want = [r for r in rows if not eval(brute([r], items)[0])[5]]
    assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == sorted(map(str, want)) and len(want) < len(rows)


def test_rows_and_items_without_ids(spark):
    """Clean rows stay whatever id they share with a contaminated one, and items
    without an id count."""
    passage = " ".join(f"p{k}" for k in range(14))
    rows = [(None, f"a {passage} b"), (None, "clean one"), (None, "clean two"), (5, passage), (5, "clean three"), (6, None)]
    docs = docs_of(spark, rows)
    items = spark.createDataFrame([(None, passage), (3, "nothing of this"), (None, "other words")], "item_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in decontam.clean(docs, items).collect()), key=str)
    assert got == sorted([r for r in rows if passage not in (r[1] or "")], key=str)
    both = spark.createDataFrame([(None, passage), (3, passage)], "item_id long, text string")
    index = decontam.build_index(docs)
    hits = {(r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in decontam.contamination(index, both).collect()}
    assert hits == {(16, 14, 2, decontam.digest([3])), (14, 14, 2, decontam.digest([3])), (2, 0, 0, decontam.digest([])), (0, 0, 0, decontam.digest([]))}
    assert {r.item_id for r in decontam.search(index, both).collect()} == {None, 3}
