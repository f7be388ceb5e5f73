import random
import re
import zlib
from collections import Counter

from marketprep.llm import spelling as sp

from ..conftest import plan_text
from .helpers import SF, awkward, docs_of, low


def counted(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = low(run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[i + 1:] == b[i + 1:]
    a, b = sorted((a, b), key=len)
    return a[i:] == b[i + 1:]


def want(rows):
    n = counted(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(near[w]), form[w] and n[form[w]]) for w in n}


def show(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def variants_of(rng, word):
    k = rng.randrange(len(word) + 1)
    c = rng.choice("abcdeéÀß")
    return rng.choice([word[:k] + c + word[k:], word[:k] + word[k + 1:], word[:k] + c + word[k + 1:]])


def test_awkward_rows(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdeéÀÿ") for _ in range(rng.randint(4, 12))) for _ in range(60)]
    base += [variants_of(rng, w) for w in base for _ in range(3)]
    base += [variants_of(rng, w) for w in base[60:140]]
    rows = awkward()
    for d in range(300):
        rows.append((1000 + d if d % 9 else None, " ".join(rng.choice(base[:1 + d % len(base)]) for _ in range(60))))
    rows += rows[-20:] + [(7000, "İStanbul KKelvin x×y÷z STRASSE straße"), (7001, "ABCDEFGH1abcdefgh-ÉTUDE " * 9)]
    got = show(sp.variants(docs_of(spark, rows)))
    assert got == want(rows)
    assert any(f is not None and r != f for f, r, *_ in got.values())     # a path of several forms
    assert len(got) > 60


def test_every_single_edit_is_found(spark):
    """Words of every length and all their neighbours by one edit."""
    rng = random.Random(3)
    words = set()
    for size in range(5, 12):
        w = "".join(rng.choice("abc") for _ in range(size))
        words |= {w} | {w[:k] + c + w[k:] for k in range(size + 1) for c in "abz"}
        words |= {w[:k] + c + w[k + 1:] for k in range(size) for c in "abz"} | {w[:k] + w[k + 1:] for k in range(size)}
    words = sorted(w for w in words if len(w) >= 5)
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = [(r.word, r.other) for r in sp.near_pairs(df).collect()]
    assert len(got) == len(set(got))
    assert {frozenset(p) for p in got} == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}


def test_long_paths(spark):
    """Roots at the end of paths longer than one jump."""
    path = [(f"w{k:02}", f"w{k + 1:02}") for k in range(37)] + [("z", None)]
    df = spark.createDataFrame(path, "word string, form string")
    got = {r.word: r.root for r in sp.roots(df).collect()}
    assert got == {f"w{k:02}": "w37" for k in range(37)}


def test_no_join_goes_through_the_driver(spark, monkeypatch):
    """Also where the words' table is small enough for Spark to broadcast it."""
    plans, write = [], sp.write_table
    monkeypatch.setattr(sp, "write_table", lambda df, name: plans.append(plan_text(df)) or write(df, name))
    rng = random.Random(2)
    base = ["".join(rng.choice("abcde") for _ in range(8)) for _ in range(30)]
    base += [variants_of(rng, w) for w in base]
    rows = [(d, " ".join(rng.choice(base[:5 + d % 55]) for _ in range(60))) for d in range(40)]
    out = sp.variants(docs_of(spark, rows))
    assert show(out) == want(rows)
    plans.append(plan_text(out))                              # as it was run
    assert sum("SortMergeJoin" in p for p in plans) >= 3      # near words, roots, the rows
    assert not [p for p in plans if "Broadcast" in p]


def test_empty_table(spark):
    df = docs_of(spark, awkward())
    assert sp.variants(df.where("false")).collect() == []
    assert sp.variants(df.where("doc_id < 4")).collect() == []


def test_query_on_table(spark):
    from marketprep.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = show(QUERIES["op12_spelling_variants"](spark, SF))
    assert got == want(rows) and got
