import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from marketprep.llm import linededup

from .helpers import BLANK, components, docs_of


def shingles(line):
    return {line[i:i + 7] for i in range(len(line) - 6)} if len(line) >= 7 else {("", line)}


def named(text):
    """Spark's ``xxhash64`` of a text."""
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def brute(rows):
    """(doc, text, line) places that go, by comparing all distinct lines."""
    places = sorted({(d is not None, d, k, x, named(t)) for d, t in rows for k, x in enumerate((t or "").split("\n"))
                     if re.search(BLANK, x)}, key=str)
    lines = sorted({p[3] for p in places})
    s = {x: shingles(x) for x in lines}
    links = [(a, b) for i, a in enumerate(lines) for b in lines[i + 1:]
             if 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])]
    comp = components(lines, links)
    first = {}
    for has, d, k, x, t in places:
        at = (has, d if has else 0, k, t)
        first[comp[x]] = min(first.get(comp[x], at), at)
    return sorted({(d, t, k) for has, d, k, x, t in places if first[comp[x]] != (has, d if has else 0, k, t)}, key=str), links


def gone_of(removed):
    return sorted(((r.doc_id, r.t, r.line) for r in removed.collect()), key=str)


def near(rng, line, edits):
    c = list(line)
    for _ in range(edits):
        c[rng.randrange(len(c))] = rng.choice("abcxyz ")
    return "".join(c)


def cases(seed=1):
    rng = random.Random(seed)
    voc = ["alpha", "bravo", "charlie", "delta", "écho", "fox", "golf", "hôtel", "india", "ju", "kilo", "中文"]
    pool = [" ".join(rng.choice(voc) for _ in range(rng.randrange(3, 60))) for _ in range(40)]
    rows = [(None, pool[0]), (0, None), (1, ""), (2, " \n\t\n"), (3, "abc\nabc\nab\n\nabc"), (4, "x" * 50_000 + "\n" + pool[1])]
    for d in range(5, 45):
        lines = []
        for _ in range(rng.randrange(1, 9)):
            x = rng.choice(pool)
            lines.append(near(rng, x, rng.randrange(4)) if rng.random() < 0.6 else x)
        rows.append((d, "\n".join(lines)))
    return rows


def test_equals_brute_force(spark):
    rows = cases()
    _, removed = linededup.near_copies(docs_of(spark, rows))
    want, links = brute(rows)
    assert len(links) > 30
    assert gone_of(removed) == want
    rep = {r.doc_id: r for r in linededup.report(docs_of(spark, rows)).collect()}
    assert len(rep) == len(rows)
    assert sum(r.n_removed for r in rep.values()) == len(want)
    assert rep[3].n_lines == 4 and rep[0].n_lines == 0 and rep[None].n_lines == 1


def cut(rows):
    """Texts row by row without the lines that go."""
    gone, out = set(brute(rows)[0]), []
    for d, t in rows:
        lines = (t or "").split("\n")
        here = [t is not None and (d, named(t), k) in gone for k in range(len(lines))]
        left = "\n".join(x for x, g in zip(lines, here) if not g)
        if re.search(BLANK, left) or not any(here):
            out.append((d, left if t is not None else None))
    return sorted(out, key=str)


def test_drop_lines(spark):
    """Row by row, with ids that are null or repeat and columns of any name."""
    rng = random.Random(3)
    rows = cases()
    lone = [" ".join(str(rng.randrange(10 ** 6)) for _ in range(10)) for _ in range(20)]
    rows += [(7, rows[8][1].split("\n")[0] + "\n" + lone[0]), (7, lone[1] + "\n" + rows[8][1].split("\n")[0]), (7, lone[2])]
    rows += [(None, lone[3] + "\n" + lone[4]), (None, lone[5] + "\n" + lone[3]), (None, lone[6] + "\n" + lone[7]), (9, lone[8]), (9, lone[8])]
    docs = docs_of(spark, rows).selectExpr("*", "'g' as _gone", "1 as _text", "'x' as gone", "2 as t", "3 as _id", "4 as _t", "'l' as line")
    got = linededup.drop_lines(docs)
    assert got.columns == docs.columns
    left = got.collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == cut(rows)
    assert all((r._gone, r._text, r.gone, r.t) == ("g", 1, "x", 2) for r in left)
    kept = [line for r in left for line in (r.text or "").split("\n")]
    assert all(x in kept for x in lone[:9])
    assert linededup.report(docs).count() == len(rows)


def test_pairs_are_compared_exactly():
    rng = random.Random(6)
    a = ["", "abc", "é中🙂" * 9] + [" ".join(rng.choice(["ab", "cde", "é"]) for _ in range(rng.randrange(1, 40))) for _ in range(200)]
    b = [near(rng, x, rng.randrange(4)) if x else "q" for x in a]
    want = [100 * len(shingles(x) & shingles(y)) >= 80 * len(shingles(x) | shingles(y)) for x, y in zip(a, b)]
    assert linededup.similar(pa.array(a), pa.array(b)).tolist() == want and 20 < sum(want) < 190


def test_banding_recall():
    """Share of near pairs that meet in a bucket, at similarities just above the threshold."""
    rng = random.Random(9)
    voc = [f"{a}{b}" for a in ("th", "er", "on", "an", "re", "ti") for b in ("ed", "ing", "nd", "st", "es", "ou")]
    hit = all_ = 0
    for _ in range(600):
        a = " ".join(rng.choice(voc) for _ in range(rng.randrange(8, 80)))
        b = near(rng, a, rng.randrange(1, 5))
        s, t = shingles(a), shingles(b)
        if a != b and 100 * len(s & t) >= 80 * len(s | t):
            k = linededup.band_keys(pa.array([a.encode(), b.encode()], pa.binary()))
            hit += bool((k[0] == k[1]).any())
            all_ += 1
    assert all_ > 200 and hit >= 0.98 * all_


def test_signatures_estimate_similarity():
    rng = random.Random(4)
    a = " ".join(str(rng.randrange(1000)) for _ in range(300))
    b = a[:1000] + " ".join(str(rng.randrange(1000)) for _ in range(60))
    s, t = shingles(a), shingles(b)
    sig = linededup.signatures(pa.array([a.encode(), b.encode()], pa.binary()))
    assert abs(np.mean(sig[0] == sig[1]) - len(s & t) / len(s | t)) < 0.2


def test_empty_table(spark):
    docs = docs_of(spark, cases()).where("false")
    assert linededup.report(docs).collect() == []
    assert linededup.drop_lines(docs).collect() == []


def test_null_ids_hide_no_link(spark):
    """A bucket whose chain runs through a line that only null-id rows have."""
    rng = random.Random(5)
    rows = []
    for f in range(40):
        base = " ".join(f"{rng.randrange(10 ** 6)}" for _ in range(12))
        for k in range(6):
            rows.append((None if k % 3 else len(rows), near(rng, base, 2)))
    assert gone_of(linededup.near_copies(docs_of(spark, rows))[1]) == brute(rows)[0]


def test_two_texts_under_one_id(spark):
    rng = random.Random(6)
    base = [" ".join(f"{rng.randrange(10 ** 6)}" for _ in range(12)) for _ in range(8)]
    rows = [(1, "short"), (1, "\n".join(base)), (1, "\n".join(near(rng, x, 2) for x in base[:3])), (1, "short"),
            (2, "\n".join(near(rng, x, 2) for x in reversed(base))), (None, base[0]), (None, "a\n\n" + base[1])]
    assert gone_of(linededup.near_copies(docs_of(spark, rows))[1]) == brute(rows)[0]
