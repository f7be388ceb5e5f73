"""Small tables and brute-force versions shared by these tests."""

from __future__ import annotations

import random
import re

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

BLANK = "[^\x20\x09-\x0D]+"
ALNUM = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def low(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def docs_of(spark, rows):
    """A documents table of ``(doc_id, text)`` rows, with columns whose names
    the operators use inside."""
    full = [(i, t, "en", "s", len(t) if t is not None else None, "x", 1, "y", 0.5) for i, t in rows]
    return spark.createDataFrame(full, DOCS + ", node string, component_id long, kept string, score double")


def awkward(seed: int = 3) -> list[tuple[int | None, str | None]]:
    """Nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["é", "ß中", "The", "the", "A-b"]
    long_ = " ".join(rng.choice(words) for _ in range(30_000))
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(6)]
    rows: list[tuple[int | None, str | None]] = [(0, None), (1, ""), (2, "   \n\t"), (3, "one"), (4, "one two"),
                                                 (5, "one two"), (6, long_), (7, long_), (None, base[0])]
    for k, t in enumerate(base):
        w = t.split()
        rows += [(10 + 10 * k, t), (11 + 10 * k, t), (12 + 10 * k, " ".join(w[:60] + ["new"] + w[61:])),
                 (13 + 10 * k, " ".join(w[2:])), (14 + 10 * k, t + "\n" + t)]
    rows.append((10, base[0]))          # a repeated row
    return rows


def components(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}
