import os
import re
from collections import Counter

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from marketprep.llm import bpe, linededup, ngramjoin
from marketprep.llm import components as components_module
from marketprep.llm.shared import shared_path

from . import test_decontam, test_linededup, test_ngramjoin
from .helpers import SF, awkward, docs_of


def test_stages_against_brute_force(spark):
    """Each stage against its brute-force version on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "ngram_join", "decontamination", "byte_level_bpe"]
    steps = dict(corpus_pipeline.STAGES)

    one = steps["quality_rules"](spark, docs, SF)
    assert one.columns == columns
    kept = {r.doc_id: r.text for r in one.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1 and len(re.findall(r"\S+", rows[d].text)) >= 20]
    assert sum(d in kept for d in good) >= 0.97 * len(good)

    two = steps["line_dedup"](spark, one, SF)
    gone = set(test_linededup.brute(sorted(kept.items()))[0])
    want = {}
    for d, t in kept.items():
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if (d, test_linededup.named(t), k) not in gone)
        if re.search(r"[^\x20\x09-\x0D]", left):
            want[d] = left
    got = {r.doc_id: r for r in two.collect()}
    assert two.columns == columns
    assert {d: r.text for d, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())

    three = steps["ngram_join"](spark, two, SF)
    comp = [eval(x) for x in test_ngramjoin.brute(sorted(want.items()))]
    left = {d for d, _, c, _ in comp if d == c}
    assert {r.doc_id for r in three.collect()} == left

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {}
    for i, t in items:
        w = test_decontam.words(t)
        for k in range(max(1, len(w) - 9)):
            if w:
                grams.setdefault(tuple(w[k:k + 10]), i)
    sizes = {len(g) for g in grams}

    def dirty(t):
        w = test_decontam.words(t)
        return any(tuple(w[k:k + n]) in grams for n in sizes for k in range(len(w) - n + 1))
    four = steps["decontamination"](spark, three, SF)
    clean = {d for d in left if not dirty(want[d])}
    assert {r.doc_id for r in four.collect()} == clean
    assert four.columns == columns

    ranks = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    five = {r.doc_id: r.token_ids for r in steps["byte_level_bpe"](spark, four, SF).collect()}
    assert five == {d: enc.encode_ordinary(want[d]) for d in clean}
    assert {r.doc_id: r.token_ids for r in corpus_pipeline.run(spark, SF).collect()} == five


def tables(spark) -> Counter:
    """Names of the tables in the shared folder."""
    folder = os.path.dirname(shared_path(spark, "x").removeprefix("file:"))
    return Counter(x.rsplit("-", 1)[0] for x in os.listdir(folder)) if os.path.isdir(folder) else Counter()


def test_stages_keep_only_the_tables_their_results_read(spark, monkeypatch):
    """All tables of all stages together would not fit on the disk."""
    monkeypatch.setattr(components_module, "LOCAL_EDGES", 4)      # several rounds
    held, write = {}, ngramjoin.write_table

    def recorded(df, name):
        held[name] = tables(spark) - before
        return write(df, name)

    monkeypatch.setattr(ngramjoin, "write_table", recorded)
    docs = docs_of(spark, awkward())
    before = tables(spark)
    cut = linededup.drop_lines(docs)
    assert tables(spark) - before == Counter(["removed"])
    assert cut.count() > 0

    before = tables(spark)
    kept = ngramjoin.drop_copies(docs)
    assert tables(spark) - before == Counter(["member", "components", "links"])
    assert 0 < kept.count() < docs.count()
    # the keys of a class are on the disk once while they are dealt to their blocks
    assert "blocks" in held["shared-keys"] and "sketch" not in held["shared-keys"]
