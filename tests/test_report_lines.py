"""Reports read in splits: line numbers over the whole file, and job A on them."""

from __future__ import annotations

import os
import random
import re

from marketprep.operators import sections
from marketprep.plans import settlement
from marketprep.sources import reports
from marketprep.sources.reports import read_lines, read_report_lines, read_reports

from .test_settlement import FX, GAS, NYMEX, fx_report, gas_report, nymex_report


def lines_of(text: str) -> list[str]:
    parts = re.split(r"\r\n|\r|\n", text)
    return parts[:-1] if parts[-1] == "" else parts


def put(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)


def numbered(df):
    rows = df.collect()
    return {(r.kind, r.file_name): [x.line for x in sorted((q for q in rows if q.file_name == r.file_name and q.kind == r.kind),
                                                        key=lambda q: q.line_no)] for r in rows}, rows


def test_numbers_over_splits(spark, tmp_path):
    """Every line break at and around the ends of splits."""
    rng = random.Random(2)
    texts = {}
    for k, brk in enumerate(["\n", "\r\n", "\r", None]):
        body = []
        for i in range(90):
            body.append(rng.choice(["", "é中" * rng.randint(0, 9), f"line {i}", "x" * rng.randint(0, 40)]))
            body.append(brk or rng.choice(["\n", "\r\n", "\r"]))
        texts[("a", f"f{k}.txt")] = "".join(body)
    texts |= {("b", "one.txt"): "single", ("b", "empty.txt"): "", ("b", "long.txt"): "y" * 1500 + "\nz", ("b", "brk.txt"): "\n" * 200}
    for (kind, name), t in texts.items():
        put(str(tmp_path / f"kind={kind}" / name), t)
    for size in (100, None):
        got, rows = numbered(read_lines(spark, str(tmp_path), split_bytes=size))
        assert got == {k: lines_of(t) for k, t in texts.items() if t}
        assert all(sorted(r.line_no for r in rows if r.file_name == n and r.kind == kd) == list(range(len(ls))) for (kd, n), ls in got.items())


def test_a_large_file_in_several_splits(spark, tmp_path):
    """A file of 50 MB gives the sections of the whole-text form."""
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta"]
    body = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(700_000)]
    for at, line in ((10, "TOTAL"), (300_000, "NG Henry Hub Futures"), (300_400, "x TOTAL y"), (699_000, "Crude Oil"), (699_998, "TOTAL")):
        body[at] = line
    put(str(tmp_path / "k=1" / "big.txt"), "\n".join(body))
    assert os.path.getsize(tmp_path / "k=1" / "big.txt") > 45 << 20
    lines = read_lines(spark, str(tmp_path), split_bytes=4 << 20)
    assert lines.selectExpr("count(*)", "max(line_no)", "count(distinct line_no)").first() == (700_000, 699_999, 700_000)
    heads = ["NG Henry Hub", "Crude", "none"]
    a = sections.sections_in_lines(lines.select("k", "line_no", "line"), heads, keys=["k"], header_col="h")
    whole = spark.read.text(str(tmp_path), wholetext=True).selectExpr("k", "value as text")
    b = sections.sections_in_text(whole, heads, keys=["k"], header_col="h")
    key = ["h", "line_no", "line"]
    got = sorted(tuple(r) for r in a.select(key).collect())
    assert len(got) == 399 + 997 and got == sorted(tuple(r) for r in b.select(key).collect())


def test_job_a_on_lines(spark, tmp_path):
    """Landed reports read in splits price like whole reports."""
    for day, price in (("2024-11-20", "68.72"), ("2024-11-21", "69.10")):
        for source, text in ((NYMEX, nymex_report(price)), (FX, fx_report(".7147")), (GAS, gas_report())):
            put(str(tmp_path / f"report_date={day}" / f"source_id={source}" / "r.txt"), text)
    lines = read_report_lines(spark, str(tmp_path), split_bytes=200)
    whole = settlement.settlement_history(spark, read_reports(spark, str(tmp_path)))
    split = settlement.settlement_history_from_lines(spark, lines)
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect())) and split.count() == 2
    some = read_report_lines(spark, str(tmp_path), dates=["2024-11-21"])
    assert {str(r.report_date) for r in some.collect()} == {"2024-11-21"}
    assert read_report_lines(spark, str(tmp_path), dates=["2020-01-01"]).collect() == []
    assert reports.read_report_lines(spark, str(tmp_path), dates=["2020-01-01"]).columns == lines.columns
