"""Column functions: tokens, padding, number cleaning, math, calendar."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketprep.functions import calendar as cal
from marketprep.functions import numeric as num
from marketprep.functions import text as txt


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("line,expected", [
    ("", []),
    ("   ", []),
    ("  JAN25  68.72 68.90\t 68.10 ", ["JAN25", "68.72", "68.90", "68.10"]),
    ("a", ["a"]),
])
def test_tokens(spark, line, expected):
    assert one(spark, txt.tokens("s"), line) == expected


def test_tokens_unicode_whitespace(spark):
    line = "\u00a0JAN25\u2003 68.72\u00a0"
    assert one(spark, txt.tokens("s", unicode_ws=True), line) == ["JAN25", "68.72"]
    assert one(spark, txt.tokens("s"), line) == ["\u00a0JAN25\u2003", "68.72\u00a0"]


def _py_pad(tokens, rules):
    out = []
    for i, t in enumerate(tokens):
        out.append(t)
        for after, k in rules.get(len(tokens), ()):
            if after == i:
                out.extend([""] * k)
    return out


@pytest.mark.parametrize("n", [0, 5, 7, 8, 9, 10, 11, 12])
def test_pad_ragged_matches_rule_semantics(spark, n):
    from marketprep.rules import PADDING_RULES
    toks = [f"t{i}" for i in range(n)]
    got = one(spark, txt.pad_ragged(F.col("a")), toks, "a array<string>")
    assert got == _py_pad(toks, PADDING_RULES)


def test_pad_ragged_examples(spark):
    t = [f"t{i}" for i in range(8)]
    assert one(spark, txt.pad_ragged(F.col("a")), t, "a array<string>") == \
        ["t0", "t1", "t2", "t3", "t4", "t5", "t6", "", "t7", "", ""]
    t = [f"t{i}" for i in range(10)]
    assert one(spark, txt.pad_ragged(F.col("a")), t, "a array<string>") == \
        ["t0", "t1", "t2", "t3", "t4", "t5", "t6", "t7", "", "t8", "t9"]


def test_is_irregular(spark):
    for n, irregular in [(0, True), (7, True), (8, False), (9, False), (10, False), (11, False),
                         (12, True)]:
        assert one(spark, txt.is_irregular(F.col("a")), ["x"] * n, "a array<string>") is irregular


@pytest.mark.parametrize("s,default,parity", [
    ("0.771A", 0.771, 0.771),
    (".771", 0.771, 0.771),
    ("68.72", 68.72, 68.72),
    ("UNCH", None, None),
    ("----", None, None),
    ("", None, None),
    (None, None, None),
    ("-0.5", -0.5, 0.5),
    ("-.5", -0.5, 5.0),
    ("+3", 3.0, 3.0),
    ("12.", 12.0, 12.0),
    ("Brand#13", 13.0, 13.0),
])
def test_first_number(spark, s, default, parity):
    assert one(spark, txt.first_number("s"), s) == default
    assert one(spark, txt.first_number("s", parity=True), s) == parity


def test_strip_spaces_and_key(spark):
    assert one(spark, txt.strip_spaces("s"), "PADD 3") == "PADD3"
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(txt.compose_key("-", "x", "y", "z")).first()[0] == "a-c"


def test_reciprocal(spark):
    for v, expected in [(0.7147, 1 / 0.7147), (0.0, 0.0), (None, None), (-2.0, -0.5)]:
        assert one(spark, num.reciprocal_or_self("x"), v, "x double") == expected


def test_percent_ratio_zero_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (88.1, 100.0)], "a double, b double")
    got = [r[0] for r in df.select(num.percent_ratio("a", "b")).collect()]
    assert got[0] is None and abs(got[1] - 88.1) < 1e-9


def test_round_half_even(spark):
    import numpy as np
    vals = [0.125, 0.135, 2.675, 1.005, 88.125, -0.125, 12.345]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(num.round_half_even("x")).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]


def test_last_friday_every_weekday(spark):
    start = dt.date(2024, 11, 18)  # Monday
    days = [start + dt.timedelta(days=i) for i in range(14)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.orderBy("d").select(cal.last_friday("d")).collect()]
    for d, f in zip(days, got):
        assert f.weekday() == 4 and 0 <= (d - f).days <= 6


# Lookback trial orders per as-of weekday (Mon..Sun), from the rule description.
REFERENCE_ORDER = {0: [0, 5, 4, 3, 4, 5, 6], 1: [0, 1, 6, 5, 4, 5, 6], 2: [0, 1, 2, 7, 6, 5, 6],
                   3: [0, 1, 2, 3, 8, 7, 6], 4: [0, 1, 2, 3, 4, 9, 8], 5: [2, 1, 2, 3, 4, 5, 10],
                   6: [4, 3, 2, 3, 4, 5, 6]}
CORRECTED_ORDER = {0: [0, 3, 4, 5, 6], 1: [0, 1, 4, 5, 6], 2: [0, 1, 2, 5, 6], 3: [0, 1, 2, 3, 6],
                   4: [0, 1, 2, 3, 4], 5: [1, 2, 3, 4, 5], 6: [2, 3, 4, 5, 6]}


@pytest.mark.parametrize("mode,table", [("reference", REFERENCE_ORDER), ("corrected", CORRECTED_ORDER)])
def test_lookback_offsets(spark, mode, table):
    start = dt.date(2024, 11, 18)  # Monday
    rows = [(start + dt.timedelta(days=i),) for i in range(7)]
    df = spark.createDataFrame(rows, "d date").select("d", cal.lookback_offsets("d", mode).alias("o"))
    for d, offs in df.collect():
        assert offs == table[d.weekday()], (d, offs)


def test_date_formats(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 11, 21, 9, 5, 7),)], "t timestamp")
    r = df.select(cal.format_compact("t"), cal.format_iso("t"), cal.format_stamp("t")).first()
    assert tuple(r) == ("20241121", "2024-11-21", "2024-11-21_09-05-07")
