"""Pivots, concatenation and positional selection on small frames."""

from __future__ import annotations

import pytest

from marketprep.operators import reshape


def test_label_pivot_fixed_labels_and_duplicates(spark):
    df = spark.createDataFrame([("w1", "U.S.", 1.0), ("w1", "U.S.", 3.0), ("w1", "PADD3", 2.0),
                                ("w2", "PADD3", 5.0), ("w2", "OTHER", 9.0)],
                               "k string, label string, v double")
    out = reshape.label_pivot(df, ["k"], "label", "v", ["U.S.", "PADD3"])
    assert out.columns == ["k", "U.S.", "PADD3"]
    got = {r["k"]: (r["U.S."], r["PADD3"]) for r in out.collect()}
    assert got == {"w1": (3.0, 2.0), "w2": (None, 5.0)}   # duplicates: largest; missing: NULL


def test_concat_tagged_missing_columns(spark):
    a = spark.createDataFrame([(1, "x", "seg")], "key long, name string, mktsegment string")
    b = spark.createDataFrame([(2, "y")], "key long, name string")
    out = reshape.concat_tagged({"customer": a, "supplier": b})
    rows = sorted(tuple(r) for r in out.collect())
    assert out.columns == ["key", "name", "mktsegment", "tag"]
    assert rows == [(1, "x", "seg", "customer"), (2, "y", None, "supplier")]
    with pytest.raises(ValueError):
        reshape.concat_tagged({})


def test_positional_and_ordered_selection(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, c int, d int")
    assert reshape.select_first_n_columns(df, 2).columns == ["a.b", "c"]
    assert reshape.select_in_order(df, ["d", "a.b"]).columns == ["d", "a.b"]
    with pytest.raises(Exception):
        reshape.select_in_order(df, ["missing"]).columns


def test_rule_pivot_missing_rule_is_null_column(spark):
    from marketprep.rules import PivotRule
    df = spark.createDataFrame([(1, "a", 1.0, 0), (1, "a", 2.0, 1)], "k int, n string, v double, o int")
    rules = [PivotRule(0, "a", "col_a", "value", "none"), PivotRule(1, "zz", "col_zz", "value", "none")]
    r = reshape.rule_pivot(df, ["k"], rules, "n", "v", "o").first()
    assert (r["col_a"], r["col_zz"]) == (2.0, None)              # last (highest order) wins
