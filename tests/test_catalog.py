"""Every registered query against its DuckDB oracle, plus plan-shape checks."""

from __future__ import annotations

import pytest

from tests.oracle_check import compare, duck

from .conftest import SF_SMALL, plan_text

import __spark_entry__ as entry_mod  # noqa: E402

from marketprep.plans.catalog import QUERIES  # noqa: E402
from marketprep.plans.oracle import ORACLE_SQL as ORACLE  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, n, _, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert not problems, problems
    assert n > 0


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["day", "signup_value", "error_k", "click_inverse", "view_value",
                          "purchase_k_inverse"]


def _plan(df) -> str:
    return plan_text(df, "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_or_cartesian(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
                "MapInPandas", "ExistingRDD"):
        assert bad not in plan, (name, bad)


def test_filters_reach_the_scan(spark):
    plan = _plan(QUERIES["fallback_week"](spark, SF_SMALL))
    assert "EqualTo(o_orderstatus,P)" in plan and "EqualTo(o_orderpriority,1-URGENT)" in plan
    assert "PushedFilters" in plan


def test_columns_are_pruned_at_the_scan(spark):
    plan = _plan(QUERIES["ratio_join"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double," \
           "l_shipdate:timestamp_ntz>" in plan


def test_top_n_uses_group_limit(spark):
    plan = _plan(QUERIES["facet_topn"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_row_picks_aggregate_map_side(spark):
    plan = _plan(QUERIES["first_per_group"](spark, SF_SMALL))
    assert "partial_min_by" in plan and "Window " not in plan


SESSION_SENSITIVE = ["json_unwrap", "report_key", "first_per_group", "fallback_week",
                     "asof_lookback", "clean_numeric", "weekly_utilization"]


@pytest.mark.parametrize("name", SESSION_SENSITIVE)
def test_results_do_not_depend_on_session_settings(spark, con, name):
    """Timestamps are timezone-free and casts are explicit, so another
    session time zone or ANSI mode off must not change any result."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        problems, _, _, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert not problems, problems


@pytest.mark.parametrize("name,func,count", [
    ("rule_pivot", "get_json_object(", 1),       # JSON parsed once per row
    ("section_extract", "split(", 1),            # one pass over the lines finds all headers
    ("section_extract", "aggregate(", 1),        # a fold over the few lines that were found
    ("section_extract", "regexp_replace(", 0),
    ("section_extract", "Exchange", 0),
    ("json_unwrap", "Exchange", 0),
    ("clean_numeric", "Exchange", 0),
    ("clean_numeric", "regexp_extract(", 12),    # one extraction per output column
])
def test_expensive_expressions_evaluated_once(spark, name, func, count):
    plan = plan_text(QUERIES[name](spark, SF_SMALL), "simple").split("== Physical Plan ==")[-1]
    assert plan.count(func) == count, (name, func, plan.count(func))


def test_job_a_check_is_not_vacuous(spark):
    """Every price column has values, inverted and irregular rows among them."""
    from marketprep.plans.catalog import PART_RULES
    rows = QUERIES["report_settlement"](spark, SF_SMALL).collect()
    for _, _, col, _, transform in PART_RULES:
        values = [r[col] for r in rows if r[col] is not None]
        assert len(values) > 20 and len(set(values)) > 10, col
        assert any(r[col] is None for r in rows)
        assert {r[f"{col}_irregular"] for r in rows} >= {True, False}
        if transform == "reciprocal":
            assert any(0 < v < 1 for v in values)


def test_customers_are_joined_once(spark):
    for name in ("ratio_join", "wide_two_areas", "weekly_utilization"):
        plan = plan_text(QUERIES[name](spark, SF_SMALL), "formatted")
        assert plan.count("customer.parquet]") == 1 and plan.count("lineitem.parquet]") == 1, name


def test_part_reports_are_dealt_out(spark, tmp_path):
    """The few rows of one file are as many tasks as a shuffle has, and the text
    is what the SQL of both engines writes."""
    from marketprep.plans import catalog
    rows = [(i * 37, "n", f"Brand#{i % 50}", "t", i % 51, 1.0) for i in range(300)]
    rows += [(None, "n", "Brand#1", "t", 3, 1.0), (5, "n", None, "t", 4, 1.0), (6, "n", "Brand#2", "t", None, 1.0)] + rows[:9]
    df = spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
                                     "p_retailprice double")
    df.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    got = catalog._part_reports(spark, str(tmp_path))
    want = df.selectExpr("*", f"{catalog.part_cells_sql()} AS cells").selectExpr("p_partkey", f"{catalog.part_report_sql()} AS text")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    for name in ("report_settlement", "report_settlement_lines"):
        assert "REPARTITION_BY_NUM" in plan_text(QUERIES[name](spark, str(tmp_path)), "simple"), name


def test_report_lines_do_not_pass_the_driver(spark):
    """The planner sizes the lines by the small file they are made from, but
    they and what is found in them may not be broadcast."""
    plan = plan_text(QUERIES["report_settlement_lines"](spark, SF_SMALL), "simple")
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan
