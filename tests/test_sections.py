"""Section scan: edge cases and both physical forms against a plain loop."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marketprep.operators import sections
from marketprep.session import literal_rows

from .conftest import plan_text

HEADERS = ["NG Henry Hub", "Crude", "Crude Oil Last Day", "The "]


def py_sections(text, header, footer):
    """Our own line-loop definition: lines strictly between the first line
    containing ``header`` and the first later line containing ``footer``."""
    lines = re.split(r"\r\n|\r|\n", text)
    h = next((i for i, line in enumerate(lines) if header in line), None)
    if h is None:
        return []
    f = next((i for i in range(h + 1, len(lines)) if footer in lines[i]), None)
    if f is None:
        return []
    return [(i, lines[i]) for i in range(h + 1, f)]


def expected_rows(docs, headers, footer):
    out = []
    for doc_id, text in docs:
        for h in headers:
            for i, line in py_sections(text, h, footer):
                out.append((doc_id, h, i, line))
    return sorted(out)


def run_both(spark, docs, headers, footer="TOTAL"):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    a = sections.sections_in_text(df, headers, keys=["doc_id"], footer=footer, header_col="h")
    lines = sections.report_lines(df, keys=["doc_id"])
    # small blocks, so that sections begin, run and end in different ones
    b = sections.sections_in_lines(lines, list(headers), keys=["doc_id"], footer=footer, header_col="h",
                                   block_lines=3)
    rows_a = sorted(tuple(r) for r in a.select("doc_id", "h", "line_no", "line").collect())
    rows_b = sorted(tuple(r) for r in b.select("doc_id", "h", "line_no", "line").collect())
    return rows_a, rows_b


CASES = {
    "plain": "junk\nNG Henry Hub Natural Gas Futures\nJAN25 1 2\nFEB25 3 4\nTOTAL 9\nafter",
    "no_footer": "NG Henry Hub\nJAN25 1 2\nno end here",
    "no_header": "JAN25 1 2\nTOTAL",
    "header_twice": "NG Henry Hub A\nx1\nTOTAL\nNG Henry Hub B\nx2\nTOTAL",
    "nested_names": "Crude Oil Last Day Financial\nl1\nTOTAL\nCrude\nl2\nTOTAL",
    "crlf": "NG Henry Hub\r\nJAN25 1\r\nTOTAL\r\n",
    "cr_only": "NG Henry Hub\rJAN25 1\rTOTAL\r",
    "blank_first": "NG Henry Hub\n\n   \nJAN25 1 2\nTOTAL",
    "footer_on_header_line": "NG Henry Hub TOTAL\nJAN25 1\nTOTAL",
    "footer_in_word": "NG Henry Hub\nJAN25\nSUBTOTALS\nMAR25",
    "empty_section": "NG Henry Hub\nTOTAL",
    "empty": "",
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_edge_cases(spark, name):
    docs = [(1, CASES[name])]
    a, b = run_both(spark, docs, HEADERS)
    exp = expected_rows(docs, HEADERS, "TOTAL")
    assert a == exp
    assert b == exp


def test_specific_semantics(spark):
    a, _ = run_both(spark, [(1, CASES["header_twice"])], ["NG Henry Hub"])
    assert [r[3] for r in a] == ["x1"]                     # first header wins
    a, _ = run_both(spark, [(1, CASES["no_footer"])], ["NG Henry Hub"])
    assert a == []                                          # header without footer: no section
    a, _ = run_both(spark, [(1, CASES["footer_on_header_line"])], ["NG Henry Hub"])
    assert [r[3] for r in a] == ["JAN25 1"]                 # footer search starts after header
    a, _ = run_both(spark, [(1, CASES["crlf"])], ["NG Henry Hub"])
    assert [(r[2], r[3]) for r in a] == [(1, "JAN25 1")]


def _random_report(rng: random.Random) -> str:
    words = ["NG Henry Hub", "Crude", "TOTAL", "JAN25 1.0 2.0", "", "  ", "x", "Crude Oil Last Day",
             "The end", "SUBTOTAL", "y z"]
    seps = ["\n", "\r\n", "\r"]
    sep = rng.choice(seps)
    return sep.join(rng.choice(words) for _ in range(rng.randint(0, 30)))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(min_value=0, max_value=10_000))
def test_property_against_plain_loop(spark, seed):
    rng = random.Random(seed)
    docs = [(i, _random_report(rng)) for i in range(60)]
    a, b = run_both(spark, docs, HEADERS)
    exp = expected_rows(docs, HEADERS, "TOTAL")
    assert a == exp
    assert b == exp


def test_keep_status_reports_missing(spark):
    df = spark.createDataFrame([(1, CASES["no_footer"]), (2, CASES["plain"])], "doc_id long, text string")
    s = sections.sections_in_text(df, ["NG Henry Hub"], keys=["doc_id"], keep_status=True)
    rows = {r["doc_id"]: r for r in s.collect()}
    assert rows[1]["header_line"] == 0 and rows[1]["footer_line"] is None
    assert rows[1]["section_lines"] is None
    assert (rows[2]["header_line"], rows[2]["footer_line"]) == (1, 4)
    assert rows[2]["section_lines"] == ["JAN25 1 2", "FEB25 3 4"]


def test_header_table_needs_keys(spark):
    lines = spark.createDataFrame([(1, 0, "x")], "doc_id long, line_no long, line string")
    headers = spark.createDataFrame([(0, "x")], "position int, h string")
    with pytest.raises(ValueError):
        sections.sections_in_lines(lines, headers, keys=["doc_id"], header_col="h")


def test_literal_tables_have_one_path(spark):
    """Any number of rows is a constant JVM table, and the planner sizes it."""
    for n in (0, 1, 3_000):
        t = literal_rows(spark, [(i, float("nan"), "x") for i in range(n)], "a int, b double, c string")
        assert "ExistingRDD" not in plan_text(t) and t.count() == n
        assert t.where("b is not null").count() == 0
    big = spark.range(10).toDF("a")
    assert "BroadcastHashJoin" in plan_text(big.join(literal_rows(spark, [(1,)], "a long"), "a"))
