"""The fixed-value tables are self-consistent."""

from __future__ import annotations

from marketprep import rules


def test_product_rules_shape():
    assert len(rules.PRODUCT_RULES) == 7
    assert [r[0] for r in rules.PRODUCT_RULES] == list(range(7))
    by_source = rules.products_by_source()
    assert [len(v) for v in by_source.values()] == [4, 2, 1]
    assert {r[4] for r in rules.PRODUCT_RULES} == {"settlement", "last"}
    assert [r[6] for r in rules.PRODUCT_RULES if r[5] == "reciprocal"] == ["usd2cad"]
    sinks = [r[6] for r in rules.PRODUCT_RULES]
    assert len(set(sinks)) == 7
    assert rules.SETTLEMENT_SINK_TYPES == ", ".join(f"{c} DOUBLE" for c in sinks)


def test_padding_never_touches_kept_cells():
    assert len(rules.REPORT_COLUMNS) == rules.FULL_COLUMN_COUNT
    for n, inserts in rules.PADDING_RULES.items():
        assert n < rules.FULL_COLUMN_COUNT
        assert all(after >= rules.KEPT_COLUMN_COUNT for after, _ in inserts)
        assert n + sum(k for _, k in inserts) == rules.FULL_COLUMN_COUNT


def test_series_codes():
    assert len({rules.SERIES_UTILIZATION, rules.SERIES_CAPACITY, rules.SERIES_GROSS_INPUT}) == 3
    assert [a.replace(" ", "") for a in rules.UTILIZATION_AREAS] == list(rules.UTILIZATION_COLUMNS[1:])
