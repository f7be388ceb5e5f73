"""Job A: settlement prices from landed text reports."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from marketprep.plans import settlement
from marketprep.sources.literal import SETTLEMENT_ROW_SCHEMA, literal_table
from marketprep.sources.reports import read_reports

from .conftest import write_text

NYMEX, FX, GAS = "STLBASIC_NYMEX_STLCPC_EOM_0", "STLBASIC_SETLCUR_EOM_SUM_0", "STLBASIC_NYMEX_EOM_SUM_0"
WTI = "26 Crude Oil Last Day Financial Futures"
PROPANE = "B0 Mont Belvieu LDH Propane (OPIS) Futures"
BRENT = "BZ Brent Crude Oil Last Day Financial Futures"
ETHANE = "C0 Mont Belvieu Ethane (OPIS) Futures"
CAD = "C1 Canadian Dollar/U.S. Dollar (CAD/USD) Futures"
EUR = "EC Euro/U.S. Dollar (EUR/USD) Futures"
NG = "NG Henry Hub Natural Gas Futures"

# the literal settlement rows (one trading day).
F1_ROWS = [
    (WTI, "JAN25", 68.72, None),
    (PROPANE, "NOV24", 0.80444, None),
    (BRENT, "JAN25", 72.94, 72.94),
    (ETHANE, "NOV24", 0.19911, None),
    (CAD, "DEC24", 0.7147, 0.7147),
    (EUR, "DEC24", 1.05735, 1.05835),
    (NG, "JAN25", 3.363, 3.368),
]
F1_EXPECTED = {"wti_crude_oil": 68.72, "propane": 0.80444, "brent_crude_oil": 72.94,
               "ethane": 0.19911, "usd2cad": 1 / 0.7147, "euro2usd": 1.05835, "nat_gas": 3.363}


def test_literal_golden_row(spark):
    from pyspark.sql import functions as F
    rows = literal_table(spark, F1_ROWS, SETTLEMENT_ROW_SCHEMA).withColumn("_order", F.lit(0))
    wide = settlement.settlement_wide(rows, keys=[], order_col="_order")
    got = wide.first().asDict()
    assert list(got) == list(F1_EXPECTED)
    assert got == F1_EXPECTED


def nymex_report(wti_sett: str, first_blank: bool = False) -> str:
    lines = [
        "DAILY SETTLEMENT REPORT",
        "",
        WTI,
        *([""] if first_blank else []),
        f"JAN25   68.50   69.00   68.00   68.80A  {wti_sett}  +.10   1234  68.62  100  2000",
        "FEB25   68.40   68.90   67.90   68.70   68.60   +.10   1200  68.50  90   1900",
        "TOTAL   2434    3900",
        PROPANE,
        "NOV24   ----    ----    ----    ----    .80444  +.001  0     .80344",  # 8 tokens
        "DEC24   ----    ----    ----    ----    .81000  +.001  0     .80900",
        "TOTAL   0",
        BRENT,
        "JAN25   72.10   73.00   72.00   72.94   72.94   +.20   500   72.74  50   600",
        "TOTAL   500",
        ETHANE,
        "NOV24   ----    ----    ----    ----    .19911  UNCH   0     .19911  0",  # 9 tokens
        "TOTAL   0",
    ]
    return "\n".join(lines) + "\n"


def fx_report(cad_last: str) -> str:
    return "\r\n".join([
        "CURRENCY SETTLEMENTS",
        CAD,
        f"DEC24   .7140   .7150   .7130   {cad_last}  .7147  +.0002  800  .7145  10  99",  # 11
        "TOTAL",
        EUR,
        "DEC24   1.0570  1.0590  1.0560  1.05835  1.05735  -.0010  900  1.05835  12",  # 10
        "TOTAL",
    ]) + "\r\n"


def gas_report() -> str:
    return "\n".join([NG, "JAN25  3.30  3.40  3.20  3.368  3.363  +.05  10  3.313  1  2", "TOTAL"])


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("reports"))

    def put(day, source, text, name="report.txt"):
        write_text(os.path.join(root, f"report_date={day}", f"source_id={source}", name), text)

    # 2024-11-20 (Wed): all three reports; 2024-11-21 (Thu): NYMEX only;
    # 2024-11-22 (Fri): NYMEX twice (the later file name wins).
    put("2024-11-20", NYMEX, nymex_report("68.72"))
    put("2024-11-20", FX, fx_report(".7147"))
    put("2024-11-20", GAS, gas_report())
    put("2024-11-21", NYMEX, nymex_report("69.01", first_blank=True))
    put("2024-11-22", NYMEX, nymex_report("70.00"), "a.txt")
    put("2024-11-22", NYMEX, nymex_report("70.50"), "b.txt")
    return root


def test_first_rows(spark, landed):
    reports = read_reports(spark, landed)
    rows = settlement.first_rows(spark, reports)
    got = {(r["report_date"].isoformat(), r["file_name"], r["Data_Set"]): r for r in rows.collect()}
    r = got[("2024-11-20", "report.txt", WTI)]
    assert (r["Month"], r["Settlement_Price"], r["Last_Price"]) == ("JAN25", 68.72, 68.80)
    r = got[("2024-11-20", "report.txt", PROPANE)]
    assert (r["Month"], r["Settlement_Price"], r["Last_Price"]) == ("NOV24", 0.80444, None)
    r = got[("2024-11-21", "report.txt", WTI)]
    assert r["Settlement_Price"] == 69.01            # blank line first in section skipped
    assert len(got) == 4 + 2 + 1 + 4 + 4 + 4


def test_history_wide_rows(spark, landed):
    wide = settlement.settlement_history(spark, read_reports(spark, landed))
    got = {r["report_date"].isoformat(): r.asDict() for r in wide.collect()}
    assert set(got) == {"2024-11-20", "2024-11-21", "2024-11-22"}
    d = got["2024-11-20"]
    assert d["wti_crude_oil"] == 68.72 and d["propane"] == 0.80444 and d["brent_crude_oil"] == 72.94
    assert d["ethane"] == 0.19911 and d["usd2cad"] == 1 / 0.7147 and d["euro2usd"] == 1.05835
    assert d["nat_gas"] == 3.363
    assert got["2024-11-21"]["usd2cad"] is None       # no FX report that day
    assert got["2024-11-22"]["wti_crude_oil"] == 70.50  # last file wins


def test_as_of_lookback(spark, landed):
    spine = spark.createDataFrame([(dt.date(2024, 11, d),) for d in (20, 23, 25, 30)], "as_of date")
    wide = settlement.settlement_as_of(spark, read_reports(spark, landed), spine)
    got = {r["as_of"].isoformat(): r.asDict() for r in wide.collect()}
    # Sat 23rd: nearest weekday reports: NYMEX from the 22nd, FX/gas from the 20th.
    assert got["2024-11-23"]["wti_crude_oil"] == 70.50
    assert got["2024-11-23"]["usd2cad"] == 1 / 0.7147
    # Mon 25th: window is Mon, Fri, Thu, Wed, Tue -> Fri 22nd for NYMEX, Wed 20th for FX.
    assert got["2024-11-25"]["wti_crude_oil"] == 70.50 and got["2024-11-25"]["nat_gas"] == 3.363
    # Sat 30th: window Fri 29th .. Mon 25th: nothing landed -> all NULL, row kept.
    assert all(v is None for k, v in got["2024-11-30"].items() if k != "as_of")
    assert got["2024-11-20"]["wti_crude_oil"] == 68.72


def test_section_status(spark, landed, tmp_path):
    root = str(tmp_path)
    write_text(os.path.join(root, "report_date=2024-11-20", f"source_id={GAS}", "r.txt"),
               NG + "\nJAN25 1 2 3 4 5\nno footer")
    st = settlement.section_status(spark, read_reports(spark, root)).collect()
    assert len(st) == 1 and st[0]["found"] is False and st[0]["header_line"] == 0


def test_parity_mode(spark, tmp_path):
    root = str(tmp_path)
    write_text(os.path.join(root, "report_date=2024-11-20", f"source_id={GAS}", "r.txt"),
               NG + "\nJAN25 1 2 3 -.5 -0.25 x\nTOTAL")
    reports = read_reports(spark, root)
    d = settlement.first_rows(spark, reports).first()
    p = settlement.first_rows(spark, reports, parity=True).first()
    assert (d["Last_Price"], d["Settlement_Price"]) == (-0.5, -0.25)
    assert (p["Last_Price"], p["Settlement_Price"]) == (5.0, 0.25)


def test_display_names(spark):
    from pyspark.sql import functions as F
    rows = literal_table(spark, F1_ROWS, SETTLEMENT_ROW_SCHEMA).withColumn("_order", F.lit(0))
    wide = settlement.settlement_wide(rows.withColumn("report_date", F.lit("2024-11-20")),
                                      keys=["report_date"], order_col="_order")
    cols = settlement.to_display(wide).columns
    assert cols == ["Date", "WTI Crude Oil", "Propane", "Brent Crude Oil", "Ethane", "US to CA$",
                    "Euro to $US", "Nat. Gas"]


def test_many_dates_generated(spark, tmp_path):
    """40 dates x 3 report kinds x 7 products, random missing reports, ragged
    first lines (5 to 12 tokens), blank lines and signed / dot-leading numbers.
    Expected rows come from the generator, not from a second parser."""
    import random

    from marketprep.rules import PRODUCT_RULES
    rng = random.Random(7)
    root = str(tmp_path)
    expected = {}
    start = dt.date(2024, 1, 1)
    for d in range(40):
        day = start + dt.timedelta(days=d)
        row = {}
        for source in (NYMEX, FX, GAS):
            if rng.random() < 0.2:
                continue  # report missing that day
            lines = ["HEADER", ""]
            for _, src, name, _, price, transform, col in PRODUCT_RULES:
                if src != source:
                    continue
                n_tok = rng.choice([5, 8, 9, 10, 11, 12])
                sett = rng.choice([round(rng.uniform(0.1, 99), 4), -round(rng.uniform(0.1, 9), 3)])
                last = round(rng.uniform(0.1, 99), 5)
                sett_txt = f"{sett:.4f}".replace("0.", ".", 1) if 0 < sett < 1 else f"{sett}"
                cells = ["MAR24", "1.0", "2.0", "0.5", f"{last}", sett_txt, "+.1", "10", "9.9", "1",
                         "2", "3"][:n_tok]
                lines += [name] + [""] * rng.randint(0, 2) + ["  ".join(cells), "APR24 1 2 3 4 5",
                                                             "TOTAL 1"]
                if n_tok < 5:
                    value = None
                elif price == "settlement":
                    value = float(sett) if n_tok >= 6 else None
                else:
                    value = last
                if transform == "reciprocal" and value is not None:
                    value = 1 / value if value != 0 else value
                row[col] = value
            write_text(os.path.join(root, f"report_date={day.isoformat()}", f"source_id={source}",
                                    "r.txt"), "\n".join(lines))
        if row:
            expected[day] = row
    wide = settlement.settlement_history(spark, read_reports(spark, root))
    got = {r["report_date"]: r.asDict() for r in wide.collect()}
    assert set(got) == set(expected)
    for day, cols in expected.items():
        for col in (r[6] for r in PRODUCT_RULES):
            assert got[day][col] == cols.get(col), (day, col)


def test_line_table_form_matches_whole_text(spark, landed):
    """Reports too big for one row are landed as lines; the keyed line-table
    scan (per-source product headers) must give the same sections."""
    from marketprep.operators import sections
    from marketprep.sources.literal import product_rules
    reports = read_reports(spark, landed)
    keys = ["report_date", "source_id", "file_name"]
    whole = sections.sections_in_text(reports, product_rules(spark), keys=keys,
                                      header_keys=["source_id"])
    lines = sections.report_lines(reports, keys=keys)
    table = sections.sections_in_lines(lines, product_rules(spark), keys=keys,
                                       header_keys=["source_id"])
    cols = keys + ["position", "data_set", "line_no", "line"]
    a = sorted(tuple(r) for r in whole.select(*cols).collect())
    b = sorted(tuple(r) for r in table.select(*cols).collect())
    assert a == b and len(a) > 20


def test_history_from_line_table_equals_whole_text(spark, landed):
    from marketprep.operators import sections
    reports = read_reports(spark, landed)
    lines = sections.report_lines(reports, keys=["report_date", "source_id", "file_name"])
    a = settlement.settlement_history_from_lines(spark, lines)
    b = settlement.settlement_history(spark, reports)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.select(*a.columns).collect())
    fa = settlement.first_rows_from_lines(spark, lines)
    fb = settlement.first_rows(spark, reports)
    assert sorted(tuple(r) for r in fa.collect()) == sorted(tuple(r) for r in fb.select(*fa.columns).collect())


def test_unknown_source_is_ignored(spark, tmp_path):
    root = str(tmp_path)
    write_text(os.path.join(root, "report_date=2024-11-20", "source_id=SOMETHING_ELSE", "r.txt"),
               NG + "\nJAN25 1 2 3 4 5\nTOTAL")
    write_text(os.path.join(root, "report_date=2024-11-20", f"source_id={GAS}", "r.txt"), gas_report())
    rows = settlement.first_rows(spark, read_reports(spark, root)).collect()
    assert [(r["source_id"], r["Data_Set"]) for r in rows] == [(GAS, NG)]


def test_empty_landing_is_a_clear_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no landed reports"):
        read_reports(spark, str(tmp_path))
