"""Runnable jobs and their CLI (no database sink here)."""

from __future__ import annotations

import datetime as dt
import os

from marketprep import jobs

from .conftest import plan_text, write_text
from .test_settlement import (F1_EXPECTED, F1_ROWS, FX, GAS, NYMEX, fx_report, gas_report,
                              nymex_report)
from .test_utilization import land, rec


def _landing(root):
    def put(day, source, text):
        write_text(os.path.join(root, f"report_date={day}", f"source_id={source}", "r.txt"), text)
    put("2024-11-20", NYMEX, nymex_report("68.72"))
    put("2024-11-20", FX, fx_report(".7147"))
    put("2024-11-20", GAS, gas_report())
    put("2024-11-22", NYMEX, nymex_report("70.50"))


def test_settlement_job(spark, tmp_path):
    root = str(tmp_path)
    _landing(root)
    spine = jobs.as_of_spine(spark, ["2024-11-23", "2024-11-21"])
    out = {r["Date"]: r for r in jobs.settlement_job(spark, root, spine).collect()}
    assert out[dt.date(2024, 11, 23)]["wti_crude_oil"] == 70.50
    assert out[dt.date(2024, 11, 21)]["wti_crude_oil"] == 68.72
    assert out[dt.date(2024, 11, 21)]["usd2cad"] == 1 / 0.7147


def test_spine_range(spark):
    s = jobs.as_of_spine(spark, start="2024-11-01", end="2024-11-30")
    assert s.count() == 30


def test_utilization_job(spark, tmp_path):
    root = str(tmp_path)
    land(root, "YRL", [rec("2024-12-06", "NUS", "U.S.", "18400"),
                       rec("2024-12-06", "R30", "PADD 3", "10100")])
    land(root, "EPXXX2", [rec("2024-12-06", "NUS", "U.S.", "16210.5"),
                          rec("2024-12-06", "R30", "PADD 3", "9444.35")])
    spine = jobs.as_of_spine(spark, start="2024-12-06", end="2024-12-12")
    out = jobs.utilization_job(spark, root, spine)
    assert out.columns == ["Date", "U.S.", "PADD3"]
    rows = out.collect()
    assert len(rows) == 1 and tuple(rows[0]) == (dt.date(2024, 12, 6), 88.1, 93.51)


def test_literal_job(spark):
    assert jobs.literal_settlement_job(spark, F1_ROWS).first().asDict() == F1_EXPECTED


def test_cli_prints(spark, tmp_path, capsys):
    root = str(tmp_path)
    _landing(root)
    assert jobs.main(["settlement", "--landing", root, "--as-of", "2024-11-21",
                      "--display-names"]) == 0
    printed = capsys.readouterr().out
    assert "WTI Crude Oil" in printed and "68.72" in printed


def test_report_window_prunes_partitions(spark, tmp_path):
    from marketprep.plans import settlement
    from marketprep.sources.reports import read_reports
    root = str(tmp_path)
    _landing(root)
    pruned = settlement.report_window(read_reports(spark, root), "2024-11-22", "2024-11-22")
    plan = plan_text(pruned, "formatted")
    assert "PartitionFilters" in plan and "report_date" in plan.split("PartitionFilters")[1][:300]
    assert sorted(r["report_date"].isoformat() for r in pruned.select("report_date").collect()) \
        == ["2024-11-20", "2024-11-20", "2024-11-20", "2024-11-22"]
    narrow = settlement.report_window(read_reports(spark, root), "2024-11-28", "2024-11-28")
    assert [r["report_date"].isoformat() for r in narrow.select("report_date").collect()] \
        == ["2024-11-22"]
    spine = jobs.as_of_spine(spark, ["2024-11-23"])
    full = jobs.settlement_job(spark, root, spine).collect()
    windowed = jobs.settlement_job(spark, root, spine, as_of_range=("2024-11-23", "2024-11-23")).collect()
    assert full == windowed


def test_report_window_reference_mode_reaches_further(spark, tmp_path):
    from marketprep.plans import settlement
    from marketprep.sources.reports import read_reports
    root = str(tmp_path)
    _landing(root)
    # Saturday 30th: the source order tries 10 days back (the 20th) last.
    corr = settlement.report_window(read_reports(spark, root), "2024-11-30", "2024-11-30")
    ref = settlement.report_window(read_reports(spark, root), "2024-11-30", "2024-11-30",
                                   mode="reference")
    assert corr.where("report_date = '2024-11-20'").count() == 0
    assert ref.where("report_date = '2024-11-20'").count() == 3
    spine = jobs.as_of_spine(spark, ["2024-11-30"])
    full = jobs.settlement_job(spark, root, spine, mode="reference").collect()
    windowed = jobs.settlement_job(spark, root, spine, mode="reference",
                                   as_of_range=("2024-11-30", "2024-11-30")).collect()
    assert full == windowed and full[0]["usd2cad"] == 1 / 0.7147


def test_cli_utilization(spark, tmp_path, capsys):
    root = str(tmp_path)
    land(root, "YRL", [rec("2024-12-06", "NUS", "U.S.", "18400")])
    land(root, "EPXXX2", [rec("2024-12-06", "NUS", "U.S.", "16210.5")])
    assert jobs.main(["utilization", "--landing", root, "--start", "2024-12-06",
                      "--end", "2024-12-08"]) == 0
    printed = capsys.readouterr().out
    assert "2024-12-06" in printed and "88.1" in printed


def test_utilization_job_newest_rows(spark, tmp_path):
    root = str(tmp_path)
    weeks = ["2024-11-22", "2024-11-29", "2024-12-06"]
    land(root, "YRL", [rec(w, c, a, "10000") for w in weeks for c, a in (("NUS", "U.S."),
                                                                       ("R30", "PADD 3"))])
    land(root, "EPXXX2", [rec(w, c, a, "9000") for w in weeks for c, a in (("NUS", "U.S."),
                                                                         ("R30", "PADD 3"))])
    spine = jobs.as_of_spine(spark, ["2024-11-23", "2024-12-07"])
    full = {r["Date"] for r in jobs.utilization_job(spark, root, spine).collect()}
    assert full == {dt.date(2024, 11, 22), dt.date(2024, 12, 6)}
    # Newest 2 records per series = the Dec 6 week only; Nov 23 falls back to nothing.
    newest = jobs.utilization_job(spark, root, spine, newest_rows=2).collect()
    assert [(r["Date"], r["U.S."], r["PADD3"]) for r in newest] == [(dt.date(2024, 12, 6), 90.0, 90.0)]


def test_cli_rejects_half_range(tmp_path):
    import pytest
    with pytest.raises(SystemExit):
        jobs.main(["settlement", "--landing", str(tmp_path), "--start", "2024-11-01"])


def test_cli_ingest_reports(spark, tmp_path):
    land_dir, out, ck = str(tmp_path / "land"), str(tmp_path / "rows"), str(tmp_path / "ck")
    _landing(land_dir)
    assert jobs.main(["ingest-reports", "--landing", land_dir, "--output", out,
                      "--checkpoint", ck]) == 0
    assert spark.read.parquet(out).count() == 4 + 2 + 1 + 4


def test_cli_defaults_to_today(spark, tmp_path, capsys):
    root = str(tmp_path)
    _landing(root)
    assert jobs.main(["settlement", "--landing", root]) == 0
    today = spark.range(1).selectExpr("cast(current_date() as string)").first()[0]
    assert today in capsys.readouterr().out


def test_window_never_changes_results(spark, tmp_path):
    """Across every weekday and both trial orders, pruning the landing folder
    to the lookback window gives the same rows as reading all of it."""
    import random

    from tests.test_settlement import FX, GAS, NYMEX, fx_report, gas_report, nymex_report
    rng = random.Random(3)
    root = str(tmp_path)
    start = dt.date(2024, 10, 1)
    for d in range(40):
        day = (start + dt.timedelta(days=d)).isoformat()
        for src, make in ((NYMEX, lambda: nymex_report(f"{rng.uniform(60, 80):.2f}")),
                          (FX, lambda: fx_report(f".{rng.randint(7000, 7400)}")),
                          (GAS, gas_report)):
            if rng.random() < 0.6:
                write_text(os.path.join(root, f"report_date={day}", f"source_id={src}", "r.txt"), make())
    first, last = "2024-10-08", "2024-11-08"
    spine = jobs.as_of_spine(spark, start=first, end=last)
    for mode in ("corrected", "reference"):
        full = sorted(tuple(r) for r in jobs.settlement_job(spark, root, spine, mode=mode).collect())
        win = sorted(tuple(r) for r in jobs.settlement_job(
            spark, root, spine, mode=mode, as_of_range=(first, last)).collect())
        assert full == win and len(full) == 32


def test_one_day_run_reads_its_window_once(spark, tmp_path):
    """Folders outside the window are not even listed, and finding the report
    dates opens no file."""
    from marketprep.plans import settlement
    from marketprep.sources.reports import read_inventory, read_reports
    root = str(tmp_path)
    _landing(root)
    write_text(os.path.join(root, "report_date=2024-01-02", "source_id=X", "bad", "deeper", "r.txt"), "x")
    dates = settlement.window_dates("2024-11-23", "2024-11-23")
    assert dates[0] == "2024-11-17" and dates[-1] == "2024-11-23"
    assert len(read_reports(spark, root, dates).inputFiles()) == 4
    inv = read_inventory(spark, root, dates)
    assert sorted((r["source_id"], r["report_date"].isoformat()) for r in inv.collect()) == sorted(
        [(NYMEX, "2024-11-20"), (FX, "2024-11-20"), (GAS, "2024-11-20"), (NYMEX, "2024-11-22")])
    assert "content" not in plan_text(inv, "formatted").split("ReadSchema")[-1]
    out = jobs.settlement_job(spark, root, jobs.as_of_spine(spark, ["2024-11-23"]),
                              as_of_range=("2024-11-23", "2024-11-23"))
    assert plan_text(out, "simple").count("Scan text") == 1 and out.first()["wti_crude_oil"] == 70.50
    # nothing landed in reach
    empty = jobs.settlement_job(spark, root, jobs.as_of_spine(spark, ["2023-01-05"]), as_of_range=("2023-01-05", "2023-01-05"))
    assert [r["wti_crude_oil"] for r in empty.collect()] == [None]


def test_irregular_first_rows_are_marked(spark, tmp_path):
    from marketprep.plans import settlement
    from marketprep.sources.reports import read_reports
    root = str(tmp_path)
    text = "NG Henry Hub Natural Gas Futures\nJAN25 1 2 3 4 5 6\nTOTAL"
    write_text(os.path.join(root, "report_date=2024-11-20", f"source_id={GAS}", "r.txt"), text)
    write_text(os.path.join(root, "report_date=2024-11-21", f"source_id={GAS}", "r.txt"), gas_report())
    rows = settlement.first_rows(spark, read_reports(spark, root)).collect()
    assert {r["report_date"].isoformat(): r["is_irregular"] for r in rows} == {"2024-11-20": True, "2024-11-21": False}


def test_cli_literal(spark, tmp_path, capsys):
    path = str(tmp_path / "rows.csv")
    write_text(path, "Data_Set,Month,Settlement_Price,Last_Price\n" + "".join(
        f'"{d}",{m},{"" if s is None else s},{"NaN" if x is None else x}\n' for d, m, s, x in F1_ROWS))
    assert jobs.main(["literal", "--landing", path]) == 0
    printed = capsys.readouterr().out
    assert "68.72" in printed and "1.3991884706870015" in printed and "NaN" not in printed


def test_cli_options_and_quarantine(spark, tmp_path, capsys, monkeypatch):
    root, bad = str(tmp_path / "land"), str(tmp_path / "bad")
    land(root, "YRL", [rec("2024-12-06", "NUS", "U.S.", "18400"), rec("2024-12-06", "R30", "PADD 3", "n/a")])
    land(root, "EPXXX2", [rec("2024-12-06", "NUS", "U.S.", "16210.5")])
    assert jobs.main(["utilization", "--landing", root, "--as-of", "2024-12-07", "--quarantine", bad]) == 0
    assert "88.1" in capsys.readouterr().out
    assert [r["value"] for r in spark.read.parquet(bad).collect()] == ["n/a"]
    seen = {}
    monkeypatch.setattr(jobs, "write_jdbc", lambda df, url, table, **kw: seen.update(kw))
    assert jobs.main(["utilization", "--landing", root, "--as-of", "2024-12-07", "--quarantine", bad, "--jdbc-url",
                      "jdbc:x", "--table", "t", "--jdbc-option", "accessToken=a=b", "--jdbc-option", "encrypt=true"]) == 0
    assert seen["options"] == {"accessToken": "a=b", "encrypt": "true"}
