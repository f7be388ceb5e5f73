"""Incremental landing ingestion: stream == batch, and only new files are read."""

from __future__ import annotations

import json
import os

from marketprep.plans import settlement
from marketprep.plans.utilization import series_utilization
from marketprep.sources.envelope import typed_series
from marketprep.sources.reports import read_reports
from marketprep.streaming import landing

from .conftest import write_text
from .test_settlement import FX, GAS, NYMEX, fx_report, gas_report, nymex_report


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_report_stream_matches_batch(spark, tmp_path):
    land, out, ck = (str(tmp_path / n) for n in ("land", "rows", "ck"))

    def put(day, source, text, name="r.txt"):
        write_text(os.path.join(land, f"report_date={day}", f"source_id={source}", name), text)

    put("2024-11-20", NYMEX, nymex_report("68.72"))
    put("2024-11-20", FX, fx_report(".7147"))
    q = landing.ingest_reports(spark, land, out, ck, max_files_per_trigger=1)
    q.awaitTermination(120)
    first = spark.read.parquet(out).count()
    assert first == 4 + 2

    # A later run picks up only the new files; the gas report for the same
    # date completes the wide row.
    put("2024-11-20", GAS, gas_report())
    put("2024-11-21", NYMEX, nymex_report("69.01"))
    q = landing.ingest_reports(spark, land, out, ck)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == first + 1 + 4

    streamed = landing.settlement_from_rows(spark, out)
    batch = settlement.settlement_history(spark, read_reports(spark, land))
    cols = batch.columns
    assert _rows(streamed.select(*cols)) == _rows(batch)


def test_series_stream(spark, tmp_path):
    land, out, ck = (str(tmp_path / n) for n in ("land", "recs", "ck"))
    for code, value in (("YRL", "18400"), ("EPXXX2", "16210.5")):
        d = os.path.join(land, f"series_code={code}")
        os.makedirs(d)
        with open(os.path.join(d, "p.json"), "w") as f:
            json.dump({"response": {"data": [{"period": "2024-12-06", "duoarea": "NUS",
                                              "area-name": "U.S.", "series-description": "x",
                                              "value": value, "units": "MBBL/D",
                                              "product-name": "crude"}]}}, f, indent=1)
    q = landing.ingest_series(spark, land, out, ck)
    q.awaitTermination(120)
    util = series_utilization(typed_series(spark.read.parquet(out)))
    assert [r["percent_utilization"] for r in util.collect()] == [88.1]


def _run_cli(*args):
    """A run of its own process, as a scheduler starts it; no shared folder set."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root, "PYSPARK_SUBMIT_ARGS": "--conf spark.checkpoint.dir= pyspark-shell"}
    env["PYSPARK_SUBMIT_ARGS"] = "pyspark-shell"
    got = subprocess.run([sys.executable, "-m", "marketprep", *args, "--master", "local[1]"], env=env,
                         capture_output=True, text=True, timeout=240)
    assert got.returncode == 0, got.stderr[-2000:]


def test_restart_resumes_and_outputs_are_apart(spark, tmp_path):
    """A second process picks up what landed since; another output over the
    same landing gets everything."""
    land, one, two = (str(tmp_path / n) for n in ("land", "one", "two"))

    def put(day):
        write_text(os.path.join(land, f"report_date={day}", f"source_id={NYMEX}", "r.txt"), nymex_report("68.72"))

    put("2024-11-20")
    _run_cli("ingest-reports", "--landing", land, "--output", one)
    put("2024-11-21")
    _run_cli("ingest-reports", "--landing", land, "--output", one)
    _run_cli("ingest-reports", "--landing", land, "--output", two)
    for out in (one, two):
        days = [r["report_date"].isoformat() for r in spark.read.parquet(out).collect()]
        assert sorted(days) == ["2024-11-20"] * 4 + ["2024-11-21"] * 4


def test_wide_utilization_from_ingested_records(spark, tmp_path):
    import datetime as dt
    from marketprep import jobs
    from .test_utilization import land as put, rec
    land, out = str(tmp_path / "land"), str(tmp_path / "recs")
    put(land, "YRL/pull_date=2024-12-07", [rec("2024-12-06", "NUS", "U.S.", "1000")])
    put(land, "EPXXX2/pull_date=2024-12-07", [rec("2024-12-06", "NUS", "U.S.", "950")])
    landing.ingest_series(spark, land, out).awaitTermination(120)
    put(land, "EPXXX2/pull_date=2024-12-14", [rec("2024-12-06", "NUS", "U.S.", "900")])
    landing.ingest_series(spark, land, out).awaitTermination(120)
    spine = spark.createDataFrame([(dt.date(2024, 12, 9),)], "as_of date")
    streamed = landing.utilization_from_records(spark, out, spine).select("Date", "`U.S.`").collect()
    batch = jobs.utilization_job(spark, land, spine).select("Date", "`U.S.`").collect()
    assert streamed == batch and streamed[0]["U.S."] == 90.0
