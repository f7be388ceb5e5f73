"""Job B: refinery utilization from JSON record sets."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketprep.plans.utilization import latest_week_wide, series_utilization, utilization
from marketprep.sources.envelope import read_envelopes, typed_series, unwrap_envelope


def rec(period, duoarea, area, value, desc="d", units="MBBL/D", product="crude"):
    return {"period": period, "duoarea": duoarea, "area-name": area,
            "series-description": desc, "value": value, "units": units,
            "product-name": product, "extra-field": "ignored"}


def land(root, code, records, name="part-0.json"):
    d = os.path.join(root, f"series_code={code}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        json.dump({"response": {"data": records}}, f, indent=2)


@pytest.fixture(scope="module")
def series_root(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("series"))
    cap = [rec("2024-12-06", "NUS", "U.S.", "18400"), rec("2024-12-06", "R30", "PADD 3", "10100"),
           rec("2024-11-29", "NUS", "U.S.", "18400"), rec("2024-11-29", "R30", "PADD 3", "10000"),
           rec("2024-11-22", "NUS", "U.S.", "0"), rec("2024-11-22", "R30", "PADD 3", "10000"),
           rec("2024-11-15", "R30", "PADD 3", "10000"),
           rec("2024-11-08", None, None, "100")]
    inp = [rec("2024-12-06", "NUS", "U.S.", "16210.5"), rec("2024-12-06", "R30", "PADD 3", "9444.35"),
           rec("2024-11-29", "NUS", "U.S.", "16500"), rec("2024-11-29", "R30", "PADD 3", "9400"),
           rec("2024-11-22", "NUS", "U.S.", "16000"), rec("2024-11-22", "R30", "PADD 3", "9300"),
           rec("2024-11-15", "NUS", "U.S.", "16000"),
           rec("2024-11-08", None, None, "88.125")]
    land(root, "YRL", cap)
    land(root, "EPXXX2", inp)
    land(root, "YUP", [rec("2024-12-06", "NUS", "U.S.", "88.1")])
    return root


def test_read_envelopes(spark, series_root):
    recs = read_envelopes(spark, series_root)
    assert set(recs.columns) >= {"series_code", "period", "duoarea", "area_name",
                                 "series_description", "value", "units", "product_name"}
    assert recs.count() == 17


def test_unwrap_text_column(spark):
    body = json.dumps({"response": {"data": [rec("2024-12-06", "NUS", "U.S.", "1"),
                                             rec("2024-12-06", "R30", "PADD 3", "2")]}})
    df = spark.createDataFrame([(1, body), (2, "[]"), (3, None)], "id int, body string")
    out = unwrap_envelope(df, "body", keep=("id",))
    assert sorted((r["id"], r["area_name"]) for r in out.collect()) == [(1, "PADD 3"), (1, "U.S.")]


def test_utilization_join(spark, series_root):
    util = series_utilization(typed_series(read_envelopes(spark, series_root)))
    got = {(r["period"].isoformat(), r["area_name"]): r for r in util.collect()}
    r = got[("2024-12-06", "U.S.")]
    assert r["percent_utilization"] == 88.1 and r["output_value"] == 18400.0
    assert got[("2024-12-06", "PADD 3")]["percent_utilization"] == 93.51
    assert got[("2024-11-22", "U.S.")]["percent_utilization"] is None    # capacity 0
    assert ("2024-11-15", "PADD 3") not in got and ("2024-11-15", "U.S.") not in got
    # NULL keys on both sides match each other (null-safe join).
    assert got[("2024-11-08", None)]["percent_utilization"] == 88.12     # half-even 88.125
    assert set(util.columns) >= {"output_description", "output_units", "input_description",
                                 "input_value", "input_units"}
    assert "product_name" not in util.columns


def test_latest_pull_wins(spark, tmp_path):
    """Two weekly pulls of one week, the input revised from 950 to 900: one row
    per key, the later value, whatever its size."""
    from marketprep import jobs
    from marketprep.sources.envelope import latest_records
    root = str(tmp_path)
    for code, first, second in (("YRL", "1000", "1000"), ("EPXXX2", "950", "900")):
        land(root, f"{code}/pull_date=2024-12-07", [rec("2024-12-06", "NUS", "U.S.", first),
                                                    rec("2024-12-06", None, None, first)])
        land(root, f"{code}/pull_date=2024-12-14", [rec("2024-12-06", "NUS", "U.S.", "1"),
                                                    rec("2024-12-06", "NUS", "U.S.", second),
                                                    rec("2024-12-06", None, None, second)])
    recs = read_envelopes(spark, root)
    assert recs.count() == 10
    assert {r["pull_date"].isoformat() for r in recs.collect()} == {"2024-12-07", "2024-12-14"}
    util = series_utilization(typed_series(latest_records(recs)))
    assert [r["percent_utilization"] for r in util.collect()] == [90.0, 90.0]
    spine = spark.createDataFrame([(dt.date(2024, 12, 7),)], "as_of date")
    assert [r["U.S."] for r in jobs.utilization_job(spark, root, spine, newest_rows=2).collect()] == [90.0]


def test_file_name_decides_without_pull_dates(spark, tmp_path):
    from marketprep.sources.envelope import latest_records
    root = str(tmp_path)
    land(root, "YRL", [rec("2024-12-06", "NUS", "U.S.", "5")], "pull-2.json")
    land(root, "YRL", [rec("2024-12-06", "NUS", "U.S.", "7")], "pull-1.json")
    assert [r["value"] for r in latest_records(read_envelopes(spark, root)).collect()] == ["5"]


def test_nan_is_null(spark, tmp_path):
    root = str(tmp_path)
    land(root, "YRL", [rec("2024-12-06", "NUS", "U.S.", "NaN")])
    assert typed_series(read_envelopes(spark, root)).first()["value"] is None
    assert typed_series(read_envelopes(spark, root), strict=False).first()["value"] is None


def test_only_weeks_in_reach_are_joined(spark, series_root):
    from marketprep.plans.utilization import in_reach
    recs = typed_series(read_envelopes(spark, series_root))
    spine = spark.createDataFrame([(dt.date(2024, 12, 5),)], "as_of date")
    assert {r["period"].isoformat() for r in in_reach(recs, spine).collect()} == {"2024-11-29", "2024-11-22"}
    assert {r["period"].isoformat() for r in in_reach(recs, spine, parity=True).collect()} == {"2024-11-22"}


def test_strict_cast_fails_on_bad_text(spark, tmp_path):
    root = str(tmp_path)
    land(root, "YRL", [rec("2024-12-06", "NUS", "U.S.", "n/a")])
    with pytest.raises(PySparkException):
        typed_series(read_envelopes(spark, root)).collect()
    assert typed_series(read_envelopes(spark, root), strict=False).first()["value"] is None


def test_latest_week_wide(spark, series_root):
    util = series_utilization(typed_series(read_envelopes(spark, series_root)))
    days = [dt.date(2024, 12, 7), dt.date(2024, 12, 5), dt.date(2024, 11, 19), dt.date(2024, 11, 1)]
    spine = spark.createDataFrame([(d,) for d in days], "as_of date")
    wide = latest_week_wide(util, spine)
    assert wide.columns == ["as_of", "Date", "U.S.", "PADD3"]
    got = {r["as_of"].isoformat(): r for r in wide.collect()}
    # Saturday: this Friday (Dec 6) has rows.
    assert got["2024-12-07"]["Date"] == dt.date(2024, 12, 6)
    assert (got["2024-12-07"]["U.S."], got["2024-12-07"]["PADD3"]) == (88.1, 93.51)
    # Thursday Dec 5: this Friday = Nov 29.
    assert got["2024-12-05"]["Date"] == dt.date(2024, 11, 29)
    # Tuesday Nov 19: Friday Nov 15 has no joined area rows -> previous Friday Nov 8: no
    # listed areas either -> no row (the source raised on an empty week).
    assert "2024-11-19" not in got and "2024-11-01" not in got
    parity = {r["as_of"].isoformat(): r for r in latest_week_wide(util, spine, parity=True).collect()}
    assert parity["2024-12-07"]["Date"] == dt.date(2024, 11, 29)


def test_area_missing_on_one_side_is_null_column(spark):
    util = spark.createDataFrame([(dt.date(2024, 12, 6), "U.S.", 90.0)],
                                 "period date, area_name string, percent_utilization double")
    spine = spark.createDataFrame([(dt.date(2024, 12, 6),)], "as_of date")
    r = latest_week_wide(util, spine).first()
    assert r["U.S."] == 90.0 and r["PADD3"] is None


def test_period_is_date(spark, series_root):
    t = typed_series(read_envelopes(spark, series_root))
    assert dict(t.dtypes)["period"] == "date" and dict(t.dtypes)["value"] == "double"
    assert t.where(F.col("series_code") == "YUP").count() == 1


def test_generated_weeks_against_pandas(spark, tmp_path):
    """30 weeks x 3 areas, random gaps on either side, zero capacities and a
    duplicated key; join and percent checked against a pandas merge, the
    latest-week pick against a plain loop."""
    import random

    import numpy as np
    import pandas as pd

    rng = random.Random(11)
    root = str(tmp_path)
    areas = [("NUS", "U.S."), ("R30", "PADD 3"), ("R10", "PADD 1")]
    fridays = [dt.date(2024, 1, 5) + dt.timedelta(days=7 * w) for w in range(30)]
    cap, inp = [], []
    for f in fridays:
        for code, area in areas:
            if rng.random() < 0.85:
                cap.append(rec(f.isoformat(), code, area, rng.choice(["0", f"{rng.randint(900, 19000)}"])))
            if rng.random() < 0.85:
                inp.append(rec(f.isoformat(), code, area, f"{rng.uniform(500, 18000):.2f}"))
    inp.append(dict(inp[0]))  # duplicated key on the input side
    land(root, "YRL", cap)
    land(root, "EPXXX2", inp)

    util = series_utilization(typed_series(read_envelopes(spark, root)))
    got = sorted((r["period"], r["area_name"], r["percent_utilization"]) for r in util.collect())

    c = pd.DataFrame(cap).rename(columns={"area-name": "area"})
    i = pd.DataFrame(inp).rename(columns={"area-name": "area"})
    m = c.merge(i, on=["period", "duoarea", "area"], suffixes=("", ".in"))
    with np.errstate(divide="ignore", invalid="ignore"):
        pct = m["value.in"].astype(float) / m["value"].astype(float) * 100
    pct = np.round(pct, 2).replace([np.inf, -np.inf], np.nan)
    exp = sorted((dt.date.fromisoformat(p), a, None if np.isnan(v) else float(v))
                 for p, a, v in zip(m["period"], m["area"], pct))
    assert got == exp

    wanted = ["U.S.", "PADD 3"]
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(0, 215, 3)]
    spine = spark.createDataFrame([(d,) for d in days], "as_of date")
    wide = {r["as_of"]: r for r in latest_week_wide(util, spine).collect()}
    by_week = {}
    for p, a, v in exp:
        if a in wanted:
            by_week.setdefault(p, {})[a] = v
    for d in days:
        this_fri = d - dt.timedelta(days=(d.weekday() - 4) % 7)
        pick = next((f for f in (this_fri, this_fri - dt.timedelta(days=7)) if f in by_week), None)
        if pick is None:
            assert d not in wide
            continue
        r = wide[d]
        assert r["Date"] == pick
        assert r["U.S."] == by_week[pick].get("U.S.") and r["PADD3"] == by_week[pick].get("PADD 3")


def test_quarantine_bad_values(spark, tmp_path):
    from marketprep.sources.envelope import quarantine_values
    root = str(tmp_path)
    land(root, "YRL", [rec("2024-12-06", "NUS", "U.S.", "n/a"), rec("2024-12-06", "R30", "PADD 3", "10"),
                       rec("not-a-date", "R10", "PADD 1", "5"), rec("2024-12-06", "R20", "PADD 2", None)])
    good, bad = quarantine_values(read_envelopes(spark, root))
    assert sorted(r["area_name"] for r in bad.collect()) == ["PADD 1", "U.S."]
    g = {r["area_name"]: r for r in good.collect()}
    assert set(g) == {"PADD 3", "PADD 2"}
    assert g["PADD 3"]["value"] == 10.0 and g["PADD 2"]["value"] is None
    assert dict(good.dtypes)["period"] == "date"
