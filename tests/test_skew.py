"""Hot keys: one key holding a third of all rows.  Results must stay whole
and exact; the operators must not rely on a key being small."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketprep.operators import joins, reshape
from marketprep.rules import PivotRule

from .conftest import plan_text

N = 30_000


def skewed_events(spark):
    # user 7 owns every third row; the rest spread over 500 users.
    return spark.range(N, numPartitions=8).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500 + 1000).alias("user_id"),
        (F.col("id") * 7919 % 1000).alias("ts"),
        F.element_at(F.array(*[F.lit(x) for x in ("a", "b", "c")]),
                     (F.col("id") % 3 + 1).cast("int")).alias("kind"),
        (F.col("id") % 97).cast("double").alias("value"))


def test_first_and_last_per_group_hot_key(spark):
    ev = skewed_events(spark)
    pdf = ev.toPandas()
    first = reshape.first_per_group(ev, ["user_id"], ["ts", "event_id"]).toPandas()
    exp = pdf.sort_values(["ts", "event_id"]).groupby("user_id").head(1)
    assert len(first) == pdf["user_id"].nunique()
    got = first.set_index("user_id")["event_id"].sort_index()
    assert got.equals(exp.set_index("user_id")["event_id"].sort_index())
    last = reshape.last_per_group(ev, ["user_id", "kind"], ["ts", "event_id"]).toPandas()
    exp = pdf.sort_values(["ts", "event_id"]).groupby(["user_id", "kind"]).tail(1)
    assert sorted(last["event_id"]) == sorted(exp["event_id"])


def test_top_n_hot_key(spark):
    ev = skewed_events(spark)
    out = reshape.top_n_per_group(ev, ["user_id"], [F.col("value").desc(), F.col("event_id")], 5)
    got = out.where(F.col("user_id") == 7).orderBy("rn").select("event_id").toPandas()["event_id"]
    pdf = ev.where(F.col("user_id") == 7).toPandas()
    exp = pdf.sort_values(["value", "event_id"], ascending=[False, True]).head(5)["event_id"]
    assert list(got) == list(exp)
    assert out.count() == 5 * ev.select("user_id").distinct().count()


def test_rule_pivot_hot_group(spark):
    ev = skewed_events(spark).withColumn("day", F.when(F.col("user_id") == 7, 0).otherwise(1))
    rules = [PivotRule(i, k, f"v_{k}", "value", "none") for i, k in enumerate("abc")]
    wide = {r["day"]: r for r in reshape.rule_pivot(ev, ["day"], rules, "kind", "value",
                                                    "event_id").collect()}
    pdf = ev.toPandas()
    for day, grp in pdf.groupby("day"):
        for k in "abc":
            sub = grp[grp.kind == k]
            exp = sub.loc[sub.event_id.idxmax(), "value"] if len(sub) else None
            assert wide[day][f"v_{k}"] == exp


def test_null_safe_join_hot_key(spark):
    left = spark.range(9_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 10).alias("k"),
        F.col("id").alias("a"))
    right = spark.createDataFrame([(None, 1.0)] + [(i, float(i)) for i in range(10)], "k long, b double")
    out = joins.null_safe_join(left, right, ["k"])
    assert out.count() == 9_000                      # NULL keys (a third) matched, none lost
    assert out.where(F.col("k").isNull()).count() == 3_000


def test_hot_key_plan_combines_before_shuffle(spark):
    ev = skewed_events(spark)
    for df in (reshape.first_per_group(ev, ["user_id"], ["ts", "event_id"]),
               reshape.rule_pivot(ev, ["user_id"], [PivotRule(0, "a", "va", "value", "none")],
                                  "kind", "value", "event_id")):
        plan = plan_text(df, "simple")
        before_exchange = plan.split("Exchange hashpartitioning")[1]
        assert "partial_" in before_exchange


def test_facet_offsets(spark):
    from marketprep.sources.facets import facet_top_n
    df = spark.range(100).select(F.col("id"), (F.col("id") % 2).alias("s"),
                                 (F.col("id") % 3).cast("string").alias("f"))
    order = [F.col("id").desc()]
    per = facet_top_n(df, {"f": ["0", "1"]}, ["s"], order, n=3, offset=2).collect()
    got = sorted((r["s"], r["id"], r["rn"]) for r in per)
    pdf = df.toPandas()
    pdf = pdf[pdf.f.isin(["0", "1"])]
    exp = []
    for s, g in pdf.groupby("s"):
        ids = sorted(g.id, reverse=True)[2:5]
        exp += [(s, i, k + 3) for k, i in enumerate(ids)]
    assert got == sorted(exp)
    single = [r["id"] for r in facet_top_n(df, {"f": ["2"]}, [], order, n=4, offset=3).collect()]
    assert single == sorted((i for i in range(100) if i % 3 == 2), reverse=True)[3:7]


def test_hot_report_is_dealt_out_by_blocks(spark):
    """One report with three quarters of all lines: its lines are joined by
    (report, block), no group is larger than a block, and the result is whole."""
    from marketprep.operators import sections
    text = "\n".join(["x", "HEAD one"] + [f"row {i}" for i in range(6_000)] + ["END", "HEAD two", "y", "END"])
    small = "\n".join(["HEAD one", "a", "b", "END"] + ["z"] * 60)
    docs = spark.createDataFrame([(0, text)] + [(i, small) for i in range(1, 31)], "k long, text string")
    lines = sections.report_lines(docs, keys=["k"])
    block = 256
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = sections.sections_in_lines(lines, ["HEAD one", "HEAD two"], keys=["k"], footer="END",
                                         header_col="h", block_lines=block)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = plan_text(out, "simple")
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
        assert plan.count("posexplode") == 1 and "ReusedExchange" in plan
        assert "SortMergeJoin [k" in plan and "_block" in plan
        got = out.collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    want = sorted((r.k, r.h, r.line_no, r.line) for r in sections.sections_in_text(
        docs, ["HEAD one", "HEAD two"], keys=["k"], footer="END", header_col="h").collect())
    assert sorted((r.k, r.h, r.line_no, r.line) for r in got) == want
    assert sum(r.k == 0 for r in got) == 6_001
