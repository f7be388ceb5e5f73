"""Queries over the driver's tables, one per operator group.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
columns are aliased to match the DuckDB oracle in ``oracle.py``.  Every query
reads whole tables; nothing is sampled or capped except where the cap is the
feature (the newest-12 facet queries ``facet_topn`` and ``facet_single``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import numeric as num
from ..functions import text as txt
from ..operators import joins, reshape, sections
from ..rules import (KEPT_COLUMN_COUNT, REPORT_COLUMNS, SERIES_CAPACITY, SERIES_GROSS_INPUT,
                     PivotRule)
from ..session import literal_rows, shared_path
from ..sources.tables import read_table
from ..sources import envelope, facets, reports
from .settlement import first_data_rows, priced
from .utilization import (latest_week_wide, percent_utilization, series_utilization, store_series,
                          stored_utilization)

# --------------------------------------------------------------------------
# Parameters of the driver-table queries (chosen here; the oracle SQL uses
# the same values)
# --------------------------------------------------------------------------
# rule_pivot: event_type -> (position, output column, value source, transform)
EVENT_RULES = (
    (0, "signup", "signup_value", "value", "none"),
    (1, "error", "error_k", "k", "none"),
    (2, "click", "click_inverse", "value", "reciprocal"),
    (3, "view", "view_value", "value", "none"),
    (4, "purchase", "purchase_k_inverse", "k", "reciprocal"),
)
EVENT_RULE_SCHEMA = "position int, event_type string, column string, source string, transform string"
# section_extract: header phrases searched in each document, and the footer.
SECTION_PHRASES = ("The ", "Es ", "Licensed", "Ort ", "rights")
SECTION_FOOTER_WORD = "the"
# section_extract_split: documents in a report file, and how much of one is read
# by a task (a small part of what a cluster takes, so that files are split here too).
DOCS_PER_REPORT = 250
SPLIT_BYTES = 1 << 17
# report_settlement: (position, header text, output column, price cell, transform)
# of the sections in the report that is made of each part.
PART_RULES = (
    (0, "A1 Alpha Futures", "alpha", "settlement", "none"),
    (1, "B2 Bravo Futures", "bravo", "last", "none"),
    (2, "C3 Charlie Futures", "charlie_inverse", "settlement", "reciprocal"),
    (3, "D4 Delta Futures", "delta", "settlement", "none"),
    (4, "E5 Echo Futures", "echo_inverse", "last", "reciprocal"),
)
PART_FOOTER = "TOTAL"


def part_cells_sql() -> str:
    """The kinds of cells a part's report draws from: a letter suffix, a leading
    dot, zero, no number, a sign, dashes, a whole and a decimal number."""
    size, key = "CAST(p_size AS STRING)", "CAST(p_partkey % 1000 AS STRING)"
    return (f"concat_ws(' ', {size} || '.' || {key} || 'A', '.' || {key}, '0', 'UNCH', '-' || {size} || '.' || {key}, "
            f"'----', {key}, {size} || '.' || {key})")


def part_report_sql(one_by_one: bool = True) -> str:
    """SQL (of either engine) that writes a report text from a row of ``part``:
    five sections, some without header or footer, with blank lines, and data
    lines of 7 to 12 tokens.  ``cells`` holds the eight kinds of cells
    (:func:`part_cells_sql`).  Without ``one_by_one``, Spark's SQL for the same
    text over an array ``cells``: a data line's cells are one short expression
    (as eleven expressions each they took twice the time)."""
    size, key = "CAST(p_size AS STRING)", "CAST(p_partkey % 1000 AS STRING)"

    def cell(i: int, j: int) -> str:
        return f"split_part(cells, ' ', CAST(1 + (p_partkey + p_size + {7 * i + j}) % 8 AS INT))"

    def data(i: int, month: str) -> str:
        n = f"7 + (p_partkey + {5 * i}) % 6"
        if one_by_one:
            cells = ", ".join(f"CASE WHEN {n} > {j} THEN {cell(i, j)} END" for j in range(1, 12))
        else:
            cells = (f"transform(sequence(1, {n} - 1), "
                     f"j -> element_at(cells, CAST(1 + (p_partkey + p_size + {7 * i} + j) % 8 AS INT)))")
        return f"concat_ws(' ', '{month}' || {size}, {cells})"

    parts = [f"'REPORT ' || {key}"]
    for i, header, *_ in PART_RULES:
        parts += [f"CASE WHEN p_size % 11 <> {i} THEN '{header} ' || p_brand END",
                  f"CASE WHEN (p_size + {i}) % 3 = 0 THEN '' END", data(i, "JAN"), data(i + 1, "FEB"),
                  f"CASE WHEN p_size % 7 <> {i} THEN '{PART_FOOTER} ' || {key} END"]
    return "concat_ws(chr(10), " + ", ".join(parts) + ")"


# envelope_audit, envelope_records: events in an envelope.
RECORDS_PER_ENVELOPE = 8
# facet_single: one facet value, newest first, offset and row count.
SINGLE_FACET_STATUS, SINGLE_FACET_OFFSET, SINGLE_FACET_ROWS = "F", 0, 12
# wide_two_areas: the two labels kept, as they appear in the data.
TWO_REGIONS = ("AMERICA", "MIDDLE EAST")
# fallback_week / asof_lookback filters.
FALLBACK_STATUS, FALLBACK_PRIORITY = "P", "1-URGENT"
ASOF_STATUS, ASOF_PRIORITY, ASOF_REGION = "F", "1-URGENT", 0
ASOF_YEAR_DAYS = 365
# stamped_pivot: the run date that is given.
RUN_DATE = "2024-01-20"
# stored_pull_ratio: buckets of the stored series table.
STORED_BUCKETS = 16


def _date(c: str):
    return F.to_date(F.col(c))


# ---------------------------------------------------------------- AGG-1/JOIN-3
def rule_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day, the latest value of each event type, placed by a rule table.

    Broadcast rule join (map side), value chosen and optionally inverted per
    rule, then one hash aggregate with a conditional ``max_by`` per column.
    """
    ev = read_table(spark, sf_dir, "events").select(
        _date("ts").alias("day"), "event_type", "event_id", "value", "props")
    rules = literal_rows(spark, EVENT_RULES, EVENT_RULE_SCHEMA)
    long = joins.lookup_rules(ev, rules, "event_type")
    # The raw value (a JSON parse for some rules) is its own column, computed
    # once per row; inlined into the CASE branches below it would be
    # re-evaluated per branch.
    raw = long.withColumn("raw", F.when(F.col("source") == "value", F.col("value")).otherwise(
        F.get_json_object("props", "$.k").cast("double")))
    v = F.when(F.col("transform") == "reciprocal",
               num.reciprocal_or_self("raw")).otherwise(F.col("raw"))
    pivot_rules = [PivotRule(p, col, col, src, tf) for p, _, col, src, tf in EVENT_RULES]
    return reshape.rule_pivot(raw.withColumn("v", v), ["day"], pivot_rules,
                              name_col="column", value_col="v", order_col="event_id")


def stamped_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DATE-5: the pivot's rows of days before a given run date, stamped with
    that date (never the clock) and keyed by it."""
    as_of = cal.as_of_date(RUN_DATE)
    wide = rule_pivot(spark, sf_dir)
    out = wide.where(F.col("day") < as_of).withColumn("as_of", as_of)
    return out.select("as_of", txt.compose_key("_", cal.format_compact("as_of"), cal.format_compact("day")).alias("run_key"),
                      F.date_diff("as_of", "day").alias("age_days"), *wide.columns)


# ---------------------------------------------------- SRC-1/JOIN-2/AGG-5/FLT-*
def section_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section lines of every document, whole-text form: a narrow map (no join,
    no aggregate, no shuffle)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sections.sections_in_text(docs, list(SECTION_PHRASES), keys=["doc_id"],
                                    footer=SECTION_FOOTER_WORD, header_col="phrase")
    return out.select("doc_id", "phrase", "line_no", "line")


def section_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document and phrase: header line, footer line (NULL when missing)
    and whether a complete section exists - the report instead of a crash."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    st = sections.sections_in_text(docs, list(SECTION_PHRASES), keys=["doc_id"],
                                   footer=SECTION_FOOTER_WORD, header_col="phrase",
                                   keep_status=True)
    return st.select("doc_id", "phrase", F.col("header_line").cast("bigint").alias("header_line"),
                     F.col("footer_line").cast("bigint").alias("footer_line"),
                     F.col("footer_line").isNotNull().alias("found"))


def section_extract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same result through the line-table form (lines dealt out once by report
    and block)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = sections.report_lines(docs, keys=["doc_id"])
    out = sections.sections_in_lines(lines, list(SECTION_PHRASES), keys=["doc_id"],
                                     footer=SECTION_FOOTER_WORD, header_col="phrase")
    return out.select("doc_id", "phrase", "line_no", "line")


def section_extract_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scan over reports read in splits: documents are landed as report
    files of many documents each, in order of their ids, and read back in parts
    of ``SPLIT_BYTES``, whose lines are numbered over the whole file."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    report = F.floor(F.col("doc_id") / DOCS_PER_REPORT).alias("report")
    root = shared_path(spark, "report-files")
    (docs.where("doc_id is not null").select(report, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
     .repartition("report").sortWithinPartitions("report", "doc_id", "text")
     .select("text", "report").write.partitionBy("report").text(root))
    lines = reports.read_lines(spark, root, split_bytes=SPLIT_BYTES).withColumn("report", F.col("report").cast("bigint"))
    out = sections.sections_in_lines(lines.select("report", "line_no", "line"), list(SECTION_PHRASES), keys=["report"],
                                     footer=SECTION_FOOTER_WORD, header_col="phrase")
    return out.select("report", "phrase", "line_no", "line")


# ----------------------------------------------------------- STR-1/2/3, SRC-3
def ragged_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ragged lines (7-12 tokens) built from ``part``; tokenise, pad, name."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    line = F.concat_ws(" ", "p_name", "p_brand", "p_type",
                       F.repeat(F.concat("p_brand", F.lit(" ")), F.lit(3) + F.col("p_size") % 6))
    t = p.select("p_partkey", txt.tokens(line).alias("t"))
    padded = t.select("p_partkey", "t", txt.pad_ragged(F.col("t")).alias("padded"))
    # All eleven report cells by name, then the first six by position (PRJ-2).
    named = padded.select(*txt.token_columns("padded", [c.lower() for c in REPORT_COLUMNS]),
                          "p_partkey", "t", "padded")
    kept = reshape.select_first_n_columns(named, KEPT_COLUMN_COUNT).columns
    return named.select(
        "p_partkey",
        F.size("t").alias("n_tokens"),
        *kept,
        txt.join_tokens("padded").alias("padded_csv"),
        txt.is_irregular("t").alias("is_irregular"))


# ------------------------------------------------------- STR-4/5, CAST-1, PRJ-1
def clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First number of several text shapes, default and parity patterns."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    size = num.to_text("p_size")
    key = num.to_text("p_partkey")
    shapes = {
        "brand": F.col("p_brand"),                                     # 'Brand#13'
        "name": F.col("p_name"),                                       # no digits
        "dot": F.concat(F.lit("."), size),                             # '.11'
        "neg": F.concat(F.lit("-"), size, F.lit("."), key),            # '-11.42'
        "negdot": F.concat(F.lit("-."), size),                         # '-.11'
        "suffix": F.concat(size, F.lit("."), key, F.lit("A")),         # '11.42A'
    }
    cols = [F.col("p_partkey")]
    for name, s in shapes.items():
        cols.append(txt.first_number(s).alias(f"{name}_default"))
        cols.append(txt.first_number(s, parity=True).alias(f"{name}_parity"))
    return p.select(*cols)


def clean_numeric_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cleaning on customer text: zero-padded keys in names, signed
    and dot-leading shapes built from integer columns."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    key = num.to_text("c_custkey")
    nation = num.to_text("c_nationkey")
    shapes = {
        "name": F.col("c_name"),                                      # 'Customer#000000042'
        "segment": F.col("c_mktsegment"),                             # no digits
        "dotkey": F.concat(F.lit("."), key),                          # '.42'
        "negmix": F.concat(F.lit("-"), nation, F.lit("."), key),      # '-7.42'
        "plus": F.concat(F.lit("+"), nation, F.lit("x"), key),        # '+7x42'
    }
    cols = [F.col("c_custkey")]
    for name, s in shapes.items():
        cols.append(txt.first_number(s).alias(f"{name}_default"))
        cols.append(txt.first_number(s, parity=True).alias(f"{name}_parity"))
    return c.select(*cols)


# ------------------------------------------------------------------ SRC-2/CAST-2
def json_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event wrapped as a one-record envelope, then parsed back.

    ``to_json`` -> ``from_json`` with an explicit schema -> ``inline`` ->
    strict cast; all narrow, per row.
    """
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    record = F.struct(
        cal.format_iso(F.col("ts")).alias("period"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("duoarea"),
        F.col("event_type").alias("area-name"),
        F.lit("event value").alias("series-description"),
        F.col("value").cast("string").alias("value"),
        F.lit("USD").alias("units"),
        F.col("props").alias("product-name"))
    env = ev.select("event_id", F.to_json(F.struct(F.struct(F.array(record).alias("data"))
                                                   .alias("response"))).alias("body"))
    recs = envelope.unwrap_envelope(env, "body", keep=("event_id",))
    typed = envelope.typed_series(recs, strict=True)
    return typed.select(
        "event_id", "period", "duoarea", "area_name", "value",
        F.from_json("product_name", "k bigint").getField("k").alias("k"))


def _event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(envelope, body)``: the events in envelopes of a few records each, some
    of them cut off, without data, or empty."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    record = F.struct(F.lpad(num.to_text("event_id"), 12, "0").alias("period"), F.col("event_type").alias("area-name"),
                      num.to_text("value").alias("value"))
    env = F.floor(F.col("event_id") / RECORDS_PER_ENVELOPE).alias("envelope")
    whole = ev.groupBy(env).agg(F.to_json(F.struct(F.struct(F.sort_array(F.collect_list(record)).alias("data"))
                                                   .alias("response"))).alias("body"))
    e = F.col("envelope")
    half = F.substring("body", F.lit(1), F.floor(F.length("body") * 2 / 3).cast("int"))
    return whole.select("envelope", F.when(e % 13 == 1, "").when(e % 7 == 3, half)
                        .when(e % 11 == 5, '{"response":{}}').otherwise(F.col("body")).alias("body"))


def envelope_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and number of records of each envelope, readable or not."""
    return envelope.audit_envelopes(_event_envelopes(spark, sf_dir), "body", keep=("envelope",))


def envelope_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the readable envelopes (several each)."""
    recs = envelope.unwrap_envelope(_event_envelopes(spark, sf_dir), "body", keep=("envelope",))
    return recs.select("envelope", F.col("period").cast("bigint").alias("event_id"), "area_name",
                       num.to_double_strict("value").alias("value"))


# ----------------------------------------------------------------- SRC-7/TOP-2
def facet_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 12 orders per status (the 12 is the feature)."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderkey", _date("o_orderdate").alias("o_orderdate"), "o_totalprice")
    out = facets.facet_top_n(o, None, ["o_orderstatus"],
                             [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return out.select("o_orderstatus", "o_orderkey", "o_orderdate", "o_totalprice", "rn")


# ------------------------------------------------------------------------ TOP-1
def first_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event per user by (ts, event_id)."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return reshape.first_per_group(ev, ["user_id"], ["ts", "event_id"])


# ------------------------------------------------------------------------ AGG-4
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event per (user, event type) by (ts, event_id)."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return reshape.last_per_group(ev, ["user_id", "event_type"], ["ts", "event_id"])


# ------------------------------------------------------------------ SET-1/PRJ-5
def concat_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers in one table; segment is NULL for suppliers."""
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"))
    s = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return reshape.concat_tagged({"customer": c, "supplier": s})


# ------------------------------------------------- JOIN-1, MATH-2/3, PRJ-3/4
def _nation_region(spark: SparkSession, sf_dir: str, regions=None) -> DataFrame:
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    if regions is not None:
        r = r.where(F.col("r_name").isin(list(regions)))
    # nation/region are dimension tables; the planner broadcasts them from
    # their file size (checked against autoBroadcastJoinThreshold).
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        "n_nationkey", "n_regionkey", "r_name")


def _period_values(spark: SparkSession, sf_dir: str, regions=None, grain=("nationkey", "regionkey"),
                   period=lambda d: F.trunc(d, "month"), period_name: str = "month"):
    """Ordered value (by order period) and shipped value (by ship period) per
    (period, <grain>), exact decimal sums, for the periods that have both; the
    period is a month by default.

    Customers give each order key its place once.  What was ordered and what
    was shipped are then rows of one table keyed by the order, joined to that
    once and summed into (period, grain) groups side by side, so the partial
    aggregate leaves one row per group per task and the final shuffle is tiny;
    no second join brings the two sums together.  Spark broadcasts a side only
    when its measured size is under the threshold; AQE splits a hot customer's
    partition (skew join) instead of sending a third of all orders to one task.
    The region filter sits on the small side and prunes before the fact joins.
    """
    orders = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    geo = _nation_region(spark, sf_dir, regions)
    keep = {"nationkey": F.col("n_nationkey").alias("nationkey"),
            "regionkey": F.col("n_regionkey").alias("regionkey"),
            "region": F.col("r_name").alias("region")}
    cust_geo = cust.join(geo, cust.c_nationkey == geo.n_nationkey, "inner").select(
        "c_custkey", *[keep[g] for g in grain])
    places = orders.join(cust_geo, orders.o_custkey == cust_geo.c_custkey, "inner").select("o_orderkey", *grain)
    amount = num.exact_money("l_extendedprice") * (1 - num.exact_money("l_discount", 4, 2))
    moves = orders.select(F.col("o_orderkey").alias("k"), period(_date("o_orderdate")).alias(period_name),
                          num.exact_money("o_totalprice").alias("ordered")).unionByName(
        li.select(F.col("l_orderkey").alias("k"), period(_date("l_shipdate")).alias(period_name),
                  amount.alias("shipped")), allowMissingColumns=True)
    keys = [period_name, *grain]
    both = places.join(moves, places.o_orderkey == moves.k).groupBy(*keys).agg(
        F.sum("ordered").cast("double").alias("output_value"), F.sum("shipped").cast("double").alias("input_value"))
    return both.where("output_value is not null and input_value is not null").select(
        *keys, "output_value", "input_value", percent_utilization().alias("percent_utilization"))


def ratio_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped over ordered value per (month, nation, region), in percent."""
    return _period_values(spark, sf_dir)


# ------------------------------------------------- AGG-2/3, PRJ-6, FLT-4, STR-6
def wide_two_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region-level utilization for two regions, one wide row per month."""
    util = _period_values(spark, sf_dir, regions=TWO_REGIONS, grain=("region",))
    labelled = util.withColumn("label", txt.strip_spaces("region"))
    labels = [r.replace(" ", "") for r in TWO_REGIONS]
    wide = reshape.label_pivot(labelled, ["month"], "label", "percent_utilization", labels)
    return reshape.select_in_order(reshape.rename(wide, {"month": "Date"}), ["Date", *labels])


# ------------------------------------------------ FLT-3/5, DATE-1/2/6
def _order_day_spine(spark: SparkSession, sf_dir: str, col: str = "day") -> DataFrame:
    """Every calendar day between the first and last order date.

    One global min/max (a single-row aggregate), then ``sequence`` + explode;
    the spine is bounded by the calendar, not by the data volume.
    """
    o = read_table(spark, sf_dir, "orders").select(_date("o_orderdate").alias("d"))
    b = o.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi")).alias(col))


def fallback_week(spark: SparkSession, sf_dir: str, parity: bool = False) -> DataFrame:
    """Per day: this Friday's urgent pending orders, else last Friday's.

    ``parity=True`` tries only the previous Friday (the source compared a
    text date with a datetime, so the current Friday never matched).
    """
    spine = _order_day_spine(spark, sf_dir)
    o = read_table(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") == FALLBACK_STATUS) & (F.col("o_orderpriority") == FALLBACK_PRIORITY))
    fri = (o.select(_date("o_orderdate").alias("d"), num.exact_money("o_totalprice").alias("amt"))
           .where(cal.weekday("d") == cal.FRIDAY)
           .groupBy("d").agg(F.count(F.lit(1)).alias("n_orders"),
                             F.sum("amt").cast("double").alias("total_price")))
    this_fri = cal.last_friday(F.col("day"))
    cands = [cal.days_before(this_fri, 7)] if parity else [this_fri, cal.days_before(this_fri, 7)]
    out = joins.first_nonempty_candidate(spine, ["day"], cands, fri, "d",
                                         cand_name="friday", rank_name="fallback_rank")
    return out.select("day", "friday", "fallback_rank", "n_orders", "total_price")


def fallback_week_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fallback_week`` as the source behaved (Q1): only the previous Friday."""
    return fallback_week(spark, sf_dir, parity=True)


# ------------------------------------------------------ SRC-6, JOIN-4, DATE-3
def asof_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day, the nearest available 'report' date within a 7-day lookback,
    in the corrected trial order and in the source's order."""
    o = read_table(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") == ASOF_STATUS) & (F.col("o_orderpriority") == ASOF_PRIORITY))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").where(F.col("n_regionkey") == ASOF_REGION) \
        .select("n_nationkey")
    # Semi joins all the way: only the order dates are needed, so neither the
    # customer nor the nation columns travel, and no row can be duplicated.
    region_cust = cust.join(n, cust.c_nationkey == n.n_nationkey, "left_semi").select("c_custkey")
    inv = (o.join(region_cust, o.o_custkey == region_cust.c_custkey, "left_semi")
           .select(_date("o_orderdate").alias("report_date")).distinct())
    spine = _order_day_spine(spark, sf_dir, "as_of")
    out = joins.asof_lookback(spine, "as_of", inv, "report_date",
                              modes=("corrected", "reference"))
    return out.select(
        "as_of", "corrected_found_date", "corrected_offset",
        "reference_found_date", "reference_offset")


def asof_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, the customer's latest urgent order placed on a weekday within a
    year up to it (a window of 365 days, no row per candidate day)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", _date("o_orderdate").alias("o_date"))
    urgent = o.where(F.col("o_orderpriority") == ASOF_PRIORITY).select("o_custkey", F.col("o_date").alias("urgent_date"))
    out = joins.asof_merge(o.select("o_orderkey", "o_custkey", "o_date"), "o_date", urgent, "urgent_date",
                           keys=["o_custkey"], days=ASOF_YEAR_DAYS)
    return out.select("o_orderkey", "o_custkey", "o_date", "found_date", "offset")


# ------------------------------------- job B shape: weekly, fallback week, wide
def weekly_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job B end to end on the driver tables.

    Weekly (week ending Friday) shipped over ordered value for two regions,
    half-even percent; then for every calendar day the
    latest week with data (this Friday, else the previous one) pivoted into
    one row ``as_of, Date, AMERICA, MIDDLEEAST``.
    """
    util = _period_values(spark, sf_dir, regions=TWO_REGIONS, grain=("region",),
                          period=cal.week_ending_friday, period_name="period") \
        .withColumnRenamed("region", "area_name")
    spine = _order_day_spine(spark, sf_dir, "as_of")
    return latest_week_wide(util, spine, areas=TWO_REGIONS)


# ----------------------------------------- job A shape: sections -> wide rows
def _part_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report per part.  The rows are few bytes each, so a file's split holds
    many, and a report takes far longer to write and scan than to read: they are
    dealt out first, by whole row and to a set number of tasks (which Spark does
    not merge because they are small)."""
    cols = ["p_partkey", "p_size", "p_brand"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = read_table(spark, sf_dir, "part").select(*cols).repartition(tasks, *cols)
    # The cells are cut once per row, not once per use.
    return p.withColumn("cells", F.split(F.expr(part_cells_sql()), " ")).select(
        "p_partkey", F.expr(part_report_sql(one_by_one=False)).alias("text"))


def _part_pivot(status: DataFrame) -> DataFrame:
    """Rule pivot of the first-row cells: month, price and irregularity per rule."""
    rows = first_data_rows(status, ["p_partkey", "position"], header_col="header")
    rules = [PivotRule(p, header, col, price, tf) for p, header, col, price, tf in PART_RULES]
    cells = priced(rows, rules).withColumn("cell", F.struct(
        F.col("Month").alias("month"), F.col("price_value").alias("price"), "is_irregular"))
    wide = reshape.rule_pivot(cells, ["p_partkey"], rules, name_col="Data_Set", value_col="cell",
                              order_col="position")
    out = [F.col("p_partkey")]
    for r in rules:
        out += [F.col(f"{r.column}.month").alias(f"{r.column}_month"),
                F.col(f"{r.column}.price").alias(r.column),
                F.col(f"{r.column}.is_irregular").alias(f"{r.column}_irregular")]
    return wide.select(*out)


def report_settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job A end to end on a report text per part: per header the first data
    line of the section, tokenised, padded, numbers cleaned, then a rule pivot
    to one wide row per report (whole-text form)."""
    status = sections.sections_in_text(_part_reports(spark, sf_dir), [r[1] for r in PART_RULES],
                                       keys=["p_partkey"], footer=PART_FOOTER, header_col="header",
                                       keep_status=True)
    return _part_pivot(status)


def report_settlement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result through the line-table form used for reports too large
    for one row: lines dealt out by report and block, ``min_by`` first line."""
    lines = sections.report_lines(_part_reports(spark, sf_dir), keys=["p_partkey"])
    sec = sections.sections_in_lines(lines, [r[1] for r in PART_RULES], keys=["p_partkey"],
                                     footer=PART_FOOTER, header_col="header")
    firsts = reshape.first_per_group(sec.where(txt.has_text("line")),
                                     ["p_partkey", "position", "header"], ["line_no"], cols=["line"])
    return _part_pivot(firsts.withColumn("section_lines", F.array("line")))


# --------------------------------------- job B inputs: latest pull, bad values
def _order_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a pulled record of a series (odd keys capacity, even keys
    gross input) for its month, customer nation (NULL for some) and segment, so
    each record is pulled many times."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.when(F.col("o_orderkey") % 2 == 1, SERIES_CAPACITY).otherwise(SERIES_GROSS_INPUT).alias("series_code"),
        F.trunc(_date("o_orderdate"), "month").alias("period"),
        F.when(F.col("c_nationkey") % 6 != 0, F.concat(F.lit("N"), num.to_text("c_nationkey"))).alias("duoarea"),
        F.col("c_mktsegment").alias("area_name"), F.lit("pulled").alias("series_description"),
        F.col("o_totalprice").alias("value"), F.lit("USD").alias("units"), F.lit("p").alias("product_name"),
        _date("o_orderdate").alias("pull_date"),
        F.lpad(num.to_text("o_orderkey"), 12, "0").alias("file_name"), F.lit(0).alias("record_no"))


def latest_pull_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest pull of each record counts, and the two series join where NULL
    keys match (AGG-4 before JOIN-1)."""
    out = series_utilization(envelope.latest_records(_order_pulls(spark, sf_dir)))
    return out.select("period", "duoarea", "area_name", "output_value", "input_value", "percent_utilization")


def stored_pull_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stored table, bucketed by the join keys, whose series
    join without an exchange."""
    path = shared_path(spark, "series")
    latest = envelope.latest_records(_order_pulls(spark, sf_dir))
    stored = store_series(latest, "series_" + path.rpartition("-")[2], STORED_BUCKETS, path=path)
    return stored_utilization(stored).select(
        "period", "duoarea", "area_name", "output_value", "input_value", "percent_utilization")


def series_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CAST-2 over events as text records: numbers, NaN text (NULL), missing
    values and bad text or dates, which are set aside with their raw text."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "value")
    k = F.col("event_id") % 10
    recs = ev.select(
        "event_id",
        F.when(k == 9, "not-a-date").otherwise(cal.format_iso("ts")).alias("period"),
        F.when(k == 0, "NaN").when(k == 1, "n/a").when(k != 2, num.to_text("value")).alias("value"))
    good, bad = envelope.quarantine_values(recs)
    return good.select("event_id", "period", "value", F.lit(None).cast("string").alias("bad_text")).unionByName(
        bad.select("event_id", F.lit(None).cast("date").alias("period"), F.lit(None).cast("double").alias("value"),
                   F.concat_ws("|", "period", "value").alias("bad_text")))


# ------------------------------------------------------- TOP-2, single facet
def facet_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One facet value, newest first, ``OFFSET .. LIMIT`` (the 12 is the feature)."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderkey", _date("o_orderdate").alias("o_orderdate"), "o_totalprice")
    return facets.facet_top_n(o, {"o_orderstatus": [SINGLE_FACET_STATUS]}, [],
                              [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
                              n=SINGLE_FACET_ROWS, offset=SINGLE_FACET_OFFSET)


# ------------------------------------------------------------------ STR-7/DATE-4
def report_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing keys built from each order's date and priority."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        txt.compose_key("-", cal.format_compact("o_orderdate"), "o_orderpriority").alias("report_key"),
        cal.format_iso("o_orderdate").alias("iso_date"),
        F.concat(txt.strip_spaces("o_orderpriority"), F.lit("_"),
                 cal.format_stamp("o_orderdate"), F.lit(".txt")).alias("file_name"))


QUERIES = {
    "rule_pivot": rule_pivot,
    "stamped_pivot": stamped_pivot,
    "section_extract": section_extract,
    "section_extract_lines": section_extract_lines,
    "section_extract_split": section_extract_split,
    "section_status": section_status,
    "ragged_pad": ragged_pad,
    "clean_numeric": clean_numeric,
    "clean_numeric_customer": clean_numeric_customer,
    "json_unwrap": json_unwrap,
    "envelope_audit": envelope_audit,
    "envelope_records": envelope_records,
    "facet_topn": facet_topn,
    "first_per_group": first_per_group,
    "dedup_last": dedup_last,
    "concat_tagged": concat_tagged,
    "ratio_join": ratio_join,
    "wide_two_areas": wide_two_areas,
    "fallback_week": fallback_week,
    "fallback_week_parity": fallback_week_parity,
    "asof_lookback": asof_lookback,
    "asof_year": asof_year,
    "report_key": report_key,
    "weekly_utilization": weekly_utilization,
    "report_settlement": report_settlement,
    "report_settlement_lines": report_settlement_lines,
    "facet_single": facet_single,
    "latest_pull_ratio": latest_pull_ratio,
    "stored_pull_ratio": stored_pull_ratio,
    "series_quarantine": series_quarantine,
}
