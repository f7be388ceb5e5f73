"""Refinery utilization (job B) over whole series histories.

records (series_code, period, duoarea, area_name, series_description, value,
units, product_name) -> capacity x gross input null-safe join -> percent,
half-even 2 dp -> per as-of date the latest available week (this Friday,
else the previous one) -> one wide row ``Date, U.S., PADD3`` per as-of date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import numeric as num
from ..functions import text as txt
from ..operators import joins, reshape
from ..rules import (SERIES_CAPACITY, SERIES_GROSS_INPUT, SERIES_JOIN_KEYS,
                     UTILIZATION_AREAS)

# Renames of the joined series columns (PRJ-4): capacity is the "output" side.
OUTPUT_NAMES = {"series_description": "output_description", "value": "output_value",
                "units": "output_units"}
INPUT_NAMES = {"series_description": "input_description", "value": "input_value",
               "units": "input_units"}


def percent_utilization(digits: int = 2) -> Column:
    """MATH-2/3: gross input over capacity in percent, half-even."""
    return num.round_half_even(num.percent_ratio("input_value", "output_value"), digits)


def utilization(capacity: DataFrame, gross_input: DataFrame, keys: Sequence[str],
                digits: int = 2) -> DataFrame:
    """JOIN-1 + MATH-2/3: inner null-safe join on ``keys``, then
    ``percent_utilization = round_half_even(input / capacity * 100, digits)``.

    ``capacity`` carries ``output_value``, ``gross_input`` ``input_value``.
    Division by zero gives NULL, not inf.
    """
    j = joins.null_safe_join(capacity, gross_input, keys, suffix="_input")
    return j.withColumn("percent_utilization", percent_utilization(digits))


def series_utilization(records: DataFrame, keys: Sequence[str] = SERIES_JOIN_KEYS,
                       areas: Sequence[str] | None = None) -> DataFrame:
    """Job B join step over typed records (``value`` already DOUBLE).

    Area filters are applied to both inputs *before* the join: a filter is not
    inferred across ``<=>`` keys.
    """
    keys = list(keys)
    base = records
    if areas is not None:
        base = base.where(F.col("area_name").isin(list(areas)))
    cols = ["series_description", "value", "units"]
    cap = (base.where(F.col("series_code") == SERIES_CAPACITY)
           .select(*keys, *cols).withColumnsRenamed(OUTPUT_NAMES))
    # product_name is read for the join input and dropped (PRJ-3).
    inp = (base.where(F.col("series_code") == SERIES_GROSS_INPUT)
           .select(*keys, *cols, "product_name").drop("product_name")
           .withColumnsRenamed(INPUT_NAMES))
    return utilization(cap, inp, keys)


# Column of a stored series table: all join keys of a record as one text that is
# never NULL (a NULL key has its own form), so that NULL keys match in a plain
# equality, by which the table is bucketed.
STORED_KEY = "_key"


def store_series(records: DataFrame, table: str, buckets: int, keys: Sequence[str] = SERIES_JOIN_KEYS,
                 path: str | None = None) -> DataFrame:
    """JOIN-1 on a stored layout: write typed records as a table bucketed and
    sorted by their join keys, and read it back.  :func:`stored_utilization`
    then joins series of it without moving a row; ``buckets`` should leave some
    hundred MB in each.  ``path`` makes it an external table there."""
    key = F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]), {"ignoreNullFields": "false"})
    out = records.withColumn(STORED_KEY, key).repartition(buckets, STORED_KEY)
    w = out.write.format("parquet").bucketBy(buckets, STORED_KEY).sortBy(STORED_KEY).mode("overwrite")
    (w.option("path", path) if path else w).saveAsTable(table)
    return records.sparkSession.table(table)


def stored_utilization(stored: DataFrame, keys: Sequence[str] = SERIES_JOIN_KEYS,
                       areas: Sequence[str] | None = None) -> DataFrame:
    """:func:`series_utilization` over a stored series table: the same rows by an
    equality of the stored key, within buckets."""
    base = stored if areas is None else stored.where(F.col("area_name").isin(list(areas)))
    cols = ["series_description", "value", "units"]
    cap = (base.where(F.col("series_code") == SERIES_CAPACITY)
           .select(STORED_KEY, *keys, *cols).withColumnsRenamed(OUTPUT_NAMES))
    inp = (base.where(F.col("series_code") == SERIES_GROSS_INPUT)
           .select(F.col(STORED_KEY).alias("_other"), *cols).withColumnsRenamed(INPUT_NAMES))
    both = cap.join(inp, F.col(STORED_KEY) == F.col("_other")).drop(STORED_KEY, "_other")
    return both.withColumn("percent_utilization", percent_utilization())


def candidate_weeks(as_of: Column, parity: bool = False) -> list[Column]:
    """The Fridays whose week an as-of date may report, in order: this one,
    else the previous one (``parity``: only the previous one)."""
    this_fri = cal.last_friday(as_of)
    before = cal.days_before(this_fri, 7)
    return [before] if parity else [this_fri, before]


def in_reach(records: DataFrame, spine: DataFrame, parity: bool = False, as_of_col: str = "as_of",
             period_col: str = "period") -> DataFrame:
    """Only the records of weeks that an as-of date can report.  Done before
    the null-safe join, across which no filter is inferred."""
    weeks = _weeks(spine, parity, as_of_col).withColumnRenamed("_week", period_col)
    return records.join(weeks, period_col, "left_semi").select(*records.columns)


def _weeks(spine: DataFrame, parity: bool, as_of_col: str) -> DataFrame:
    return spine.select(F.explode(F.array(*candidate_weeks(F.col(as_of_col), parity))).alias("_week")).distinct()


def asked_years(spine: DataFrame, parity: bool = False, as_of_col: str = "as_of") -> DataFrame:
    """``(year)`` as text of the weeks that the as-of dates can report."""
    weeks = _weeks(spine, parity, as_of_col).where(F.col("_week") > F.lit("0001-01-01").cast("date"))
    return weeks.select(F.date_format("_week", "yyyy").alias("year")).distinct()


def raw_in_reach(records: DataFrame, spine: DataFrame, parity: bool = False, as_of_col: str = "as_of") -> DataFrame:
    """The same for records whose ``period`` is still text, so that only weeks
    that can be reported are shuffled, compared by pull and typed.  A text that
    is no date stays, to be refused or set aside like any bad text."""
    week = F.col("period").try_cast("date")
    weeks = _weeks(spine, parity, as_of_col).withColumn("_asked", F.lit(True))
    return (records.withColumn("_week", week).join(weeks, "_week", "left")
            .where(F.col("_asked") | (F.col("period").isNotNull() & F.col("_week").isNull()))
            .select(*records.columns))


def latest_week_wide(util: DataFrame, spine: DataFrame, as_of_col: str = "as_of",
                     areas: Sequence[str] = UTILIZATION_AREAS, parity: bool = False) -> DataFrame:
    """FLT-5 + AGG-2: for each as-of date choose the week to report (this
    Friday if it has rows for the areas, else the previous Friday), then one
    wide row ``as_of, Date, <area labels without spaces>``.

    ``parity=True`` always uses the previous Friday, as the source job did.

    Plan: the candidate weeks of every as-of date are joined once to the
    (small, per week x area) utilization table, pivoted per (as-of, rank),
    and the lowest rank per as-of date is kept.  As-of dates whose
    candidate weeks have no rows produce no row.
    """
    labels = [a.replace(" ", "") for a in areas]
    rows = (util.where(F.col("area_name").isin(list(areas)))
            .select(F.col("period").alias("Date"), txt.strip_spaces("area_name").alias("label"),
                    "percent_utilization"))
    cands = candidate_weeks(F.col(as_of_col), parity)
    arr = F.array(*[F.struct(F.lit(i).alias("_rank"), c.alias("Date")) for i, c in enumerate(cands)])
    hits = spine.select(as_of_col, F.inline(arr)).join(rows, "Date", "inner")
    per_rank = reshape.label_pivot(hits, [as_of_col, "_rank", "Date"], "label",
                                   "percent_utilization", labels)
    best = reshape.first_per_group(per_rank, [as_of_col], ["_rank"])
    return reshape.select_in_order(best, [as_of_col, "Date", *labels])
