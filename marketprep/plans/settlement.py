"""Settlement prices (job A) over whole report histories.

reports (report_date, source_id, file_name, text)
  -> product sections (narrow, per report row; broadcast product rules)
  -> first data line of each section (TOP-1 in file order, blanks skipped)
  -> tokens, padded, first 6 named columns
  -> numbers cleaned (default or parity pattern)
  -> rule pivot: one wide row per report date (or per as-of date).

One lazy plan.  Per report date (``settlement_history``) the only shuffle is
the final group-by on the date, which receives one partially aggregated row
per (task, date).  Per as-of date (``settlement_as_of``) the lookback adds a
join of the (small) report inventory and one of the parsed rows with the
chosen (as-of, source, report date) triples.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as num
from ..functions import text as txt
from ..functions.calendar import lookback_offsets
from ..operators import joins, reshape, sections
from ..rules import (KEPT_COLUMN_COUNT, LOOKBACK_DAYS, PRODUCT_RULES, REPORT_COLUMNS,
                     SECTION_FOOTER, PivotRule, product_pivot_rules, products_by_source)
from ..sources.literal import product_rules
from ..sources.reports import report_inventory

REPORT_KEYS = ("report_date", "source_id", "file_name")
# A row whose number of cells no padding rule covers; and, of a wide row, the
# price columns that come from such rows.
IRREGULAR, IRREGULAR_COLUMNS = "is_irregular", "irregular"
DISPLAY_NAMES = {r[6]: r[3] for r in PRODUCT_RULES}


def section_status(spark: SparkSession, reports: DataFrame,
                   footer: str = SECTION_FOOTER) -> DataFrame:
    """Per (report, product): header/footer line or NULL, and ``found``.

    Replaces the source job's crash on a missing header or footer.
    """
    s = sections.sections_in_text(reports, product_rules(spark), keys=list(REPORT_KEYS),
                                  header_keys=["source_id"], footer=footer, keep_status=True)
    return s.select(*REPORT_KEYS, "position", "data_set", "header_line", "footer_line",
                    F.col("footer_line").isNotNull().alias("found"))


def first_data_rows(status: DataFrame, keys: Sequence[str], parity: bool = False,
                    header_col: str = "data_set") -> DataFrame:
    """TOP-1 + SRC-3 + STR-* on sections kept with ``keep_status=True``: the
    first data line of each section, tokenised, padded, the first six report
    cells named, numbers cleaned.

    Output: ``keys + [Data_Set, Month, Settlement_Price, Last_Price,
    is_irregular]`` plus the six raw kept cells; sections without a data line
    give no row.  ``is_irregular`` marks a token count that no padding rule
    covers, where cells may be misplaced.
    Tokens are whitespace-delimited and kept whole: a comma or quote inside
    a token does not split or shift cells (the source's CSV round trip
    would have).
    """
    kept = list(REPORT_COLUMNS[:KEPT_COLUMN_COUNT])
    # Blank lines are not data rows (the CSV reader skipped them), so the
    # first row is the first non-blank line of the section (NULL when the
    # section is missing or empty).  Rows are dropped by exploding a
    # conditional one-element array rather than by a filter, which the
    # optimizer would push below the projection and evaluate twice.
    with_first = status.withColumn(
        "_first", F.get(F.filter("section_lines", lambda x: txt.has_text(x)), 0))
    # Tokens are their own column: pad_ragged reads them in every branch.
    with_tokens = (with_first.withColumn("_raw_tokens", txt.tokens("_first"))
                   .withColumn("_tokens", txt.pad_ragged("_raw_tokens")))
    cells = with_tokens.select(
        *keys, F.col(header_col).alias("Data_Set"), txt.is_irregular("_raw_tokens").alias("is_irregular"),
        F.inline(F.when(F.col("_first").isNotNull(),
                        F.array(F.struct(*txt.token_columns("_tokens", kept))))))
    return cells.select(
        *keys, "Data_Set",
        F.col("MTH_STRIKE").alias("Month"),
        txt.first_number("SETT", parity).alias("Settlement_Price"),
        txt.first_number("DAILY_LAST", parity).alias("Last_Price"),
        "is_irregular", *kept)


def first_rows(spark: SparkSession, reports: DataFrame, footer: str = SECTION_FOOTER,
               parity: bool = False) -> DataFrame:
    """One cleaned row per (report, product): the section's first data line.

    Output: ``report_date, source_id, file_name, position, Data_Set, Month,
    Settlement_Price, Last_Price, is_irregular`` plus the six raw kept cells.
    """
    s = sections.sections_in_text(reports, product_rules(spark), keys=list(REPORT_KEYS),
                                  header_keys=["source_id"], footer=footer, keep_status=True)
    return first_data_rows(s, [*REPORT_KEYS, "position"], parity)


def first_rows_from_lines(spark: SparkSession, lines: DataFrame, footer: str = SECTION_FOOTER,
                          parity: bool = False) -> DataFrame:
    """:func:`first_rows` for reports landed as a line table
    ``(report_date, source_id, file_name, line_no, line)`` - reports too large
    to be one row.

    Sections come from the keyed line-table scan; the first non-blank line
    of each section is a ``min_by`` over ``line_no`` (partial aggregation, so
    a huge report does not land in one task); the cells and numbers are
    then derived exactly as in the whole-text path.
    """
    keys = list(REPORT_KEYS)
    sec = sections.sections_in_lines(lines, product_rules(spark), keys=keys,
                                     header_keys=["source_id"], footer=footer)
    firsts = reshape.first_per_group(sec.where(txt.has_text("line")),
                                     keys + ["position", "data_set"], ["line_no"], cols=["line"])
    status = firsts.withColumn("section_lines", F.array("line"))
    return first_data_rows(status, [*REPORT_KEYS, "position"], parity)


def settlement_history_from_lines(spark: SparkSession, lines: DataFrame,
                                  parity: bool = False) -> DataFrame:
    """One wide row per report date from a line table."""
    return settlement_wide(first_rows_from_lines(spark, lines, parity=parity))


def priced(rows: DataFrame, rules: Sequence[PivotRule]) -> DataFrame:
    """Pick the settlement or last price per rule and apply its transform."""
    value = None
    for r in rules:
        base = F.col("Settlement_Price") if r.price == "settlement" else F.col("Last_Price")
        expr = num.reciprocal_or_self(base) if r.transform == "reciprocal" else base
        cond = F.col("Data_Set") == r.key
        value = F.when(cond, expr) if value is None else value.when(cond, expr)
    return rows.withColumn("price_value", value)


def settlement_wide(rows: DataFrame, keys: Sequence[str] = ("report_date",),
                    order_col: Column | str | None = None,
                    rules: Sequence[PivotRule] | None = None) -> DataFrame:
    """AGG-1: cleaned rows (``Data_Set, Settlement_Price, Last_Price``) -> one
    wide row per key, sink column names; ``keys=[]`` gives one global row.

    Several rows for the same key and product: the highest ``order_col``
    wins (default: the latest report date, then the last file name).  Where rows
    say whether their cells may be misplaced (``is_irregular``), the last column
    ``irregular`` names the price columns that come from such rows.
    """
    rules = list(rules) if rules is not None else product_pivot_rules()
    order = order_col if order_col is not None else F.struct("report_date", "file_name")
    cells = priced(rows, rules)
    if IRREGULAR not in rows.columns:
        return reshape.rule_pivot(cells, list(keys), rules, name_col="Data_Set", value_col="price_value", order_col=order)
    wide = reshape.rule_pivot(cells.withColumn("_cell", F.struct("price_value", IRREGULAR)), list(keys), rules,
                              name_col="Data_Set", value_col="_cell", order_col=order)
    marks = F.concat_ws(",", *[F.when(F.col(r.column)[IRREGULAR], F.lit(r.column)) for r in rules])
    return wide.select(*keys, *[F.col(r.column)["price_value"].alias(r.column) for r in rules],
                       F.nullif(marks, F.lit("")).alias(IRREGULAR_COLUMNS))


def settlement_history(spark: SparkSession, reports: DataFrame, parity: bool = False) -> DataFrame:
    """One wide row per report date."""
    return settlement_wide(first_rows(spark, reports, parity=parity))


def window_dates(first_as_of: str, last_as_of: str, days: int = LOOKBACK_DAYS,
                 mode: str = "corrected") -> list[str]:
    """The report dates a lookback over ``[first_as_of, last_as_of]`` can pick.

    The source's trial order reaches further back (its weekend shift adds up
    to 4 days), so that mode gets a wider window."""
    reach = days - 1 + (4 if mode == "reference" else 0)
    lo = date.fromisoformat(first_as_of) - timedelta(days=reach)
    hi = date.fromisoformat(last_as_of)
    return [(lo + timedelta(days=k)).isoformat() for k in range((hi - lo).days + 1)]


def report_window(reports: DataFrame, first_as_of: str, last_as_of: str,
                  days: int = LOOKBACK_DAYS, mode: str = "corrected") -> DataFrame:
    """Only the reports of :func:`window_dates`, from a table of reports: a
    filter on the partition column, which prunes what is read (the listing of
    the folders is whole; give ``read_reports`` the dates to limit that too)."""
    dates = window_dates(first_as_of, last_as_of, days, mode)
    return reports.where(F.col("report_date").between(F.to_date(F.lit(dates[0])), F.to_date(F.lit(dates[-1]))))


def settlement_as_of(spark: SparkSession, reports: DataFrame, spine: DataFrame,
                     as_of_col: str = "as_of", mode: str = "corrected",
                     parity: bool = False, inventory: DataFrame | None = None) -> DataFrame:
    """One wide row per as-of date, each report kind taken from its latest
    available date within the 7-day lookback (SRC-6).

    Each (as-of, source) picks its report date from the inventory of landed
    reports, then the parsed rows of exactly those reports are pivoted.
    ``inventory`` (``sources.reports.read_inventory``) comes from the file
    listing; without it the reports are read once more to find their dates.
    """
    inv = inventory if inventory is not None else report_inventory(reports)
    return _as_of(first_rows(spark, reports, parity=parity), inv, spine, as_of_col, mode)


def _as_of(rows: DataFrame, inv: DataFrame, spine: DataFrame, as_of_col: str, mode: str) -> DataFrame:
    sources = list(products_by_source())
    grid = spine.select(as_of_col, F.explode(F.array(*[F.lit(s) for s in sources])).alias("source_id"))
    picks = joins.asof_lookback(grid, as_of_col, inv, "report_date", keys=["source_id"],
                                modes=(mode,))
    # The comparison tells the planner that few dates are picked, so that it
    # prunes the partitions of a table of rows by them.
    chosen = picks.where(F.col(f"{mode}_offset") >= 0).select(
        as_of_col, "source_id", F.col(f"{mode}_found_date").alias("report_date"))
    wide = settlement_wide(rows.join(chosen, ["source_id", "report_date"]), keys=[as_of_col])
    return spine.select(as_of_col).join(wide, as_of_col, "left")


def settlement_as_of_rows(rows: DataFrame, spine: DataFrame, as_of_col: str = "as_of",
                          mode: str = "corrected") -> DataFrame:
    """:func:`settlement_as_of` over already parsed first rows (a table that is
    appended to as reports land, partitioned by ``report_date``).

    Both reads of the table, of the dates it has and of the picked rows, are
    joined on its partition column with what the spine asks for, so only the
    partitions within the lookback are read."""
    asked = (spine.select(as_of_col, F.explode(lookback_offsets(F.col(as_of_col), mode)).alias("_o"))
             .where(F.col("_o") >= 0).select(F.date_sub(as_of_col, F.col("_o")).alias("report_date")).distinct())
    inv = rows.select("source_id", "report_date").join(asked, "report_date", "left_semi").distinct()
    return _as_of(rows, inv, spine, as_of_col, mode)


def to_display(wide: DataFrame, date_col: str = "report_date") -> DataFrame:
    """Sink names -> display names (``Date``, ``WTI Crude Oil``, ...)."""
    return reshape.rename(wide, {date_col: "Date", **DISPLAY_NAMES})
