"""Runnable jobs: what a scheduled run does end to end.

* ``settlement``  - landed text reports -> one wide settlement row per as-of date
* ``utilization`` - landed JSON record sets -> one wide utilization row per as-of date
* ``literal``     - a literal table of settlement rows -> one wide row (no date)

Each returns the result DataFrame and, given a JDBC URL and table, writes
it with declared column types (overwrite by default, or append).  Without a
sink the CLI prints the rows.

    python -m marketprep.jobs settlement --landing /data/reports --as-of 2024-11-21
    python -m marketprep.jobs utilization --landing /data/series --start 2024-11-01 --end 2024-12-06
    python -m marketprep.jobs ingest-reports --landing /data/reports --output /data/report_rows
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime
from zoneinfo import ZoneInfo
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.calendar import as_of_date
from .plans import settlement
from .functions.numeric import no_nan
from .plans.utilization import in_reach, latest_week_wide, raw_in_reach, series_utilization
from .rules import (SETTLEMENT_SINK_TYPES, UTILIZATION_AREAS, UTILIZATION_COLUMNS,
                    UTILIZATION_SINK_TYPES)
from .sources.envelope import audit_files, latest_records, read_envelopes, split_quarantine, typed_series
from .sources.facets import facet_top_n
from .sources.jdbc import write_jdbc
from .sources.literal import SETTLEMENT_ROW_SCHEMA, literal_table
from .sources.reports import read_inventory, read_reports
from .session import literal_rows


def as_of_spine(spark: SparkSession, dates: Sequence[str] | None = None,
                start: str | None = None, end: str | None = None) -> DataFrame:
    """As-of dates: an explicit list, an inclusive range, or today."""
    if start and end:
        return spark.range(1).select(
            F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("as_of"))
    if dates:
        return literal_rows(spark, [(d,) for d in dates], "as_of string") \
            .select(F.to_date("as_of").alias("as_of"))
    return spark.range(1).select(as_of_date().alias("as_of"))


def _sink(df: DataFrame, column_types: str, jdbc_url: str | None, table: str | None,
          mode: str, options: Mapping[str, str] | None) -> None:
    """Write a job's wide output (one row per date: small by construction)
    from one task, i.e. in one database transaction: a task retried after a
    lost executor rolls back instead of leaving half a batch.  The rows are
    computed in parallel and then moved to that task."""
    if jdbc_url and table:
        write_jdbc(df.repartition(1), jdbc_url, table, mode=mode, column_types=column_types,
                   options=options, num_partitions=1)


def settlement_job(spark: SparkSession, landing_root: str, spine: DataFrame,
                   mode: str = "corrected", parity: bool = False,
                   jdbc_url: str | None = None, table: str | None = None,
                   write_mode: str = "overwrite",
                   options: Mapping[str, str] | None = None,
                   as_of_range: tuple[str, str] | None = None) -> DataFrame:
    """``Date`` (the as-of date), the seven sink price columns and ``irregular``
    (names of those whose report row has an unusual number of cells, where a
    price may come from a misplaced one; not written to the sink), one row per
    as-of date; each report kind from its latest report within 7 days.

    ``as_of_range`` (first, last) limits the run to the folders of the report
    dates the lookback can reach; each of their files is read once."""
    dates = settlement.window_dates(*as_of_range, mode=mode) if as_of_range else None
    wide = settlement.settlement_as_of(spark, read_reports(spark, landing_root, dates), spine, mode=mode,
                                       parity=parity, inventory=read_inventory(spark, landing_root, dates))
    out = wide.withColumnRenamed("as_of", "Date")
    _sink(out.drop(settlement.IRREGULAR_COLUMNS), "Date DATE, " + SETTLEMENT_SINK_TYPES, jdbc_url, table, write_mode, options)
    return out


def utilization_job(spark: SparkSession, landing_root: str, spine: DataFrame,
                    parity: bool = False, strict: bool = True,
                    jdbc_url: str | None = None, table: str | None = None,
                    write_mode: str = "overwrite",
                    options: Mapping[str, str] | None = None,
                    newest_rows: int | None = None, quarantine: str | None = None) -> DataFrame:
    """``Date, U.S., PADD3``: the reported week of each as-of date (several
    as-of dates reporting the same week give one row).

    Of each record the latest pull counts.  ``newest_rows`` then keeps only the
    newest N records of each series, as the source's faceted request did (it
    asked for 12); by default the whole history is used, but only records of
    weeks that the as-of dates can report are compared and typed.

    With ``quarantine`` (a folder) records with bad text are written there and
    left out, and so are landed files that can't be read (their list goes to the
    folder's ``_files``); else ``strict`` raises on either, and without it bad
    text counts as NULL and such files as missing."""
    raw = read_envelopes(spark, landing_root, strict=strict and not quarantine)
    if not newest_rows:
        raw = raw_in_reach(raw, spine, parity)
    raw = latest_records(raw)
    if quarantine:
        records, _ = split_quarantine(raw, quarantine)
        audit_files(spark, landing_root).where("status <> 'ok'").write.mode("overwrite").json(f"{quarantine.rstrip('/')}/_files")
    else:
        records = typed_series(raw, strict=strict)
    if newest_rows:
        records = facet_top_n(records, None, ["series_code"],
                              [F.col("period").desc(), F.col("duoarea"), F.col("area_name")],
                              n=newest_rows).drop("rn")
    util = series_utilization(in_reach(records, spine, parity), areas=UTILIZATION_AREAS)
    wide = latest_week_wide(util, spine, parity=parity)
    out = wide.select(*[F.col(f"`{c}`") for c in UTILIZATION_COLUMNS]).dropDuplicates(["Date"])
    _sink(out, UTILIZATION_SINK_TYPES, jdbc_url, table, write_mode, options)
    return out


def literal_settlement_job(spark: SparkSession, rows: Sequence[tuple] | DataFrame,
                           jdbc_url: str | None = None, table: str | None = None,
                           write_mode: str = "overwrite",
                           options: Mapping[str, str] | None = None) -> DataFrame:
    """Literal ``(Data_Set, Month, Settlement_Price, Last_Price)`` rows (or a
    table of them) -> one wide row with the sink column names (no date)."""
    lit = rows if isinstance(rows, DataFrame) else literal_table(spark, rows, SETTLEMENT_ROW_SCHEMA)
    lit = (lit.withColumn("Settlement_Price", no_nan("Settlement_Price"))
           .withColumn("Last_Price", no_nan("Last_Price")).withColumn("_order", F.lit(0)))
    out = settlement.settlement_wide(lit, keys=[], order_col="_order")
    _sink(out, SETTLEMENT_SINK_TYPES, jdbc_url, table, write_mode, options)
    return out


def main(argv: Sequence[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="marketprep.jobs")
    ap.add_argument("job", choices=["settlement", "utilization", "literal", "ingest-reports", "ingest-series"])
    ap.add_argument("--output", help="ingest-*: folder of the appended long table")
    ap.add_argument("--checkpoint", help="ingest-*: stream checkpoint (default: inside the output)")
    ap.add_argument("--landing", required=True,
                    help="landing root folder; literal: a CSV file with a header line")
    ap.add_argument("--as-of", action="append", dest="as_of", help="as-of date (repeatable)")
    ap.add_argument("--start", help="first as-of date of a range")
    ap.add_argument("--end", help="last as-of date of a range")
    ap.add_argument("--parity", action="store_true", help="reproduce the source jobs' quirks")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--table")
    ap.add_argument("--append", action="store_true")
    ap.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE",
                    help="option of the database connection (repeatable)")
    ap.add_argument("--quarantine", help="utilization: folder for records with bad text")
    ap.add_argument("--display-names", action="store_true")
    ap.add_argument("--facet-rows", type=int, default=None,
                    help="utilization: newest N records per series only (the source used 12)")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    if bool(a.start) != bool(a.end):
        ap.error("--start and --end go together")
    if any("=" not in o for o in a.jdbc_option):
        ap.error("--jdbc-option takes KEY=VALUE")
    options = dict(o.split("=", 1) for o in a.jdbc_option)

    from .session import get_session
    spark = get_session(a.master)
    if a.job.startswith("ingest-"):
        if not a.output:
            ap.error("--output is required for ingest jobs")
        from .streaming import landing
        if a.job == "ingest-reports":
            q = landing.ingest_reports(spark, a.landing, a.output, a.checkpoint, parity=a.parity)
        else:
            q = landing.ingest_series(spark, a.landing, a.output, a.checkpoint)
        q.awaitTermination()
        return 0
    mode = "append" if a.append else "overwrite"
    if a.job == "literal":
        rows = spark.read.schema(SETTLEMENT_ROW_SCHEMA).csv(a.landing, header=True)
        out = literal_settlement_job(spark, rows, a.jdbc_url, a.table, mode, options)
        if a.display_names:
            out = out.withColumnsRenamed(settlement.DISPLAY_NAMES)
        if not (a.jdbc_url and a.table):
            out.show(truncate=False)
        return 0
    if not (a.as_of or a.start):
        # Today in the session's time zone, so the spine and the report
        # window agree with current_date().
        tz = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
        a.as_of = [datetime.now(tz).date().isoformat()]
    spine = as_of_spine(spark, a.as_of, a.start, a.end)
    window = (a.start, a.end) if a.start else (min(a.as_of), max(a.as_of))
    if a.job == "settlement":
        out = settlement_job(spark, a.landing, spine,
                             mode="reference" if a.parity else "corrected", parity=a.parity,
                             jdbc_url=a.jdbc_url, table=a.table, write_mode=mode,
                             options=options, as_of_range=window)
        if a.display_names:
            out = settlement.to_display(out, "Date")
    else:
        out = utilization_job(spark, a.landing, spine, parity=a.parity,
                              jdbc_url=a.jdbc_url, table=a.table, write_mode=mode,
                              options=options, newest_rows=a.facet_rows, quarantine=a.quarantine)
    if not (a.jdbc_url and a.table):
        out.orderBy(out.columns[0]).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
