"""Landed text reports (SRC-1 input side).

Landing layout: ``<root>/report_date=YYYY-MM-DD/source_id=<id>/<file>.txt``.
Each file is read whole (``wholetext``), so a report is one row and line order
is the array order; ``report_date`` (DATE) and ``source_id`` come from the
folders.  Given the dates a run can need, only their folders are listed and
read: the root is listed once, nothing below the other dates is.

A report too large to be one row is read as lines instead (``read_lines``,
``read_report_lines``): its file is split like any text file, and each line gets
its number in the whole file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written

REPORT_SCHEMA = "report_date date, source_id string, file_name string, text string"


def _load(spark: SparkSession, fmt: str, root: str, dates: Sequence[str] | None, **options) -> DataFrame | None:
    """The landing in a format, limited to some dates; None if none landed."""
    base = root.rstrip("/")
    path = base if dates is None else f"{base}/report_date={{{','.join(dates)}}}"
    try:
        return spark.read.format(fmt).options(basePath=base, recursiveFileLookup=False, **options).load(path)
    except AnalysisException as e:
        if dates is not None and e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_reports(spark: SparkSession, root: str, dates: Sequence[str] | None = None) -> DataFrame:
    """``(report_date, source_id, file_name, text)``, one row per report file
    (of the given dates only)."""
    df = _load(spark, "text", root, dates, wholetext=True)
    if df is None:
        return spark.createDataFrame([], REPORT_SCHEMA)
    if not {"report_date", "source_id"} <= set(df.columns):
        raise ValueError(f"no landed reports under {root}: expected "
                         "report_date=YYYY-MM-DD/source_id=<id>/ folders")
    return df.select(
        F.col("report_date").cast("date").alias("report_date"),
        F.col("source_id").cast("string").alias("source_id"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("value").alias("text"))


def _numbered(raw: DataFrame) -> DataFrame:
    """``(file_path, <columns>, line_no, line)`` of a text source read line by
    line, numbered from 0 in each file.

    The lines are written once with the split they come from and their order in
    it (``monotonically_increasing_id`` rises within a task), so both are fixed
    whatever is repeated later.  The splits of a file are then counted, one row
    each, and a running sum of these counts is the number of a split's first
    line; the table of splits is joined as the planner's measured size says.
    """
    other = [c for c in raw.columns if c != "value"]
    lines = written(raw.select(
        *other, F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("line")), "report-lines")
    splits = lines.groupBy("file_path", "_split").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file_path", "_split", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return lines.join(splits, ["file_path", "_split"]).select(
        *other, "file_path", "file_name", (F.col("_before") + F.col("_at") - F.col("_first")).alias("line_no"), "line")


def read_lines(spark: SparkSession, root: str, split_bytes: int | None = None,
               dates: Sequence[str] | None = None) -> DataFrame:
    """``(<folder columns>, file_path, file_name, line_no, line)`` of text files
    of any size, read in splits (of at most ``split_bytes``, else as the session
    says).  A line ends at CRLF, CR or LF; unlike in the array of a whole text
    there is no empty line after the last line break."""
    df = _load(spark, "text", root, dates)
    if df is None:
        df = spark.createDataFrame([], REPORT_SCHEMA + ", file_path string, line_no long, line string").drop("text")
        return df.select("report_date", "source_id", "file_path", "file_name", "line_no", "line")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if split_bytes:
        spark.conf.set(key, str(split_bytes))
    try:
        return _numbered(df)                     # the files are read here
    finally:
        spark.conf.set(key, before)


def read_report_lines(spark: SparkSession, root: str, dates: Sequence[str] | None = None,
                      split_bytes: int | None = None) -> DataFrame:
    """``(report_date, source_id, file_name, line_no, line)``: the landed reports
    as a line table for ``settlement_history_from_lines``."""
    df = read_lines(spark, root, split_bytes, dates)
    if not {"report_date", "source_id"} <= set(df.columns):
        raise ValueError(f"no landed reports under {root}: expected "
                         "report_date=YYYY-MM-DD/source_id=<id>/ folders")
    return df.select(F.col("report_date").cast("date").alias("report_date"), F.col("source_id").cast("string").alias("source_id"),
                     "file_name", "line_no", "line")


def read_inventory(spark: SparkSession, root: str, dates: Sequence[str] | None = None) -> DataFrame:
    """Distinct ``(source_id, report_date)`` landed, from the file listing: the
    binary-file source opens no file whose content is not selected."""
    df = _load(spark, "binaryFile", root, dates)
    if df is None or not {"report_date", "source_id"} <= set(df.columns):
        return spark.createDataFrame([], REPORT_SCHEMA).select("source_id", "report_date")
    return df.select(F.col("source_id").cast("string").alias("source_id"),
                     F.col("report_date").cast("date").alias("report_date")).distinct()


def report_inventory(reports: DataFrame) -> DataFrame:
    """The same from an already read table of reports (reads it)."""
    return reports.select("source_id", "report_date").distinct()
