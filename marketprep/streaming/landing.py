"""Incremental ingestion of the landing folders with Structured Streaming.

New report files and JSON record sets are picked up as they land and turned
into long, per-report rows appended to a table in a shared folder.  Every
step of that parse is stateless (broadcast rule join, per-row fold,
generators), so the file source + file sink pair is exactly-once through the
checkpoint, which by default lies inside the output: a lost executor or a
restarted job resumes from the last committed batch.  The wide outputs (one row per date) are then cheap batch
queries over the appended tables: a report date whose three sources land in
different batches still pivots correctly.

Use ``trigger="available_now"`` for a scheduled daily run (process what is
there, then stop) or a processing-time interval for a long-running stream.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import settlement
from ..plans.utilization import asked_years, in_reach, latest_week_wide, raw_in_reach, series_utilization
from ..rules import UTILIZATION_AREAS
from ..sources.envelope import (CORRUPT, SERIES_RECORD, envelope_schema, latest_records, typed_series,
                                unwrap_pulls)


def _trigger(writer, trigger: str):
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def _checkpoint(output: str, location: str | None) -> str:
    """The stream's state belongs to its output: by default it lies inside it
    (readers skip names that begin with ``_``), so a restart resumes and a
    second output over the same landing starts from the beginning."""
    return location or os.path.join(output, "_checkpoint")


def report_stream(spark: SparkSession, landing_root: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(report_date, source_id, file_name, text)`` from the
    ``report_date=/source_id=`` landing layout, one row per new file."""
    r = (spark.readStream.format("text").option("wholetext", True)
         .schema("value string").option("recursiveFileLookup", False))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.load(landing_root)
    path = F.col("_metadata.file_path")
    return raw.select(
        F.to_date(F.regexp_extract(path, r".*/report_date=([0-9-]+)/", 1)).alias("report_date"),
        F.regexp_extract(path, r".*/source_id=([^/]+)/", 1).alias("source_id"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("value").alias("text"))


def ingest_reports(spark: SparkSession, landing_root: str, rows_path: str,
                   checkpoint_location: str | None = None, trigger: str = "available_now",
                   parity: bool = False,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append the cleaned first row of every product section of every newly
    landed report to ``rows_path`` (parquet, partitioned by report date).

    ``max_files_per_trigger`` bounds a micro-batch, so a large backlog is
    worked off in steps (``available_now`` still stops when it is done)."""
    rows = settlement.first_rows(spark, report_stream(spark, landing_root, max_files_per_trigger),
                                 parity=parity)
    w = (rows.writeStream.format("parquet").outputMode("append")
         .option("path", rows_path)
         .option("checkpointLocation", _checkpoint(rows_path, checkpoint_location))
         .partitionBy("report_date"))
    return _trigger(w, trigger).start()


def settlement_from_rows(spark: SparkSession, rows_path: str) -> DataFrame:
    """Batch: one wide settlement row per report date from the appended rows."""
    return settlement.settlement_wide(spark.read.parquet(rows_path))


def settlement_as_of_from_rows(spark: SparkSession, rows_path: str, spine: DataFrame,
                               mode: str = "corrected") -> DataFrame:
    """Batch: one wide settlement row per as-of date from the appended rows, each
    report kind from its latest date within the lookback (SRC-6); only the
    partitions of dates that the lookback can reach are read."""
    return settlement.settlement_as_of_rows(spark.read.parquet(rows_path), spine, mode=mode)


def _series_stream(spark: SparkSession, landing_root: str, max_files_per_trigger: int | None) -> DataFrame:
    """Records of newly landed envelopes (``series_code=<code>/[pull_date=<date>/]*.json``)."""
    schema = envelope_schema(SERIES_RECORD).add(CORRUPT, "string")
    r = spark.readStream.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.json(landing_root)
    path = F.col("_metadata.file_path")
    whole = F.struct(F.when(F.col(CORRUPT).isNull(), F.col("response.data")).alias("data")).alias("response")
    return unwrap_pulls(raw.select(
        F.regexp_extract(path, r".*/series_code=([^/]+)/", 1).alias("series_code"),
        F.regexp_extract(path, r".*/pull_date=([0-9-]+)/", 1).try_cast("date").alias("pull_date"),
        F.col("_metadata.file_name").alias("file_name"), whole))


def ingest_series(spark: SparkSession, landing_root: str, records_path: str,
                  checkpoint_location: str | None = None,
                  trigger: str = "available_now",
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append the records of every newly landed JSON envelope
    (``series_code=<code>/[pull_date=<date>/]*.json``) to ``records_path``."""
    recs = _series_stream(spark, landing_root, max_files_per_trigger)
    w = (recs.writeStream.format("parquet").outputMode("append")
         .option("path", records_path)
         .option("checkpointLocation", _checkpoint(records_path, checkpoint_location))
         .partitionBy("series_code"))
    return _trigger(w, trigger).start()


# Partition columns of the latest-record table.
LATEST_PARTITIONS = ("series_code", "year")


def merge_latest(batch: DataFrame, batch_id: int, table_path: str) -> None:
    """AGG-4 as a merge: bring the records of a batch into the table of latest
    records, rewriting only the (series, year) partitions that it touches.

    The touched partitions, merged, are first written under the batch's id; the
    table's partitions are then replaced by them (dynamic partition overwrite).
    A repeated batch takes what it wrote the first time, so a crash between the
    two steps, or within the second one, loses and changes nothing.  Only one
    stream may write to a table.
    """
    spark = batch.sparkSession
    root = table_path.rstrip("/")
    staged = f"{root}/_merge/batch={batch_id}"
    done = _table(spark, staged) if _exists(spark, f"{staged}/_SUCCESS") else None
    if done is None:
        new = batch.withColumn("year", F.coalesce(F.substring("period", 1, 4), F.lit("none")))
        old = _table(spark, root)
        if old is not None:
            touched = new.select(*LATEST_PARTITIONS).distinct()
            new = old.join(touched, list(LATEST_PARTITIONS), "left_semi").select(*new.columns).unionByName(new)
        merged = latest_records(new)
        merged.repartition(*LATEST_PARTITIONS, "period").write.mode("overwrite").parquet(staged)
        done = _table(spark, staged)
    if done is None:                                             # a batch without records
        return
    (done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*LATEST_PARTITIONS).parquet(root))


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where there is none yet."""
    try:
        # partition values stay the text they are written as
        return spark.read.schema(LATEST_SCHEMA).parquet(path) if _exists(spark, path) else None
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


LATEST_SCHEMA = ("series_code string, period string, duoarea string, area_name string, series_description string, "
                 "value string, units string, product_name string, pull_date date, file_name string, record_no int, year string")


def ingest_latest(spark: SparkSession, landing_root: str, table_path: str,
                  checkpoint_location: str | None = None, trigger: str = "available_now",
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Keep a table of the latest pull of each record up to date with the landed
    envelopes, batch by batch (:func:`merge_latest`), so that a run reads one row
    per record instead of every pull ever made."""
    recs = _series_stream(spark, landing_root, max_files_per_trigger)
    w = (recs.writeStream.foreachBatch(lambda df, i: merge_latest(df, i, table_path))
         .option("checkpointLocation", _checkpoint(table_path, checkpoint_location)))
    return _trigger(w, trigger).start()


def utilization_from_latest(spark: SparkSession, table_path: str, spine: DataFrame,
                            parity: bool = False, strict: bool = True) -> DataFrame:
    """Batch: the wide utilization rows from the table of latest records; only
    its partitions of years that the as-of dates can report are read."""
    table = spark.read.schema(LATEST_SCHEMA).parquet(table_path)
    years = asked_years(spine, parity)
    records = raw_in_reach(table.join(years, "year", "left_semi").select(*table.columns), spine, parity)
    util = series_utilization(in_reach(typed_series(records, strict=strict), spine, parity),
                              areas=UTILIZATION_AREAS)
    return latest_week_wide(util, spine, parity=parity)


def utilization_from_records(spark: SparkSession, records_path: str, spine: DataFrame,
                             parity: bool = False, strict: bool = True) -> DataFrame:
    """Batch: the wide utilization rows from the appended records, the latest
    pull of each record counting."""
    records = latest_records(raw_in_reach(spark.read.parquet(records_path), spine, parity))
    util = series_utilization(in_reach(typed_series(records, strict=strict), spine, parity),
                              areas=UTILIZATION_AREAS)
    return latest_week_wide(util, spine, parity=parity)


__all__ = ["ingest_latest", "ingest_reports", "ingest_series", "merge_latest", "report_stream",
           "settlement_as_of_from_rows", "settlement_from_rows", "utilization_from_latest", "utilization_from_records"]
