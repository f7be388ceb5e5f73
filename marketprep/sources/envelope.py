"""JSON record-set envelopes (SRC-2): ``{"response": {"data": [ {...}, ... ]}}``.

Records are parsed with an explicit schema (no inference pass over the data)
and unwrapped with ``inline``, a narrow generator: no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import to_double_or_null, to_double_strict
from ..operators.reshape import last_per_group
from ..session import shared_path

# Record fields the utilization job requires.  ``value`` is text in the feed.
SERIES_RECORD = T.StructType([
    T.StructField("period", T.StringType()),
    T.StructField("duoarea", T.StringType()),
    T.StructField("area-name", T.StringType()),
    T.StructField("series-description", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("units", T.StringType()),
    T.StructField("product-name", T.StringType()),
])

# Dashed feed names -> snake_case used inside the plans.
SNAKE = {"area-name": "area_name", "series-description": "series_description",
         "product-name": "product_name"}


def envelope_schema(record: T.StructType = SERIES_RECORD) -> T.StructType:
    return T.StructType([T.StructField("response", T.StructType([
        T.StructField("data", T.ArrayType(record))]))])


# Where the parser puts the text of an envelope that it can't read.
CORRUPT = "_corrupt_record"


def parse_envelopes(df: DataFrame, text_col: str, record: T.StructType = SERIES_RECORD,
                    keep: Sequence[str] = ()) -> DataFrame:
    """``keep + [response, _corrupt_record, status]`` of an envelope text column;
    see :func:`envelope_status`."""
    schema = envelope_schema(record).add(CORRUPT, T.StringType())
    parsed = F.from_json(F.col(text_col), schema, {"columnNameOfCorruptRecord": CORRUPT})
    out = df.select(*keep, F.col(text_col).alias("_text"), parsed.alias("_env"))
    return out.select(*keep, "_env.response", F.col(f"_env.{CORRUPT}").alias(CORRUPT),
                      envelope_status(F.coalesce(F.trim("_text"), F.lit("")) == "", F.col(f"_env.{CORRUPT}"),
                                      F.col("_env.response.data")).alias("status"))


def envelope_status(empty: Column, corrupt: Column, data: Column) -> Column:
    """``empty`` (nothing was landed), ``unreadable`` (cut off or no JSON: none of
    its records count, not even those before the cut), ``no_data`` (JSON without
    ``response.data``) or ``ok``."""
    return (F.when(empty, "empty").when(corrupt.isNotNull(), "unreadable")
            .when(data.isNull(), "no_data").otherwise("ok"))


def unwrap_envelope(df: DataFrame, text_col: str, record: T.StructType = SERIES_RECORD,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse an envelope text column and return one row per record.

    A text that is not an envelope (a failed or cut-off download) contributes no
    rows; :func:`audit_envelopes` names it.
    """
    parsed = parse_envelopes(df, text_col, record, keep)
    whole = F.when(F.col(CORRUPT).isNull(), F.col("response.data"))
    return parsed.select(*keep, F.inline(whole)).withColumnsRenamed(SNAKE)


def audit_envelopes(df: DataFrame, text_col: str, record: T.StructType = SERIES_RECORD,
                    keep: Sequence[str] = ()) -> DataFrame:
    """``keep + [status, n_records]`` per envelope text."""
    parsed = parse_envelopes(df, text_col, record, keep)
    return parsed.select(*keep, "status", _records(F.col("status"), F.col("response.data")).alias("n_records"))


def _records(status: Column, data: Column) -> Column:
    return F.when(status == "ok", F.size(data)).otherwise(0).cast("bigint")


def unwrap_pulls(raw: DataFrame) -> DataFrame:
    """One row per record of parsed envelopes, with where it came from:
    ``series_code, <record>, pull_date, file_name, record_no``."""
    return (raw.select("series_code", "pull_date", "file_name",
                       F.posexplode("response.data").alias("record_no", "_r"))
            .select("series_code", "_r.*", "pull_date", "file_name", "record_no")
            .withColumnsRenamed(SNAKE))


def _landed(spark: SparkSession, root: str, record: T.StructType) -> DataFrame:
    schema = (envelope_schema(record).add(CORRUPT, T.StringType()).add("series_code", T.StringType())
              .add("pull_date", T.DateType()))
    raw = (spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT).json(root))
    return raw.select("series_code", "pull_date", "response", CORRUPT, F.col("_metadata.file_name").alias("file_name"),
                      F.col("_metadata.file_path").alias("file_path"))


def _path_key(path: Column) -> Column:
    """A file's path however it is written (``file:/x``, ``file:///x``, escaped)."""
    one = F.regexp_replace(path, "^([a-zA-Z0-9]+):/+", "$1:/")
    return F.coalesce(F.try_url_decode(one), one)


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """The landed files by the listing, which the driver has anyway; unlike a
    scan, which skips them, it has files without content too."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(root).inputFiles()
    path = F.col("file_path")
    listed = spark.createDataFrame([(f,) for f in files], "file_path string")
    return listed.select(
        F.nullif(F.regexp_extract(path, r"/series_code=([^/]+)/", 1), F.lit("")).alias("series_code"),
        F.regexp_extract(path, r"/pull_date=([0-9-]+)/", 1).try_cast("date").alias("pull_date"),
        path, F.regexp_extract(path, "[^/]*$", 0).alias("file_name"), _path_key(path).alias("_key"))


def read_envelopes(spark: SparkSession, root: str,
                   record: T.StructType = SERIES_RECORD, strict: bool = False) -> DataFrame:
    """Landed envelopes under ``<root>/series_code=<code>/*.json`` or
    ``<root>/series_code=<code>/pull_date=<date>/*.json``.

    Each file is one multi-line JSON document, the answer to one pull;
    ``series_code`` and ``pull_date`` come from the directories (a landing
    without the latter has NULL there).  A file that is no whole JSON document
    contributes no rows, not even those before the cut (:func:`audit_files`
    names it); with ``strict`` it is an error that names the file, as is a file
    without content.
    """
    raw = _landed(spark, root, record)
    if strict:
        some = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(root)
        seen = some.select(_path_key(F.col("_metadata.file_path")).alias("_key"))           # reads no content
        none = _listed(spark, root).join(seen, "_key", "left_anti").select("file_path").take(1)
        if none:
            raise ValueError(f"empty envelope file: {none[0].file_path}")
        data = F.when(F.col(CORRUPT).isNotNull(), F.raise_error(F.concat(F.lit("unreadable envelope file: "), "file_path"))
                      .cast(T.ArrayType(record))).otherwise(F.col("response.data"))
    else:
        data = F.when(F.col(CORRUPT).isNull(), F.col("response.data"))
    return unwrap_pulls(raw.select("series_code", "pull_date", "file_name", F.struct(data.alias("data")).alias("response")))


def audit_files(spark: SparkSession, root: str, record: T.StructType = SERIES_RECORD) -> DataFrame:
    """``(series_code, pull_date, file_path, file_name, status, n_records)`` per
    landed file.  The files come from the listing, so one without content, of
    which the parser makes no row, is there too."""
    raw = _landed(spark, root, record)
    status = envelope_status(F.lit(False), F.col(CORRUPT), F.col("response.data"))
    seen = raw.select(_path_key(F.col("file_path")).alias("_key"), status.alias("_status"),
                      _records(status, F.col("response.data")).alias("_n")) \
        .groupBy("_key").agg(F.max("_status").alias("_status"), F.sum("_n").alias("_n"))
    return _listed(spark, root).join(seen, "_key", "left").select(
        "series_code", "pull_date", "file_path", "file_name", F.coalesce("_status", F.lit("empty")).alias("status"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_records"))


# What identifies a record of a series, and which pull of it counts.
RECORD_KEYS = ("series_code", "period", "duoarea", "area_name")
PULL_ORDER = ("pull_date", "file_name", "record_no")


def latest_records(records: DataFrame, keys: Sequence[str] = RECORD_KEYS,
                   order: Sequence[str] = PULL_ORDER) -> DataFrame:
    """AGG-4: of each record the latest pull (then the last file name, then the
    last place in the file).  Pulls overlap by design (each asks for the newest
    rows), so this comes before any top-n or join."""
    return last_per_group(records, list(keys), list(order)).select(*records.columns)


def typed_series(records: DataFrame, strict: bool = True) -> DataFrame:
    """Period as DATE and value as DOUBLE (CAST-2): ``strict`` raises on bad
    text, otherwise bad text becomes NULL (see :func:`quarantine_values` to
    keep the bad rows instead)."""
    if strict:
        period, value = F.to_date("period"), to_double_strict("value")
    else:
        period, value = F.col("period").try_cast("date"), to_double_or_null("value")
    return records.withColumn("period", period).withColumn("value", value)


def _bad_text() -> Column:
    # NaN text is a value (read as NULL), not bad text
    return ((F.col("value").isNotNull() & F.col("value").try_cast("double").isNull())
            | (F.col("period").isNotNull() & F.col("period").try_cast("date").isNull()))


def tagged_values(records: DataFrame) -> DataFrame:
    """CAST-2 in one pass: every record with its raw texts, ``bad`` (``value`` or
    ``period`` text is there but does not parse) and the typed columns
    ``typed_period`` and ``typed_value`` (NULL where bad)."""
    ok = ~F.col("bad")
    return records.withColumn("bad", _bad_text()).select(
        "*", F.when(ok, F.col("period").try_cast("date")).alias("typed_period"),
        F.when(ok, to_double_or_null("value")).alias("typed_value"))


def quarantine_values(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """CAST-2 with quarantine: ``(good, bad)``, both lazy.

    ``good`` is :func:`typed_series` without failing; ``bad`` holds the
    records whose ``value`` or ``period`` text is present but does not parse,
    with the raw text kept for inspection.  Evaluating both reads ``records``
    twice; :func:`split_quarantine` reads them once.
    """
    tagged = tagged_values(records)
    return _good(tagged, records.columns), tagged.where("bad").select(*records.columns)


def _good(tagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    typed = {"period": F.col("typed_period").alias("period"), "value": F.col("typed_value").alias("value")}
    return tagged.where("not bad").select(*[typed.get(c, F.col(c)) for c in columns])


def split_quarantine(records: DataFrame, folder: str) -> tuple[DataFrame, dict[str, int]]:
    """CAST-2 with quarantine in one scan: ``(good, counts)``.

    The tagged records are written once to the shared folder, partitioned by
    ``bad``, and counted on the way (``observe``: ``records`` and ``bad``); the
    bad ones are then copied from there to ``folder`` with their raw text."""
    spark = records.sparkSession
    seen = Observation("quarantine")
    path = shared_path(spark, "tagged-records")
    (tagged_values(records).observe(seen, F.count(F.lit(1)).alias("records"), F.count(F.when(F.col("bad"), 1)).alias("bad"))
     .write.partitionBy("bad").parquet(path))
    schema = tagged_values(records).schema
    tagged = spark.read.schema(schema).parquet(path)
    tagged.where("bad").select(*records.columns).write.mode("overwrite").parquet(folder)
    return _good(tagged, records.columns), {k: int(v) for k, v in seen.get.items()}
