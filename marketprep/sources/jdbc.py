"""JDBC source and sink (SRC-5, SNK-1, SNK-2).

Credentials and URLs are the caller's: nothing here reads the environment.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def declared_types(ddl: str) -> list[tuple[str, T.DataType]]:
    """``"a DOUBLE, `U.S.` DECIMAL(10,2)"`` as Spark reads it (the same parser
    reads the writer's ``createTableColumnTypes``)."""
    return [(f.name, f.dataType) for f in T.StructType.fromDDL(ddl).fields]


def cast_to_declared(df: DataFrame, column_types: str) -> DataFrame:
    """Cast columns to the types declared for the sink, before writing.

    A text ``Date`` column would otherwise create a text column.  Texts of
    bounded length are texts to Spark; the database checks the length.
    """
    declared = dict(declared_types(column_types))

    def cast(c: str) -> Column:
        kind = declared.get(c)
        if isinstance(kind, (T.VarcharType, T.CharType)):
            kind = T.StringType()
        return F.col(f"`{c}`").cast(kind).alias(c) if kind else F.col(f"`{c}`")

    return df.select(*[cast(c) for c in df.columns])


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               column_types: str | None = None, options: Mapping[str, str] | None = None,
               num_partitions: int | None = None, batch_size: int = 10_000,
               truncate: bool = True) -> None:
    """SNK-1 (``overwrite``) / SNK-2 (``append``).

    ``truncate`` keeps the table and its declared types on overwrite; the
    write runs from ``num_partitions`` parallel connections.
    """
    if column_types:
        df = cast_to_declared(df, column_types)
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)).option("truncate", str(truncate).lower()))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def read_jdbc(spark: SparkSession, url: str, table: str,
              options: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | str | None = None,
              upper_bound: int | str | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """SRC-5: table read; projections and simple filters push to the database.

    With ``partition_column`` and bounds the read is split into
    ``num_partitions`` range queries instead of one connection.
    """
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", str(fetch_size)))
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs lower/upper bound and num_partitions")
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions)))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()
