"""Literal tables (SRC-4): rule tables and small fixtures, with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..rules import PRODUCT_RULES
from ..session import literal_rows

PRODUCT_RULE_SCHEMA = ("position int, source_id string, data_set string, display_name string, "
                       "price string, transform string, sink_column string")

SETTLEMENT_ROW_SCHEMA = ("Data_Set string, Month string, Settlement_Price double, "
                         "Last_Price double")


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal table with an explicit schema (no inference; NaN is NULL),
    built from constant expressions (see ``session.literal_rows``)."""
    return literal_rows(spark, rows, schema)


def product_rules(spark: SparkSession) -> DataFrame:
    """The settlement product rule table."""
    return literal_rows(spark, PRODUCT_RULES, PRODUCT_RULE_SCHEMA)
