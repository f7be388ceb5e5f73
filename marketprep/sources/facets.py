"""Faceted top-N request over a landed series table (SRC-7).

The source asked a remote API for one series by an equality facet, newest
first, offset 0, 12 rows.  Over a landed table that is a filter (pushed into
the scan) plus a per-series top-n.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import sort_offset_limit, top_n_per_group
from ..rules import FACET_ROWS


def facet_top_n(df: DataFrame, facets: Mapping[str, Sequence[str]] | None,
                series_keys: Sequence[str], order: Sequence[Column],
                n: int = FACET_ROWS, offset: int = 0) -> DataFrame:
    """Rows matching every facet, the newest ``n`` per series.

    ``order`` must end with a unique tiebreak.  With no ``series_keys`` it is
    a single ``ORDER BY .. OFFSET .. LIMIT``.
    """
    for col, values in (facets or {}).items():
        df = df.where(F.col(col).isin(list(values)))
    if not series_keys:
        return sort_offset_limit(df, order, offset, n)
    ranked = top_n_per_group(df, series_keys, order, n + offset)
    return ranked.where(F.col("rn") > offset)
