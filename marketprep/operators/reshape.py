"""Row picking, pivots and concatenation (TOP-1/2, AGG-1..4, SET-1, PRJ-*).

Row picks are aggregates (``min_by``/``max_by`` over a struct) rather than a
window sort wherever one row per group is wanted: the aggregate combines
map-side, so a hot key shrinks to one row per task before the shuffle.
(A struct buffer makes Spark plan a sort-based aggregate, which spills
cleanly; fixed-width values, as in the pivots, stay hash aggregates.)
Top-n uses ``row_number() <= n``, which Spark plans as a partial
``WindowGroupLimit`` before the exchange and a final one after.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..rules import PivotRule


def _cols(cs: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
          cols: Sequence[str] | None, last: bool) -> DataFrame:
    keys = list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    payload = F.struct(*[F.col(f"`{c}`") for c in cols])
    ordering = F.struct(*_cols(order))
    agg = F.max_by(payload, ordering) if last else F.min_by(payload, ordering)
    return df.groupBy(*keys).agg(agg.alias("_row")).select(
        *keys, *[F.col("_row").getField(c).alias(c) for c in cols])


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                    cols: Sequence[str] | None = None) -> DataFrame:
    """TOP-1: the first row of each group under a total ``order``.

    ``order`` must be a total order within a group (add a unique tiebreak),
    otherwise "first" is not defined.
    """
    return _pick(df, keys, order, cols, last=False)


def last_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   cols: Sequence[str] | None = None) -> DataFrame:
    """AGG-4: keyed de-duplication, last row wins (dict-assignment semantics)."""
    return _pick(df, keys, order, cols, last=True)


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                    n: int, rank_col: str = "rn") -> DataFrame:
    """SRC-7/TOP-2: the first ``n`` rows of each group (``n`` is the feature).

    ``row_number() <= n`` becomes partial + final ``WindowGroupLimit``, so a
    hot group sends at most ``n`` rows per task through the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def sort_offset_limit(df: DataFrame, order: Sequence[Column], offset: int, n: int) -> DataFrame:
    """TOP-2 for a single facet: ``ORDER BY .. OFFSET .. LIMIT``."""
    return df.orderBy(*order).offset(offset).limit(n)


def rule_pivot(long: DataFrame, keys: Sequence[str], rules: Sequence[PivotRule],
               name_col: str, value_col: str, order_col: Column | str) -> DataFrame:
    """AGG-1: long -> wide by a rule list; duplicates: the highest ``order`` wins.

    One conditional ``max_by`` per output column in a single aggregate
    (partial + final; a hash aggregate for numeric values), instead of
    ``pivot()`` over ``max_by`` which adds a sort aggregate.
    Rules whose key never appears produce a NULL column, not an error.
    """
    order = F.col(order_col) if isinstance(order_col, str) else order_col
    name = F.col(name_col)
    aggs = []
    for r in sorted(rules, key=lambda r: r.position):
        hit = name == F.lit(r.key)
        aggs.append(F.max_by(F.when(hit, F.col(value_col)), F.when(hit, order)).alias(r.column))
    return long.groupBy(*keys).agg(*aggs)


def label_pivot(df: DataFrame, keys: Sequence[str], label_col: str, value_col: str,
                labels: Sequence[str], order_col: Column | str | None = None) -> DataFrame:
    """AGG-2/AGG-3: label -> column with a fixed label list.

    One conditional aggregate per label; the list fixes the output schema, and
    a label with no data is a NULL column.  The group key is the single
    distinct value the source read (AGG-3).  Duplicate labels within a group:
    the row of highest ``order_col`` counts, whatever its value; without an
    order (labels unique by construction) any non-NULL value is the one.
    """
    order = F.col(order_col) if isinstance(order_col, str) else order_col

    def cell(lab: str) -> Column:
        hit = F.col(label_col) == F.lit(lab)
        value = F.when(hit, F.col(value_col))
        return F.max(value) if order is None else F.max_by(F.col(value_col), F.when(hit, order))

    return df.groupBy(*keys).agg(*[cell(lab).alias(lab) for lab in labels])


def concat_tagged(frames: Mapping[str, DataFrame], tag_col: str = "tag") -> DataFrame:
    """SET-1/PRJ-5: row concatenation aligned by name, each frame tagged.

    Columns missing on one side are NULL (``allowMissingColumns``).
    """
    out = None
    for tag, df in frames.items():
        tagged = df.withColumn(tag_col, F.lit(tag))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("concat_tagged needs at least one frame")
    return out


def select_first_n_columns(df: DataFrame, n: int) -> DataFrame:
    """PRJ-2: keep the first ``n`` columns by position."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns[:n]])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ-4: rename by map (dotted names need no back-ticks here)."""
    return df.withColumnsRenamed(dict(mapping))


def select_in_order(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """PRJ-6: final fixed column order; a missing name is an analysis error."""
    return df.select(*[F.col(f"`{c}`") for c in names])
