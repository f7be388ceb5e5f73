"""Joins: null-safe key join, rule lookup, bounded as-of lookback, fallback.

(JOIN-1, JOIN-3, JOIN-4 / SRC-6, FLT-5)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import lookback_offsets


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   suffix: str = "_right", how: str = "inner") -> DataFrame:
    """JOIN-1: equi-join on ``keys`` where NULL matches NULL.

    Overlapping non-key columns of ``right`` get ``suffix``; the key columns
    are taken from ``left``.  ``<=>`` still plans as a hash/sort-merge join
    (Spark rewrites it to ``coalesce(k, default)`` + ``isnull(k)`` keys).
    Filters on the keys are not inferred across ``<=>``, so callers filter
    both inputs before joining.
    """
    keys = list(keys)
    overlap = [c for c in right.columns if c in left.columns and c not in keys]
    r = right.withColumnsRenamed({c: f"{c}{suffix}" for c in overlap})
    r = r.withColumnsRenamed({k: f"__rk_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__rk_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__rk_{k}" for k in keys])


def lookup_rules(df: DataFrame, rules: DataFrame, on: Sequence[str] | str,
                 how: str = "inner") -> DataFrame:
    """JOIN-3: attach rule columns from a rule table.

    How is left to the planner's size check: a literal rule table
    (``session.literal_rows``) measures tiny and is broadcast, so the big side
    is not shuffled; a large one is joined by shuffle.
    """
    return df.join(rules, on, how)


def asof_lookback(spine: DataFrame, as_of_col: str, inventory: DataFrame,
                  inv_date_col: str, keys: Sequence[str] = (),
                  modes: Sequence[str] = ("corrected",), days: int = 7) -> DataFrame:
    """SRC-6/JOIN-4: for each ``as_of`` pick the first available date in a
    bounded lookback, trying candidates in the order of ``lookback_offsets``.

    ``spine``: ``keys + [as_of]``; ``inventory``: ``keys + [date]`` of what
    is available (e.g. landed reports).  Output: every spine row plus, per
    mode, ``{mode}_found_date``, ``{mode}_offset`` and ``{mode}_trial`` (NULL
    when nothing in the window is available).

    Plan: candidates of all modes are generated per row (at most ``days``
    offsets each, narrow), left-joined once to the inventory on
    ``keys + date`` (an equi-join: the inventory is distinct dates, and AQE
    broadcasts it when it measures small), then one aggregate per spine row
    with a conditional ``min_by`` per mode picks the earliest trial that hit.
    """
    keys = list(keys)
    def tagged(mode: str) -> Column:
        return F.transform(lookback_offsets(F.col(as_of_col), mode, days),
                           lambda o, i: F.struct(F.lit(mode).alias("_mode"),
                                                 i.alias("_trial"), o.alias("_offset")))

    per_mode = [tagged(m) for m in modes]
    cands = spine.select(*keys, as_of_col, F.inline(F.concat(*per_mode))) \
        .withColumn("_cand", F.date_sub(F.col(as_of_col), F.col("_offset")))
    inv = inventory.select(*keys, F.col(inv_date_col).alias("_cand")).distinct() \
        .withColumn("_hit", F.lit(True))
    joined = cands.join(inv, keys + ["_cand"], "left")
    # Integer-only aggregate buffers keep this a hash aggregate; the found
    # date is recomputed from the winning offset.
    aggs = []
    for m in modes:
        hit = F.col("_hit").isNotNull() & (F.col("_mode") == m)
        trial = F.when(hit, F.col("_trial"))
        aggs += [F.min(trial).alias(f"{m}_trial"),
                 F.min_by(F.when(hit, F.col("_offset")), trial).alias(f"{m}_offset")]
    out = joined.groupBy(*keys, as_of_col).agg(*aggs)
    cols = []
    for m in modes:
        cols += [F.date_sub(F.col(as_of_col), F.col(f"{m}_offset")).alias(f"{m}_found_date"),
                 F.col(f"{m}_offset"), F.col(f"{m}_trial")]
    return out.select(*keys, as_of_col, *cols)


# Days of a block, the unit in which the history of a key is dealt out.
ASOF_BLOCK_DAYS = 64


def asof_merge(spine: DataFrame, as_of_col: str, inventory: DataFrame, inv_date_col: str,
               keys: Sequence[str] = (), days: int = 7, weekdays_only: bool = True,
               block_days: int = ASOF_BLOCK_DAYS) -> DataFrame:
    """SRC-6/JOIN-4 for windows of any length: for each ``as_of`` the nearest
    available date on or before it, at most ``days - 1`` days back, as
    :func:`asof_lookback` finds it in the corrected order (which tries weekdays
    only, nearest first), without a row per candidate date.

    Output: the spine's columns plus ``found_date`` and ``offset`` (NULL when
    the window has nothing).  A NULL key or date has nothing available.

    Two levels: spine and inventory are merged by date within blocks of
    ``block_days`` days of a key (last available date so far), and the latest
    date of all earlier blocks comes from a running maximum over one row per key
    and block.  So a key with most of all rows is as many groups as it has
    blocks, and the rows of a key are shuffled once however long the window is.
    """
    keys = list(keys)
    if clash := {"found_date", "offset"} & set(spine.columns):
        raise ValueError(f"the spine has columns named {sorted(clash)}")
    own = [c for c in spine.columns if c not in keys]
    inv = inventory.select(*keys, F.col(inv_date_col).cast("date").alias("_date")).where("_date is not null")
    if weekdays_only:
        inv = inv.where(F.weekday("_date") < 5)
    inv = inv.distinct()
    left = spine.select(*keys, F.col(as_of_col).cast("date").alias("_date"), F.struct(*own).alias("_row"))
    block = F.floor(F.datediff(F.col("_date"), F.lit("1970-01-01").cast("date")) / block_days)
    both = (left.unionByName(inv.withColumn("_found", F.col("_date")), allowMissingColumns=True)
            .withColumn("_block", block).repartition(*keys, "_block"))

    # Level 1: the last available date within the block; of equal dates all of
    # the inventory comes first, as a frame by date holds its peers.
    so_far = Window.partitionBy(*keys, "_block").orderBy("_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    here = both.withColumn("_here", F.max("_found").over(so_far)).where("_row is not null")
    # Level 2: the latest one of all earlier blocks.
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (both.groupBy(*keys, "_block").agg(F.max("_found").alias("_last"))
              .withColumn("_before", F.max("_last").over(earlier)).where("_before is not null")
              .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_block").alias("_b"), "_before"))
    on = F.col("_block") == F.col("_b")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    found = F.coalesce("_here", "_before")
    for k in keys:                       # a NULL key is a group to a window, but nothing is available for it
        found = F.when(F.col(k).isNotNull(), found)
    away = F.datediff("_date", found)
    out = here.join(blocks, on, "left").withColumn("_away", F.when(away < days, away))
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in own],
                      F.date_sub("_date", F.col("_away")).alias("found_date"), F.col("_away").alias("offset")).select(
        *spine.columns, "found_date", "offset")


def first_nonempty_candidate(spine: DataFrame, key_cols: Sequence[str],
                             candidates: Sequence[Column], data: DataFrame,
                             data_key: str, cand_name: str = "candidate",
                             rank_name: str = "rank") -> DataFrame:
    """FLT-5: per spine row, the first candidate key that has data.

    ``candidates`` are Column expressions over the spine row in preference
    order (e.g. this Friday, the previous Friday).  Candidates are exploded
    (narrow), inner-joined to ``data`` on ``data_key``, and the lowest rank
    per spine row is kept with a ``min_by`` over a struct of the data row.
    Spine rows with no candidate hit produce no row (the source raised on an
    empty week).  Replaces a driver-side ``isEmpty`` check per date.
    """
    key_cols = list(key_cols)
    arr = F.array(*[F.struct(F.lit(i).alias("r"), c.alias("c")) for i, c in enumerate(candidates)])
    cands = spine.select(*key_cols, F.inline(arr)) \
        .withColumnsRenamed({"r": rank_name, "c": cand_name})
    hits = cands.join(data.withColumnRenamed(data_key, cand_name), cand_name, "inner")
    payload = [c for c in hits.columns if c not in key_cols]
    return hits.groupBy(*key_cols).agg(
        F.min_by(F.struct(*[F.col(c) for c in payload]), F.col(rank_name)).alias("_b")
    ).select(*key_cols, *[F.col(f"_b.{c}").alias(c) for c in payload])
