"""How many items each category sold within 30, 60 and 90 days."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinshelf.plans.extract import category_map, days_before
from twinshelf.session import cut

HORIZONS = (30, 60, 90)
LEVELS_3 = [f"level{i}_global_be_category" for i in range(1, 4)]
LEVELS_5 = [f"level{i}_global_be_category" for i in range(1, 6)]


def _distinct_item_counts(as_of: date):
    """Counts over one row per (category, item) that carries its last date.

    An item was sold within n days exactly if its last date is.  So one grouping
    by (category, item) replaces three distinct counts, which would each repeat
    the input.
    """
    return [
        F.count(F.when(F.col("_last") >= days_before(as_of, n), F.col("item_id"))).alias(
            f"total_items_{n}d"
        )
        for n in HORIZONS
    ]


def category_counts(orders: DataFrame, levels: Sequence[str], as_of: date) -> DataFrame:
    """Distinct items per category and horizon (first day included)."""
    recent = orders.where(F.col("grass_date") >= days_before(as_of, HORIZONS[-1]))
    last = recent.groupBy(*levels, "item_id").agg(F.max("grass_date").alias("_last"))
    return last.groupBy(*levels).agg(*_distinct_item_counts(as_of))


def with_cluster(counts: DataFrame, map_snapshots: DataFrame) -> DataFrame:
    """Counts with their cluster, null if the map has none.

    The map is joined to the counts, not to the orders: the cluster depends on a
    grouping column alone, so the join can wait until little is left.
    """
    cat = category_map(map_snapshots)
    joined = counts.join(cat, counts[LEVELS_3[0]] == cat["level1_global"], "left")
    return joined.select("cluster", *counts.columns)


def coverage_stats(
    orders: DataFrame, map_snapshots: DataFrame, levels: Sequence[str], as_of: date
) -> DataFrame:
    """Counts, share of the total and growth between horizons.

    The total includes categories without a cluster, which are dropped after it.
    A category with nothing in the last 30 days has null ratios.
    """
    # one row per category, used twice: without the cut Spark would scan the orders
    # once for the rows and once more for their total
    counts = cut(with_cluster(category_counts(orders, levels, as_of), map_snapshots))
    total = counts.agg(F.sum("total_items_90d")).scalar()
    return (
        counts.withColumn("pct_90d", F.col("total_items_90d") / total)
        .withColumn("dif_60", F.try_divide("total_items_60d", "total_items_30d"))
        .withColumn("dif_90", F.try_divide("total_items_90d", "total_items_30d"))
        .where("cluster IS NOT NULL")
        .orderBy(*levels)
    )


def coverage_both_grains(orders: DataFrame, map_snapshots: DataFrame, as_of: date) -> DataFrame:
    """Three-level and five-level counts from one scan; ``grain`` is 3 or 5.

    Items are made distinct at both grains at once by grouping sets, because an
    item may sit in several fine categories of the same coarse one.
    """
    recent = orders.where(F.col("grass_date") >= days_before(as_of, HORIZONS[-1])).select(
        *LEVELS_5, "item_id", "grass_date"
    )
    columns = [F.col(c) for c in (*LEVELS_5, "item_id")]
    coarse = [F.col(c) for c in (*LEVELS_3, "item_id")]
    # bit set in the grouping id: the finest level was left out
    grain = F.when(F.grouping("level5_global_be_category") == 1, 3).otherwise(5)
    last = recent.groupingSets([coarse, columns], *columns).agg(
        F.max("grass_date").alias("_last"), grain.alias("grain")
    )
    counts = last.groupBy("grain", *LEVELS_5).agg(*_distinct_item_counts(as_of))
    return with_cluster(counts, map_snapshots)


def daily_sketches(orders: DataFrame, levels: Sequence[str], log2_registers: int = 12) -> DataFrame:
    """One mergeable sketch of the distinct items for each category and day.

    A table of these can be kept and appended to day by day; a horizon is then a union of its days' sketches,
    without a look at the orders. A sketch takes at most about 2 ** ``log2_registers`` bytes, however many items it has.
    """
    return orders.groupBy(*levels, "grass_date").agg(
        F.hll_sketch_agg("item_id", F.lit(log2_registers)).alias("items")
    )


def relative_error(log2_registers: int = 12, deviations: float = 4.0) -> float:
    """Bound on the relative error of a merged count that holds up to so many standard deviations.

    The standard error of the estimate from a union is at most 1.04 over the root of the number of registers.
    """
    return deviations * 1.04 / math.sqrt(2**log2_registers)


def estimated_counts(daily: DataFrame, levels: Sequence[str], as_of: date) -> DataFrame:
    """As :func:`category_counts`, from daily sketches: counts are estimates, within :func:`relative_error`.

    The union combines before the shuffle, so a category sends one sketch a task and horizon.
    """
    recent = daily.where(F.col("grass_date") >= days_before(as_of, HORIZONS[-1]))
    unions = [
        F.hll_union_agg(F.when(F.col("grass_date") >= days_before(as_of, n), F.col("items"))) for n in HORIZONS
    ]
    return recent.groupBy(*levels).agg(*(
        F.coalesce(F.hll_sketch_estimate(u), F.lit(0)).cast("long").alias(f"total_items_{n}d")
        for n, u in zip(HORIZONS, unions)
    ))


def estimates_beside_counts(orders: DataFrame, daily: DataFrame, levels: Sequence[str], as_of: date, error: float) -> DataFrame:
    """Exact counts, and for each horizon whether the estimate is within ``error`` (relative, half an item at least)."""
    exact, guess = category_counts(orders, levels, as_of), estimated_counts(daily, levels, as_of)
    columns = {f"total_items_{n}d": f"_guess_{n}d" for n in HORIZONS}
    renamed = guess.select(*(F.col(c).alias(f"_{c}") for c in levels), *(F.col(c).alias(g) for c, g in columns.items()))
    # categories may be null, which is a category of its own in both
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in levels]
    joined = exact.join(renamed, same, "full")
    within = [
        F.coalesce(F.abs(F.col(c) - F.col(g)) <= F.greatest(F.col(c) * error, F.lit(0.5)), F.lit(False)).alias(f"within_{c[12:]}")
        for c, g in columns.items()
    ]
    return joined.select(*exact.columns, *within)
