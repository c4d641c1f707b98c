"""Catalogue sample and brand list from warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinshelf.functions.urls import first_of_list
from twinshelf.operators.rows import first_rows, keep_first, latest_snapshot
from twinshelf.operators.small import measured
from twinshelf.sources.tables import extract_clusters


def days_before(as_of: date, n: int) -> Column:
    return F.date_sub(F.lit(as_of), n)


def category_map(snapshots: DataFrame) -> DataFrame:
    """Category → cluster in the latest snapshot of the map.

    Computed at once: joined while still unmeasured, a hot category would be
    shuffled into one task.
    """
    latest = latest_snapshot(snapshots, "ingestion_timestamp")
    return measured(latest.select("level1_global", "cluster").distinct()).for_join()


def catalogue_extract(
    orders: DataFrame, map_snapshots: DataFrame, item_ext: DataFrame, as_of: date,
    clusters: Sequence[str], limit: int | None = None,
) -> DataFrame:
    """Items sold officially the day before, with cluster and images if known.

    Every input is made distinct before it is joined: repeated orders of one
    popular item collapse map-side, and the joined rows are distinct already.
    All rows are returned unless a ``limit`` is asked for.
    """
    sold = orders.where(
        (F.col("grass_date") == days_before(as_of, 1))
        & (F.col("is_bi_excluded") == 0)
        & (F.col("is_net_order") == 1)
        & (F.col("is_official_shop") == 1)
    ).select(
        "item_id", "item_name", "shop_id", "shop_name", "level1_global_be_category"
    ).distinct()
    cat = extract_clusters(category_map(map_snapshots), clusters)
    # the date belongs to the join condition: items without that day's images stay
    images = item_ext.where(F.col("grass_date") == days_before(as_of, 2)).select(
        "item_id", "images"
    ).distinct()
    items = sold.join(cat, sold["level1_global_be_category"] == cat["level1_global"])
    items = items.drop("level1_global").join(images, "item_id", "left")
    if limit is None:
        return items
    return first_rows(items, items.columns, limit)


def with_image_url(items: DataFrame, base_url: str) -> DataFrame:
    """Link of the first listed image; items without a list are dropped."""
    first = F.explode(first_of_list(F.col("images")))
    return items.select("*", first.alias("_image")).withColumn(
        "image_url", F.concat(F.lit(base_url), F.col("_image"))
    ).drop("_image")


def unique_items(items: DataFrame) -> DataFrame:
    """One row per item: the first by images, name and shop."""
    return keep_first(items, ["item_id"], ["images", "item_name", "shop_id"])


def brand_list(brands: DataFrame, as_of: date) -> DataFrame:
    """Active named brands per category, from the day before."""
    return brands.where(
        (F.col("grass_date") == days_before(as_of, 1))
        & (F.col("global_brand") != "NoBrand")
        & F.col("global_brand").isNotNull()
        & (F.col("status") == 1)
    ).select("level1_global_be_category", "final_brand").distinct()
