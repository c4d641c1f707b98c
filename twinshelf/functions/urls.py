"""Links and spreadsheet formulas; a null part makes the whole value null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def product_url(base_url: str, shop_id: Column, item_id: Column) -> Column:
    return F.concat(
        F.lit(base_url), shop_id.cast("string"), F.lit("/"), item_id.cast("string")
    )


def image_formula(url: Column) -> Column:
    return F.concat(F.lit('=IMAGE("'), url, F.lit('", 1)'))


def first_of_list(images: Column, separator: str = ",") -> Column:
    """Array with the first entry of a separated list; null for a null list."""
    return F.slice(F.split(images, separator), 1, 1)
