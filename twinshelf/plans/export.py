"""Review tables with links and image formulas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinshelf.config import DATABASE, QUERY
from twinshelf.functions.urls import image_formula, product_url
from twinshelf.operators.columns import replace_columns, review_columns
from twinshelf.sources.tables import write_csv


def export_review(df: DataFrame, base_url: str, id_col: str = "item_id",
                  verbose: bool = False) -> DataFrame:
    """Columns for reviewers; what a side lacks (shop, image) is left out."""
    values = {}
    for side in (DATABASE, QUERY):
        if f"{side}_image_url" in df.columns:
            values[f"{side}_image_url"] = image_formula(F.col(f"{side}_image_url"))
        if f"{side}_shop_id" in df.columns:
            values[f"{side}_url"] = product_url(
                base_url, F.col(f"{side}_shop_id"), F.col(f"{side}_{id_col}")
            )
    out = replace_columns(df, values)
    out = out.select(*review_columns(out.columns))
    if verbose:
        out.explain("formatted")
    return out


def save_csv(df: DataFrame, path: str, category: str | None = None) -> None:
    """CSV with header, one folder per category if a category is given."""
    write_csv(df, path, category)
