"""Turn a raw table into a cleaned side of a match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from twinshelf.config import require_columns
from twinshelf.functions.text import clean_text, last_url_segment
from twinshelf.operators.columns import prefix_columns
from twinshelf.operators.rows import present, row_index


def add_clean_text(df: DataFrame, col: str = "item_name") -> DataFrame:
    """Add ``<col>_clean``; usable with ``df.transform``."""
    require_columns(df, [col], "table to clean")
    return df.withColumn(f"{col}_clean", clean_text(F.col(col)))


def counted(df: DataFrame, observation: Observation | None) -> DataFrame:
    """Count rows as they pass, without another job."""
    if observation is None:
        return df
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows"))


def prepare_text_side(
    df: DataFrame, mode: str = "", key_col: Sequence[str] | None = None,
    col_text: str = "item_name",
    base: Observation | None = None, cleaned: Observation | None = None,
) -> DataFrame:
    """Clean, drop rows with a null key (any column if no key is given), prefix."""
    side = counted(df, base).transform(add_clean_text, col_text)
    side = present(side, key_col or side.columns)
    return counted(prefix_columns(side, mode), cleaned)


def join_assets(
    df: DataFrame, manifest: DataFrame, order: Sequence[str], col_image_url: str = "image_url"
) -> DataFrame:
    """Rows that have an image file, with its path.

    The file key is ``<row index>_<last part of the link>``.
    """
    # the left join followed by a filter on the right side is planned as an inner join
    indexed = row_index(df, order, "img_index")
    key = F.concat(F.col("img_index").cast("string"), F.lit("_"),
                   last_url_segment(F.col(col_image_url)))
    return (
        indexed.withColumn("path_idx", key)
        .join(manifest.select("path_idx", "file_path", "file_exists"), "path_idx", "left")
        .where("file_exists")
        .drop("img_index", "path_idx", "file_exists")
    )


def prepare_image_side(
    df: DataFrame, manifest: DataFrame, mode: str = "", order: Sequence[str] = ("item_id",),
    col_image_url: str = "image_url", col_text: str = "item_name",
    base: Observation | None = None, merged: Observation | None = None,
) -> DataFrame:
    """Clean the text, attach image files, keep rows that have one, prefix."""
    require_columns(df, [col_image_url, col_text, *order], "table to prepare")
    require_columns(manifest, ["path_idx", "file_path", "file_exists"], "image manifest")
    side = join_assets(counted(df, base), manifest, order, col_image_url)
    return counted(prefix_columns(add_clean_text(side, col_text), mode), merged)
