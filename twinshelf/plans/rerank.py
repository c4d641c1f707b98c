"""Fuse text and image matches of the same pair into one ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.config import DATABASE, QUERY, MatchConfig, require_columns
from twinshelf.operators.fuse import fuse
from twinshelf.plans.ledger import read_matched
from twinshelf.plans.resume import pending_categories
from twinshelf.sources.tables import read_by_category, write_by_category


def rerank(text: DataFrame, image: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Pairs of either kind with both scores, their fusion and the rank per query.

    A category that only one kind has is ranked by that kind alone.
    """
    q_id, db_id = config.side(QUERY, config.id_col), config.side(DATABASE, config.id_col)
    q_name, db_name = config.side(QUERY, config.name_col), config.side(DATABASE, config.name_col)
    keys = ["category", q_id, q_name, db_id, db_name]
    require_columns(text, [*keys, "score_text_embed"], "text matches")
    require_columns(image, [*keys, "score_image_embed"], "image matches")
    fused = fuse(
        text, image, query=["category", q_id], hit=[q_name, db_id, db_name], tie=db_id,
        text_score="score_text_embed", image_score="score_image_embed",
    )
    return fused.select(*keys, "score_image", "score_text", "score_mean", "rank")


def all_categories(text: DataFrame, image: DataFrame) -> DataFrame:
    """Categories present in either kind."""
    return text.select("category").union(image.select("category")).distinct()


def read_results(spark: SparkSession, path: str) -> DataFrame | None:
    """Hits of finished runs, whether they were resumed by query or by category."""
    matched = read_matched(spark, path)
    return read_by_category(spark, path) if matched is None else matched


def run_rerank(
    spark: SparkSession, path_text: str, path_image: str, out: str,
    config: MatchConfig = MatchConfig(),
) -> None:
    """Fuse two result tables, one partition per category, skipping finished ones."""
    text, image = (read_results(spark, path) for path in (path_text, path_image))
    if text is None and image is None:
        raise ValueError(f"no matches at {path_text} or {path_image}")
    if text is None:
        text = image.withColumnRenamed("score_image_embed", "score_text_embed").limit(0)
    if image is None:
        image = text.withColumnRenamed("score_text_embed", "score_image_embed").limit(0)
    text, image = (pending_categories(df, "category", out) for df in (text, image))
    write_by_category(rerank(text, image, config), out)


def in_rank_order(fused: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """By query, then by fused score; missing values last."""
    q_id = config.side(QUERY, config.id_col)
    return fused.orderBy(F.asc_nulls_last(q_id), F.desc_nulls_last("score_mean"), "rank")
