"""Fusion of text and image hits into one ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinshelf.functions.scores import fused_score

TEXT = "score_text"
IMAGE = "score_image"


def tagged_union(text: DataFrame, image: DataFrame, keys: Sequence[str],
                 text_score: str, image_score: str) -> DataFrame:
    """Both hit tables stacked, with the kind of match in ``match_type``."""

    def tagged(hits: DataFrame, score: str, tag: str) -> DataFrame:
        return hits.select(*keys, F.lit(tag).alias("match_type"), F.col(score).alias("score"))

    return tagged(text, text_score, TEXT).unionByName(tagged(image, image_score, IMAGE))


def pivot_scores(stacked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per pair with a column per kind; repeated pairs add up.

    The kinds are known, so a conditional sum pivots in one aggregation and both
    columns exist even if one kind has no rows.
    """

    def of(tag: str):
        return F.sum(F.when(F.col("match_type") == tag, F.col("score"))).alias(tag)

    return stacked.groupBy(*keys).agg(of(IMAGE), of(TEXT))


def fuse(text: DataFrame, image: DataFrame, *, query: Sequence[str], hit: Sequence[str],
         tie: str, text_score: str, image_score: str) -> DataFrame:
    """Fused score and rank per query.

    ``query`` and ``hit`` are the columns that identify the query and the rest of
    the pair.  Partitioning by query serves the pivot and the rank: one shuffle.
    """
    keys = [*query, *hit]
    stacked = tagged_union(text, image, keys, text_score, image_score).repartition(*query)
    scored = pivot_scores(stacked, keys).withColumn(
        "score_mean", fused_score(F.col(TEXT), F.col(IMAGE))
    )
    rest = [F.asc_nulls_last(c) for c in hit if c != tie]
    w = Window.partitionBy(*query).orderBy(F.desc_nulls_last("score_mean"), F.asc(tie), *rest)
    return scored.withColumn("rank", F.row_number().over(w))
