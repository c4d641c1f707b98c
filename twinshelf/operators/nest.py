"""Hits as lists per query, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinshelf.operators.columns import hit_columns


def nest_hits(hits: DataFrame, keys: Sequence[str], fields: Sequence[str],
              rank: str = "rank") -> DataFrame:
    """One row per query; every field becomes a list in rank order."""
    entries = F.array_sort(F.collect_list(F.struct(rank, *fields)))
    nested = hits.groupBy(*keys).agg(entries.alias("_hits"))
    return nested.select(*keys, *[F.col(f"_hits.{f}").alias(f) for f in fields])


def explode_hits(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per list position of all hit columns together.

    A query without lists keeps one row of nulls.  Lists of different lengths
    are an error, not padding.
    """
    lists = list(columns) if columns is not None else hit_columns(df.columns)
    sizes = [F.size(F.coalesce(c, F.array())) for c in lists]
    same = F.size(F.array_distinct(F.array(*sizes))) == 1
    zipped = F.when(same, F.arrays_zip(*lists)).otherwise(
        F.raise_error(F.lit("hit lists of one query have different lengths"))
    )
    others = [c for c in df.columns if c not in lists]
    exploded = df.select(*others, F.inline_outer(zipped))
    return exploded.select(*df.columns)
