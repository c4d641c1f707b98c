"""Column naming, selection and order."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

HIT_COLUMN = re.compile(r"^(db_|score)")


def prefix_columns(df: DataFrame, mode: str) -> DataFrame:
    """``name`` → ``<mode>_name`` for every column; unchanged for an empty mode."""
    if not mode:
        return df
    return df.withColumnsRenamed({c: f"{mode}_{c}" for c in df.columns})


def replace_columns(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``SELECT * EXCLUDE (...)`` plus new values under the excluded names."""
    return df.select(*[c for c in df.columns if c not in values],
                     *[v.alias(name) for name, v in values.items()])


def hit_columns(columns: Sequence[str]) -> list[str]:
    """Columns that belong to a hit rather than to the query row."""
    return [c for c in columns if HIT_COLUMN.search(c)]


def review_columns(columns: Sequence[str]) -> list[str]:
    """Order for reviewers: query, database, both images, scores."""

    def starting(prefix: str) -> list[str]:
        return sorted(c for c in columns if c.startswith(prefix) and "image_url" not in c)

    images = [c for c in ("q_image_url", "db_image_url") if c in columns]
    return starting("q_") + starting("db_") + images + starting("score")
