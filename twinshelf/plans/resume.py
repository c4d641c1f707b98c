"""Leave out work that an earlier run has finished."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinshelf.operators.rows import matching
from twinshelf.sources.tables import FOLDER, folder_key, read_by_category, read_or_none


def pending_categories(q: DataFrame, category: str, out: str) -> DataFrame:
    """Query rows of categories without a result in the table at ``out``.

    Only folder names are needed, so the scan of the results reads no column.
    """
    done = read_or_none(q.sparkSession, out)
    if done is None:
        return q
    finished = done.select(F.col(FOLDER)).distinct()
    keyed = q.withColumn("_folder", folder_key(F.col(category)))
    return matching(keyed, finished, {"_folder": FOLDER}, "left_anti").drop("_folder")


def pending_queries(q: DataFrame, row_id: str, category: str, out: str) -> DataFrame:
    """Query rows without a hit in the table at ``out``."""
    done = read_by_category(q.sparkSession, out)
    if done is None:
        return q
    finished = done.select("category", row_id).distinct()
    return matching(q, finished, {category: "category", row_id: row_id}, "left_anti")
