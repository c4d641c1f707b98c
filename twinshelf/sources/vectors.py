"""Vector tables: id and ``array<float>`` in Parquet, never aligned by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.functions.vectors import to_float32


def write_vectors(df: DataFrame, path: str, key: str, vec: str) -> None:
    df.select(key, to_float32(F.col(vec)).alias(vec)).write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str, vec: str, dim: int) -> DataFrame:
    """The table; a vector of another length stops the job that reads it."""
    checked = F.when(F.col(vec).isNull() | (F.size(vec) == dim), F.col(vec)).otherwise(
        F.raise_error(F.lit(f"{vec} has a vector whose length is not {dim}"))
    )
    return spark.read.parquet(path).withColumn(vec, checked)
