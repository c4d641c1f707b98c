"""What the operators share: reading tables, writing intermediate ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.session import scratch_path, ship_package

#: The white space that separates words, everywhere in this package.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the package is sent to the workers on the way."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: what is read later is the committed output of one run, so a lost
    executor repeats a read, never the work, and a step that is not deterministic
    (arrival order inside a partition) is fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(column: str, modulus: int, remainder: int):
    """Whether crc32 of the id, written as text, leaves ``remainder``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder
