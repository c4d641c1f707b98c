"""Parquet, SQL and CSV tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.functions.text import file_number


# Column that names the folder of a category.
FOLDER = "category_folder"


def read_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One column of a table; the scan reads nothing else."""
    return spark.read.parquet(path).select(column)


def read_spread(spark: SparkSession, path: str) -> DataFrame:
    """A table for work that is heavy per row.

    A scan with fewer splits than the session has cores, such as a single file,
    is spread over the cores; a large table is read as it is.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_group(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """Rows of one category; the filter reaches the scan.  Null is no category."""
    return spark.read.parquet(path).where(F.col(column) == value)


def read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table, or None if nothing has been written there."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished write left its table there.

    A write that broke off may leave a folder or files; only a finished one is marked.
    """
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def read_shards(spark: SparkSession, path: str, part: int = 0, in_folder: bool = False) -> DataFrame:
    """All shard files as one table, with the ``shard`` number in their names.

    The number is the ``part``-th ``_`` field of the file name, or of its folder
    if each shard is a folder.  Sorting by it puts shard 10 after shard 9.
    """
    df = spark.read.parquet(path)
    name = F.col("_metadata.file_path")
    if in_folder:
        name = F.substring_index(F.substring_index(name, "/", -2), "/", 1)
    return df.select("*", file_number(name, part).alias("shard"))


def write_if_absent(df: DataFrame, path: str) -> DataFrame:
    """Materialise an extract unless a finished one is there, and read it back."""
    if not exists(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def recreate(df: DataFrame, path: str) -> DataFrame:
    """Replace a table by ``df`` and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_by_category(df: DataFrame, path: str, category: str = "category",
                      dynamic: bool = True) -> None:
    """One folder per category; only categories present in ``df`` are replaced.

    Rebalancing gives a small category one file and splits a large one.  The folders are
    named by :func:`folder_key`; the category itself stays a column of the files.
    """
    (
        df.withColumn(FOLDER, folder_key(F.col(category)))
        .hint("rebalance", FOLDER)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(FOLDER)
        .parquet(path)
    )


def append_by_category(df: DataFrame, path: str, category: str = "category") -> None:
    """Add rows to the folders of their categories."""
    keyed = df.withColumn(FOLDER, folder_key(F.col(category))).hint("rebalance", FOLDER)
    keyed.write.mode("append").partitionBy(FOLDER).parquet(path)


def read_by_category(spark: SparkSession, path: str) -> DataFrame | None:
    """A table written by category, as it was; None if there is none."""
    stored = read_or_none(spark, path)
    return None if stored is None else stored.drop(FOLDER)


def folder_key(category: Column) -> Column:
    """A folder name that can be taken for nothing but text: never a number, a date or empty."""
    return F.concat(F.lit("c_"), F.url_encode(category.cast("string")))


def write_if_any(df: DataFrame, path: str) -> bool:
    """Write only a result that has rows; tells whether it was written."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def sql_over(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """SQL in which ``{name}`` stands for a DataFrame."""
    return spark.sql(query, **frames)


def extract_clusters(df: DataFrame, clusters: Sequence[str], column: str = "cluster") -> DataFrame:
    """One plan for many clusters instead of one run per cluster."""
    return df.where(F.col(column).isin(list(clusters)))


def write_csv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite").option("header", True)
    # quotes inside a value are doubled, as spreadsheets and SQL engines expect
    writer = writer.option("escape", '"')
    (writer.partitionBy(partition_by) if partition_by else writer).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """With a stated schema, so no extra pass guesses the types."""
    return (
        spark.read.schema(schema).option("header", True)
        .option("escape", '"').option("multiLine", True).csv(path)
    )
