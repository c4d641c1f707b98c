"""Image files under ``<folder>/<sub>/<index>_<name>.jpg``."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.functions.text import file_number, file_stem


def plain_path(path: Column) -> Column:
    """``file:/x`` and ``file:///x`` are the same file; both become ``/x``."""
    return F.regexp_replace(path, "^file:/+", "/")


def image_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Key, path and presence of every image file, without reading the files."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.jpg")
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    path = plain_path(F.col("path"))
    return files.select(
        file_stem(path).alias("path_idx"),
        path.alias("file_path"),
        F.lit(True).alias("file_exists"),
    )


def in_file_order(manifest: DataFrame) -> DataFrame:
    """Sorted by the number at the start of the file name."""
    return manifest.orderBy(file_number(F.col("file_path")).asc_nulls_last(), "file_path")


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """``file_path`` and the decoded ``image`` struct of every file.

    A file that cannot be decoded keeps its row, with a null image, and so has a null
    vector and no hits; :func:`unreadable` lists such files.
    """
    images = (
        spark.read.format("image")
        .option("dropInvalid", False)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    # the source gives what it cannot decode a negative height
    readable = F.when(F.col("image.height") > 0, F.col("image")).alias("image")
    return images.select(plain_path(F.col("image.origin")).alias("file_path"), readable)


def unreadable(images: DataFrame) -> DataFrame:
    """Paths of the files that could not be decoded."""
    return images.where(F.col("image").isNull()).select("file_path")


def write_files(df: DataFrame, folder: str, path_col: str, content_col: str) -> int:
    """Write one file per row from the tasks; returns the number of files.

    ``path_col`` is relative to ``folder``, which all executors must reach.  A
    retried task writes the same names again, so nothing is left half done.
    """

    # a path without a scheme is one of the cluster's default file system
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    located = store.makeQualified(path).toString()
    if located.startswith("file:"):
        located = "file:///" + located.removeprefix("file:").lstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = fs.FileSystem.from_uri(located)
        made = set()
        for batch in batches:
            for name, content in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                path = f"{root}/{name}"
                folder = path.rsplit("/", 1)[0]
                if folder not in made:
                    target.create_dir(folder, recursive=True)
                    made.add(folder)
                with target.open_output_stream(path) as out:
                    out.write(content)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    written = df.select(path_col, content_col).mapInArrow(write, "n long")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
