"""Session helpers: where tables that must outlive a plan are written."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be invisible to the other executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="twinshelf-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing else writes to it."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage and continue from there."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Not needed where the package is installed on the executors or was given with
    ``--py-files``.
    """
    if getattr(spark.sparkContext, "_twinshelf_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="twinshelf-")) / "twinshelf"
    zipped = shutil.make_archive(str(archive), "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(zipped)
    spark.sparkContext._twinshelf_shipped = True
