"""Match query rows as they arrive against a fixed database table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def arriving_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stream of the rows of a Parquet table, which may be one file or a folder of files.

    A stream takes a plain path for a folder only; a pattern that fits this one path is taken for both.
    """
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def match_stream(
    queries: DataFrame,
    match_batch: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Run ``match_batch`` on every micro-batch of new query rows.

    A batch that is run again after a failure overwrites its own folder, so each
    query row has its hits once.  Read the result with ``read.parquet(out)``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # a match looks at its queries several times; the source is read once
        batch.persist()
        try:
            match_batch(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = queries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
