"""Keep every stored query's best rows up to date while database rows arrive.

The state is one row per query and hit, at most k hits a query. Hits among new rows are merged into
it: the k best of a union are the k best of each part's k best, so an arrival is matched once and
never read again. Every micro-batch writes a new version of the state from the one before it; a batch
that is run again after a failure starts from the same version and overwrites its own, so nothing is
counted twice. The last two versions are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twinshelf.operators.knn import top_k
from twinshelf.sources.tables import exists


def versions(spark: SparkSession, state: str) -> list[int]:
    """Finished versions of the state, oldest first."""
    at = spark._jvm.org.apache.hadoop.fs.Path(state)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(at):
        return []
    names = [s.getPath().getName() for s in store.listStatus(at)]
    numbers = sorted(int(n.split("=")[1]) for n in names if n.startswith("version="))
    return [n for n in numbers if exists(spark, f"{state}/version={n}")]


def read_state(spark: SparkSession, state: str, before: int | None = None) -> DataFrame | None:
    """The hits of the last finished version, or of the last one before a batch; None if there is none."""
    found = [n for n in versions(spark, state) if before is None or n < before]
    return spark.read.parquet(f"{state}/version={found[-1]}") if found else None


def match_database_stream(
    arriving: DataFrame, match_batch: Callable[[DataFrame], DataFrame], state: str, checkpoint: str, *,
    k: int, query: Sequence[str], db_id: str = "db_id", score: str = "score", available_now: bool = True,
) -> StreamingQuery:
    """Merge the hits that ``match_batch`` finds for all queries among new database rows.

    Hits have the columns ``query``, ``db_id``, ``score`` and ``rank``. A row that arrives again
    under its id takes the place of the one before it in hits that both are part of.
    """

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            new = match_batch(batch).drop("rank").withColumn("_new", F.lit(1))
            held = read_state(spark, state, before=batch_id)
            if held is not None:
                new = new.unionByName(held.drop("rank").withColumn("_new", F.lit(0)))
            # one hit for each pair, the newest; it is aggregated before the shuffle
            pairs = new.groupBy(*query, db_id).agg(F.max(F.struct("_new", score)).alias("_hit"))
            hits = pairs.select(*query, db_id, F.col(f"_hit.{score}").alias(score))
            top_k(hits, query, k, score, db_id).write.mode("overwrite").parquet(f"{state}/version={batch_id}")
        finally:
            batch.unpersist()
        for old in versions(spark, state)[:-2]:
            at = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/version={old}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

    writer = arriving.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
