"""Exact deduplication by a stateful stream over digests.

Texts are equal if they agree after all white space (blank, tab, line feed, vertical tab,
form feed, carriage return) is deleted. Of equal texts the one with the most code points
in the original text stays, then the one with the smallest id.

One narrow pass turns each row into (digest, id, code points, content locator). These
rows arrive as a stream; a keyed state without expiry, kept on disk by the RocksDB state
store, holds for each digest the stable id and the locator of the row that stays, and
the number of rows seen. The stream aggregates before its shuffle, so a digest that a
third of the rows share is one row per task there. Equal digests are then held against
each other byte by byte; a difference stops the job.

Everything is a DataFrame or SQL operation; no Python runs on the executors.

Cases: a null text counts as empty, and all empty texts are equal; a null id is smaller
than any other; rows with the same id and text are one document, so each of them is
reported as kept if one is, and ``drop_duplicates`` leaves one of them; an empty table gives
an empty result; other columns are ignored here and kept by ``drop_duplicates``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.llm.common import SPACE, stored, table
from twinshelf.session import scratch_path

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # no space is claimed ahead of need, or each state partition would take 4 MB at once
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # all state partitions of an executor share one cache and one write buffer; without a bound each has its own
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "192",
}


def normalised(text_col: str) -> Column:
    return F.translate(F.coalesce(F.col(text_col), F.lit("")), SPACE, "")


def digests_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Digest, id, code points and the file that holds the text, for each row."""
    return docs.select(
        F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"),
        F.col(id_col).alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("points"),
        F.input_file_name().alias("locator"),
    )


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """The settings of the state store, for the stream and for reading its state."""
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stream_state(arrivals: DataFrame, path: str) -> DataFrame:
    """The final state of the stream over the files in ``path``: one row per digest."""
    spark = arrivals.sparkSession
    state = scratch_path(spark, "digest-state")
    best = F.min(F.struct((-F.col("points")).alias("rank"), "id", "locator")).alias("best")
    stream = (
        spark.readStream.schema(arrivals.schema).parquet(path)
        .groupBy("digest").agg(best, F.count("*").alias("size"))
    )
    query = (
        stream.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
        .option("checkpointLocation", state).start()
    )
    query.awaitTermination()
    held = spark.read.format("statestore").load(state)
    # the state's value has one field per aggregate: the least struct, then the count
    best, size = (f"value.`{name}`" for name in held.schema["value"].dataType.names)
    return held.select(
        F.col("key.digest").alias("digest"),
        F.col(f"{best}.id").alias("keep_id"),
        (-F.col(f"{best}.rank")).alias("keep_points"),
        F.col(f"{best}.locator").alias("keep_locator"),
        F.col(size).alias("size"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: ``id``, ``digest``, ``points``, and of its group ``keep_id``,
    ``keep_points``, ``keep_locator`` and ``size``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "digests")
    digests_of(docs, id_col, text_col).write.parquet(path)
    arrivals = spark.read.parquet(path)
    if not arrivals.take(1):
        kind = arrivals.schema["id"].dataType
        return arrivals.drop("locator").withColumns({
            "keep_id": F.lit(None).cast(kind), "keep_points": F.lit(0),
            "keep_locator": F.lit(""), "size": F.lit(0).cast("long"),
        })
    with state_on_disk(spark):
        groups = stored(stream_state(arrivals, path), "digest-groups")
    check_bytes(docs, groups, id_col, text_col)
    return arrivals.drop("locator").join(groups, "digest")


def check_bytes(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> None:
    """Compare the full bytes of every text with those of the text that stays for it."""
    hits = stored(
        docs.select(
            F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"),
            F.col(id_col).alias("id"),
            F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("points"),
            normalised(text_col).alias("body"),
        ).join(groups.filter("size > 1").select("digest", "keep_id", "keep_points"), "digest"),
        "digest-hits",
    )
    # one line a digest, however often the row that stays is repeated; written, so that the join has
    # no aggregate on this side and a hot digest can be split
    staying = stored(
        hits.filter(F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points")))
        .select("digest", F.col("body").alias("kept_body")).dropDuplicates(["digest"]),
        "digest-staying",
    )
    unequal = hits.join(staying, "digest").filter("body <> kept_body")
    if unequal.take(1):
        raise ValueError("two texts of one digest differ: choose a longer digest")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that another row stands for; all columns as they are."""
    groups = exact_groups(docs, id_col, text_col)
    staying = groups.filter(
        F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    ).groupBy("digest", "id").count()
    stays = staying.select(F.col("digest").alias("__stay_digest"), F.col("id").alias("__stay_id"))
    marked = docs.withColumn("__digest", F.unhex(F.sha2(normalised(text_col), 256)))
    found = marked.join(
        stays,
        (F.col("__digest") == F.col("__stay_digest")) & F.col(id_col).eqNullSafe(F.col("__stay_id")),
        "left_semi",
    )
    # only where a document that stays is there in several rows are texts compared once more
    if staying.filter("count > 1").take(1):
        found = found.dropDuplicates(["__digest"])
    return found.select(*docs.columns)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document, and whether it stays."""
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("size").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


QUERIES: list[Callable] = [op10_exact_dedup]

ORACLES = {
    "op10_exact_dedup": r"""
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS points,
                 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
          FROM documents
        ), g AS (
          SELECT doc_id, text_sha256,
                 first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
                 count(*) OVER (PARTITION BY text_sha256) AS group_size
          FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
    """,
}
