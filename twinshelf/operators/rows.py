"""Row numbering, limits, deduplication and group guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinshelf.operators.small import Small, measured
from twinshelf.session import cut

# (query column, database column, output column) of each grouping column
By = Sequence[tuple[str, str, str]]

# Up to here every task may keep its own n first rows and send them to one
# merging task; above it rows are numbered in place instead.
MERGE_LIMIT = 1_000


def row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Dense index 0, 1, 2, … in the order of ``order``.

    Rows that are equal in ``order`` are told apart by a hash of all columns, so
    that a value with many rows can be spread over several partitions.

    Rows are range-partitioned and sorted, and numbered inside their partition.
    The only thing gathered is one row count per partition.  The numbered rows
    are checkpointed first: range bounds are sampled, so a partition computed
    twice could otherwise disagree with the counts.
    """
    local = cut(
        df.withColumn("_tie", F.xxhash64(*df.columns))
        .repartitionByRange(*order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        # partition number in the upper 31 bits, position inside it in the lower 33
        .withColumn("_local", F.monotonically_increasing_id())
    )
    part = F.shiftright("_local", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        local.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_local") - F.shiftleft(F.col("_part"), 33)
    # offsets has one row per partition, so it is always small enough to broadcast
    return (
        local.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position)
        .drop("_local", "_part", "_offset")
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order of ``order``, then of a hash of all columns."""
    if n <= MERGE_LIMIT:
        tied = df.withColumn("_tie", F.xxhash64(*df.columns))
        return tied.orderBy(*order, "_tie").limit(n).drop("_tie")
    return row_index(df, order, "_row").where(F.col("_row") < n).drop("_row")


def last_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows in that order, and returned in it."""
    if n <= MERGE_LIMIT:
        tied = df.withColumn("_tie", F.xxhash64(*df.columns))
        last = tied.orderBy(*[F.desc(c) for c in (*order, "_tie")]).limit(n)
        return last.orderBy(*order, "_tie").drop("_tie")
    indexed = row_index(df, order, "_row")
    size = indexed.agg(F.max("_row") + 1).scalar()
    return indexed.where(F.col("_row") >= size - n).orderBy("_row").drop("_row")


def batch_number(index: Column, size: int) -> Column:
    """Fixed-size batch of a dense index; n rows make ceil(n / size) batches."""
    return F.floor(index / size)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order`` (nulls first), then by the rest.

    A minimum over a struct is combined before the shuffle, so a key that holds a
    large share of the rows reaches the reducer as one row per task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    first = df.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*key, "_first.*").select(*df.columns)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def categories(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    named = df.select(F.col(column).alias("category"))
    return named.where("category IS NOT NULL").distinct().orderBy("category")


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a null in ``columns``; each condition can reach the scan."""
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def group_sizes(
    q: DataFrame, db: DataFrame, q_keys: Sequence[str], db_keys: Sequence[str],
    names: Sequence[str], min_rows: int = 1,
) -> DataFrame:
    """Row counts per group on both sides, for groups large enough on both.

    One pass over the key columns of either side; counts are combined before the
    shuffle, so group skew does not matter.
    """

    def side(df: DataFrame, keys: Sequence[str], in_q: int) -> DataFrame:
        named = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
        named = present(named, names)
        return named.select(*names, F.lit(in_q).alias("_q"), F.lit(1 - in_q).alias("_db"))

    both = side(q, q_keys, 1).unionByName(side(db, db_keys, 0))
    sizes = both.groupBy(*names).agg(F.sum("_q").alias("n_q"), F.sum("_db").alias("n_db"))
    return sizes.where((F.col("n_q") >= min_rows) & (F.col("n_db") >= min_rows))


def matching(
    df: DataFrame, keys: DataFrame | Small, on: dict[str, str], how: str = "left_semi"
) -> DataFrame:
    """Rows whose key is (``left_semi``) or is not (``left_anti``) in ``keys``.

    ``on`` maps columns of ``df`` to columns of ``keys``, which may share a source.
    """
    names = {k: f"_key{i}" for i, k in enumerate(on.values())}
    broadcast = isinstance(keys, Small) and keys.fits
    frame = keys.frame if isinstance(keys, Small) else keys
    right = frame.select(*[F.col(k).alias(n) for k, n in names.items()])
    if broadcast:
        right = F.broadcast(right)
    return df.join(right, [F.col(c) == F.col(names[k]) for c, k in on.items()], how)


def guard_groups(
    q: DataFrame, db: DataFrame, by: By, min_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Keep only groups with at least ``min_rows`` rows on both sides."""
    if not by or min_rows <= 1:
        return q, db
    names = [n for _, _, n in by]
    sizes = group_sizes(q, db, [c for c, _, _ in by], [c for _, c, _ in by], names, min_rows)
    groups = measured(sizes.select(*names))
    q = matching(q, groups, {c: n for c, _, n in by})
    db = matching(db, groups, {c: n for _, c, n in by})
    return q, db


def latest_snapshot(df: DataFrame, version: str) -> DataFrame:
    """All rows that carry the highest version.

    The scalar subquery becomes a pushed-down Parquet filter, and prunes
    partitions when the table is partitioned by its version.
    """
    return df.where(F.col(version) == df.select(F.max(version)).scalar())
