"""Exact top-k join by inner product inside groups.

A side of at most one block is sent to every task, and the other side is scored
where it lies.  Otherwise every group is laid out as a grid: its query rows are
hashed into ``gq`` blocks, its database rows into ``gd`` blocks, and each of the
``gq * gd`` cells is one unit of work with a bounded number of rows on both sides.
A group that holds a third of the table becomes many cells, a small one is a single
cell.  A cell returns its k best rows per query, never its pairs; cells of the same
query are merged by rank.

In a grid every row is shuffled once for each block of the other side. Groups for which these would be many copies
are streamed instead: blocks are packed and stored once, and a task reads the stored database blocks of its group one after
the other beside a block of queries, which keep their k best rows so far. What is written grows with the rows, not with the pairs.

Where vectors are made from values such as names, rows of a group with equal values have equal scores:
each different value of the query side is encoded and scored once, against the k lowest ids of each different
value of the database side, and its hits are given to all its rows. Work does not grow with the copies.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from twinshelf.config import require_columns
from twinshelf.kernels import HITS_PER_TASK, ListedScorer, Scorer, packed
from twinshelf.operators.rows import group_sizes, guard_groups
from twinshelf.operators.small import Small, measured
from twinshelf.session import cut, scratch_path

# A side of at most so many rows (and one block) is sent to every task, whatever block size
# is asked for, if its vectors take no more bytes than that.
HELD_ROWS = 16_384
HELD_BYTES = 64 << 20
# With so few rows the width of the vectors is not looked at.
ROWS_SURELY_HELD = 1_024
# Group sizes too large to broadcast are joined by shuffle, each group spread over salts:
# one for so many rows of the larger side, within these bounds.
ROWS_PER_SALT = 1_000_000
SALTS = (64, 4096)
# Packed blocks of groups.
BLOCK_TABLE = "_g int, _b int, _block binary"
# Scored pairs per task: the lower value spreads small inputs over the cores, the
# upper one keeps tasks of large inputs in the range of seconds.
PAIRS_TO_SPREAD = 1_000_000
PAIRS_PER_TASK = 200_000_000
# A row is sent to so many blocks of the other side at most, as long as blocks of HELD_ROWS allow it.
MOST_COPIES = 8
# Blocks of the database that a task reads beside one block of queries; a group has so many times as many for
# each of at most ``MOST_COPIES`` slices, whose hits are merged.
BLOCKS_PER_SLICE = 128
# A streamed query side has as many blocks for each core, if these have so many rows.
STREAMS_PER_CORE, ROWS_PER_STREAM = 4, 4_096
# Copies are put together if at most this share of the pairs is left.
WORTH_PUTTING_TOGETHER = 0.5
# Spreading the scanned side over more tasks pays if each of its rows meets this many.
ROWS_WORTH_A_SHUFFLE = 1_000


def knn_join(
    q: DataFrame,
    db: DataFrame,
    *,
    k: int,
    q_vec: str,
    db_vec: str,
    q_id: str = "q_id",
    db_id: str = "db_id",
    by: Sequence[tuple[str, str, str]] = (),
    min_group_size: int = 1,
    block_rows: int = 16_384,
    exclude_self: bool = False,
    score: str = "score",
    q_more: Sequence[str] = (),
    db_more: Sequence[str] = (),
    scorer: Callable[..., Scorer] = Scorer,
    db_block_rows: int | None = None,
    brought: int = 0,
) -> DataFrame:
    """For each query row, its k best database rows in the same group.

    ``by`` lists ``(query column, database column, output column)``; without it
    all rows form one group.  Rows with a null in group, id or vector have no
    hits.  Ids are unique inside a group.  Ranking is by rounded score, then by
    database id; a group with fewer than k rows returns them all.  Another ``scorer``
    may leave pairs out; it gets the columns ``q_more`` and ``db_more`` as well.
    Blocks have ``block_rows`` rows, or more in groups with over ``MOST_COPIES`` such blocks; those of the
    database ``db_block_rows``, if given. A query block has fewer rows if these have over ``HITS_PER_TASK`` hits, or as many values
    that they bring along, where a query has ``brought`` of them.

    Returns the group columns, ``q_id``, ``db_id``, ``score`` and ``rank``.
    """
    require_columns(q, [c for c, _, _ in by] + [q_id, q_vec], "query side")
    require_columns(db, [c for _, c, _ in by] + [db_id, db_vec], "database side")
    names = [name for _, _, name in by]

    def side(df: DataFrame, keys: Sequence[str], row_id: str, vec: str, more: Sequence[str]) -> DataFrame:
        groups = [F.col(c).alias(n) for c, n in zip(keys, names)]
        return df.select(*groups, F.col(row_id).alias("_id"), F.col(vec).alias("_vec"), *more)

    q_rows = side(q, [c for c, _, _ in by], q_id, q_vec, q_more)
    db_rows = side(db, [c for _, c, _ in by], db_id, db_vec, db_more)

    schema = T.StructType([
        *[T.StructField(n, q_rows.schema[n].dataType) for n in names],
        T.StructField(q_id, q_rows.schema["_id"].dataType),
        T.StructField(db_id, db_rows.schema["_id"].dataType),
        T.StructField(score, T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
    ])
    score_cells = scorer(names, k, exclude_self, to_arrow_schema(schema))
    most = max(k, brought)

    sizes, total = group_totals(
        group_sizes(q_rows, db_rows, names, names, names, min_group_size), block_rows, db_block_rows, most
    )
    # Rows without id have no hits.  Null vectors are left to the scorer: a filter on
    # an encoder's output would make Spark run the encoder once more for the filter.
    q_rows, db_rows = (
        rows.where(F.col("_id").isNotNull() & F.lit(total.cells > 0)) for rows in (q_rows, db_rows)
    )
    if total.n_db <= min(block_rows, HELD_ROWS) and fits_tasks(db_rows, total.n_db):
        # every query meets all its rows in one task, so ranks are final
        return scan_against(q_rows, db_rows, sizes, total, score_cells, schema, held_is_db=True)
    few = total.n_q <= min(block_rows, HELD_ROWS) and total.n_q * min(most, total.n_db) <= HITS_PER_TASK
    if few and fits_tasks(q_rows, total.n_q):
        hits = scan_against(db_rows, q_rows, sizes, total, score_cells, schema, held_is_db=False)
        return top_k(hits, [*names, q_id], k, score, db_id)
    layout = Layout(block_rows, db_block_rows, most)

    def merged(hits: DataFrame, blocks: int) -> DataFrame:
        # with one database block, or slice, per group the rank inside the cell is final
        return top_k(hits, [*names, q_id], k, score, db_id) if blocks > 1 else hits

    large = large_groups(sizes, total, names, layout)
    found = []
    if large:
        if len(large) < total.groups:
            # both ways read the rows, which an encoder may make
            q_rows, db_rows = cut(q_rows), cut(db_rows)
        numbered = number_groups(q.sparkSession, large, names, q_rows)
        hits = score_streams(q_rows, db_rows, numbered, large, score_cells, schema)
        found.append(merged(hits, max(g.slices for g in large)))
        if len(large) == total.groups:
            return found[0]
        others = sizes.frame.join(F.broadcast(numbered), names, "left_anti")
        sizes, total = group_totals(others, block_rows, db_block_rows, most)
        # streamed groups have no place in the grid, so their rows don't reach it
        q_rows, db_rows = (rows.join(F.broadcast(numbered.select(*names)), names, "left_anti") for rows in (q_rows, db_rows))
    hits = score_grid(q_rows, db_rows, sizes, total, score_cells, schema, layout)
    found.append(merged(hits, total.gd))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def knn_join_values(
    q: DataFrame, db: DataFrame, *, k: int, q_value: str, db_value: str, vectors: Callable[[Column], Column],
    q_id: str = "q_id", db_id: str = "db_id", by: Sequence[tuple[str, str, str]] = (), min_group_size: int = 1,
    block_rows: int = 16_384, exclude_self: bool = False, score: str = "score",
) -> DataFrame:
    """:func:`knn_join` of the ``vectors`` that are made from a value of each row.

    If both sides are larger than a block, their values are counted; equal ones are scored once if that
    saves half of the pairs. With ``exclude_self`` each row has its own hits, so all are scored.
    """
    names = [n for _, _, n in by]
    common = dict(k=k, q_vec="_vec", db_vec="_vec", block_rows=block_rows, score=score)

    def side(df: DataFrame, keys: Sequence[str], row_id: str, value: str) -> DataFrame:
        groups = [F.col(c).alias(n) for c, n in zip(keys, names)]
        rows = df.select(*groups, F.col(row_id).alias("_id"), F.col(value).alias("_value"))
        return rows.where(F.col("_id").isNotNull())

    q_rows, db_rows = side(q, [c for c, _, _ in by], q_id, q_value), side(db, [c for _, c, _ in by], db_id, db_value)
    found = F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*names, "_value"))
    (n_q, values), (n_db, db_values) = (
        (None, None) if exclude_self else rows.agg(*found).first() for rows in (q_rows, db_rows)
    )
    few = exclude_self or min(n_q, n_db) <= min(block_rows, HELD_ROWS)
    if few or values * min(k * db_values, n_db) > WORTH_PUTTING_TOGETHER * n_q * n_db:
        return knn_join(
            q.withColumn("_vec", vectors(F.col(q_value))), db.withColumn("_vec", vectors(F.col(db_value))), by=by,
            q_id=q_id, db_id=db_id, min_group_size=min_group_size, exclude_self=exclude_self, **common,
        )
    by_name = [(n, n, n) for n in names]
    # the size of a group counts rows, not values
    q_rows, db_rows = guard_groups(q_rows, db_rows, by_name, min_group_size)
    valued = present_in(names, "_value")
    q_rows, db_rows = (rows.where(valued) for rows in (q_rows, db_rows))
    same = [*names, "_value"]
    # numbered once they are stored; ids may be repeated
    asked = cut(q_rows.select(*same).distinct()).withColumn("_asked", F.monotonically_increasing_id())
    # however few files the table has, a task sorts a bounded number of rows
    db_rows = db_rows.repartition(math.ceil(n_db * k / HITS_PER_TASK), "_id")
    lowest = Window.partitionBy(*same).orderBy("_id")
    kept = db_rows.withColumn("_n", F.row_number().over(lowest)).where(F.col("_n") <= k).drop("_n")
    hits = knn_join(
        asked.withColumn("_vec", vectors(F.col("_value"))), kept.withColumn("_vec", vectors(F.col("_value"))),
        by=by_name, q_id="_asked", db_id="_id", **common,
    )
    # at most k of them
    hits = hits.groupBy("_asked").agg(F.collect_list(F.struct(F.col("_id").alias(db_id), score, "rank")).alias("_hits"))
    hits = asked.join(hits, "_asked").select(*same, "_hits")
    tasks = math.ceil(n_q * k / HITS_PER_TASK)
    given = q_rows.repartition(tasks, "_id").join(hits, same).select(
        *names, F.col("_id").alias(q_id), F.explode("_hits").alias("_hit")
    )
    return given.select(*names, q_id, *[F.col("_hit")[c].alias(c) for c in (db_id, score, "rank")])


def knn_listed(q: DataFrame, db: DataFrame, listed: str, most: int, **args) -> DataFrame:
    """:func:`knn_join` among the rows whose ids a query has in its list ``listed`` of at most about ``most``."""
    # counted and read
    asked = cut(q.withColumnRenamed(listed, "_listed"))
    return knn_join(asked, db, q_more=["_listed"], scorer=ListedScorer, brought=most, **args)


def present_in(names: Sequence[str], value: str) -> Column:
    """Whether a row has a value and a group."""
    condition = F.col(value).isNotNull()
    for n in names:
        condition = condition & F.col(n).isNotNull()
    return condition


def fits_tasks(rows: DataFrame, n: int) -> bool:
    """Whether ``n`` vectors as wide as the first one take few enough bytes."""
    if n <= ROWS_SURELY_HELD:
        return True
    first = rows.select(F.size("_vec")).first()
    return 4 * n * max(first[0] or 0, 1) <= HELD_BYTES if first else True


@dataclass(frozen=True)
class Totals:
    """Rows, cells and pairs of all groups; ``gd`` is the most blocks of a group."""

    n_q: int
    n_db: int
    gd: int
    cells: int
    pairs: float
    groups: int

    def tasks(self, cores: int) -> int:
        """Work grows with pairs, not with bytes, so Spark cannot tell."""
        spread = min(cores, math.ceil(self.pairs / PAIRS_TO_SPREAD))
        return max(1, spread, math.ceil(self.pairs / PAIRS_PER_TASK))


def blocks(n: Column, block_rows: int) -> Column:
    """Blocks of a group of ``n`` rows: of ``block_rows``, but no more than ``MOST_COPIES`` unless these
    would have over ``HELD_ROWS`` rows."""
    fewest = F.greatest(F.ceil(n / HELD_ROWS), F.lit(MOST_COPIES))
    return F.least(F.ceil(n / block_rows), fewest).cast("int")


def blocks_of(n: np.ndarray, block_rows: int) -> np.ndarray:
    return np.minimum(-(-n // block_rows), np.maximum(-(-n // HELD_ROWS), MOST_COPIES))


@dataclass(frozen=True)
class Layout:
    """Blocks of both sides of a group; the same as columns and as numbers."""

    block_rows: int
    db_block_rows: int | None
    k: int

    def columns(self, n_q: Column, n_db: Column) -> tuple[Column, Column]:
        hits = F.ceil(n_q.cast("double") * F.least(F.lit(self.k), n_db) / HITS_PER_TASK).cast("int")
        gd = blocks(n_db, self.block_rows) if self.db_block_rows is None else F.ceil(n_db / self.db_block_rows).cast("int")
        return F.greatest(blocks(n_q, self.block_rows), hits), gd

    def numbers(self, n_q: np.ndarray, n_db: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hits = np.ceil(n_q.astype(float) * np.minimum(self.k, n_db) / HITS_PER_TASK).astype(np.int64)
        gd = blocks_of(n_db, self.block_rows) if self.db_block_rows is None else -(-n_db // self.db_block_rows)
        return np.maximum(blocks_of(n_q, self.block_rows), hits), gd


def group_totals(
    sizes: DataFrame, block_rows: int, db_block_rows: int | None = None, k: int = 1,
) -> tuple[Small, Totals]:
    """Group sizes, computed once, and their totals."""
    layout = Layout(block_rows, db_block_rows, k)
    small = measured(sizes)
    if small.rows is not None:
        q, db = (small.rows[n].to_numpy() for n in ("n_q", "n_db"))
        gq, gd = layout.numbers(q, db)
        return small, Totals(int(q.sum()), int(db.sum()), int(gd.max(initial=0)),
                             int((gq * gd).sum()), float((q.astype(float) * db).sum()), len(q))
    gq, gd = (n.cast("long") for n in layout.columns(F.col("n_q"), F.col("n_db")))
    row = small.frame.agg(
        F.sum("n_q"), F.sum("n_db"), F.max(gd), F.sum(gq * gd),
        F.sum(F.col("n_q").cast("double") * F.col("n_db")), F.count(F.lit(1)),
    ).first()
    return small, Totals(*(value or 0 for value in row))


def scan_against(
    scanned: DataFrame, held: DataFrame, sizes: Small, total: Totals, scorer: Scorer,
    schema: T.StructType, held_is_db: bool,
) -> DataFrame:
    """Score one side, where it lies, against the other, sent to every task.

    Only for a held side of at most one block, all groups together.  A held query side
    gives k rows per query and task.
    """
    names = scorer.keys
    if names:
        held = held.join(sizes.for_join(), names, "left_semi")
    spark = scanned.sparkSession
    table = spark.sparkContext.broadcast(held.toArrow())
    tasks = total.tasks(spark.sparkContext.defaultParallelism)
    if tasks > 1 and (total.n_db if held_is_db else total.n_q) >= ROWS_WORTH_A_SHUFFLE:
        scanned = scanned.repartition(tasks)
    return scanned.mapInArrow(scorer.against(table, held_is_db), schema)


def score_grid(
    q_rows: DataFrame, db_rows: DataFrame, sizes: Small, total: Totals, scorer: Scorer,
    schema: T.StructType, layout: Layout,
) -> DataFrame:
    """Score every query block of a group with every database block of it."""
    names = scorer.keys
    gq, gd = layout.columns(F.col("n_q"), F.col("n_db"))
    grid = sizes.frame.select(*names, gq.alias("gq"), gd.alias("gd"))
    salts = min(max(SALTS[0], max(total.n_q, total.n_db) // ROWS_PER_SALT), SALTS[1])
    one = [int(n) for n in layout.numbers(np.array(total.n_q), np.array(total.n_db))]
    cores = q_rows.sparkSession.sparkContext.defaultParallelism
    tasks = min(total.tasks(cores), total.cells)
    cell = [*names, "_qb", "_db"]

    def laid_out(rows: DataFrame, own: str, own_blocks: str, other: str, other_blocks: str):
        copies = F.sequence(F.lit(0), F.col(other_blocks) - 1)
        if names and sizes.fits:
            rows = rows.join(F.broadcast(grid), names)
        elif names:
            salted = grid.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            salt = F.pmod(F.xxhash64(F.lit("salt"), "_id"), F.lit(salts)).cast("int")
            rows = rows.withColumn("_salt", salt).join(salted, [*names, "_salt"])
        else:
            rows = rows.withColumns({"gq": F.lit(one[0]), "gd": F.lit(one[1])})
        rows = (
            rows.withColumn(own, F.pmod(F.xxhash64("_id"), F.col(own_blocks)).cast("int"))
            .withColumn(other, F.explode(copies))
            .drop("gq", "gd", "_salt")
        )
        return rows.repartition(tasks, *cell) if tasks > 1 else rows

    q_cells = laid_out(q_rows, "_qb", "gq", "_db", "gd")
    db_cells = laid_out(db_rows, "_db", "gd", "_qb", "gq")

    return (
        q_cells.groupBy(*cell)
        .cogroup(db_cells.groupBy(*cell))
        .applyInArrow(scorer.cell(), schema)
    )


@dataclass(frozen=True)
class LargeGroup:
    """A group that is streamed: its key, and its blocks on both sides."""

    key: tuple
    q_blocks: int
    db_blocks: int
    slices: int


def copied_too_often(layout: Layout) -> Column:
    """Whether the rows of a group of ``n_q`` and ``n_db`` rows are copied more than ``MOST_COPIES`` times in a grid."""
    gq, gd = layout.columns(F.col("n_q"), F.col("n_db"))
    copies = F.col("n_q").cast("double") * gd + F.col("n_db").cast("double") * gq
    return copies > MOST_COPIES * (F.col("n_q").cast("double") + F.col("n_db"))


def large_groups(sizes: Small, total: Totals, names: Sequence[str], layout: Layout) -> list[LargeGroup]:
    """Groups that are streamed; each has more than ``MOST_COPIES`` blocks, so they are few beside the rows."""
    # ids that are repeated have hits of their own where a group has one block of vectors
    if total.cells <= MOST_COPIES or (total.gd <= 1 and layout.db_block_rows is None):
        return []
    found = sizes.frame.where(copied_too_often(layout)).select(*names, "n_q", "n_db").collect()
    cores = sizes.frame.sparkSession.sparkContext.defaultParallelism
    large = []
    for row in found:
        n_q, n_db = row["n_q"], row["n_db"]
        spread = min(STREAMS_PER_CORE * cores, n_q // ROWS_PER_STREAM)
        hits = math.ceil(n_q * min(layout.k, n_db) / HITS_PER_TASK)
        db_blocks = math.ceil(n_db / HELD_ROWS)
        slices = min(MOST_COPIES, math.ceil(db_blocks / BLOCKS_PER_SLICE))
        large.append(LargeGroup(tuple(row[n] for n in names), max(math.ceil(n_q / HELD_ROWS), spread, hits), db_blocks, slices))
    return large


def number_groups(spark: SparkSession, large: Sequence[LargeGroup], names: Sequence[str], rows: DataFrame) -> DataFrame:
    """The large groups with their numbers, and the blocks of both sides."""
    fields = [T.StructField(n, rows.schema[n].dataType) for n in names]
    fields += [T.StructField(n, T.IntegerType()) for n in ("_g", "gq", "gd")]
    data = [(*g.key, i, g.q_blocks, g.db_blocks) for i, g in enumerate(large)]
    return spark.createDataFrame(data, T.StructType(fields))


def score_streams(
    q_rows: DataFrame, db_rows: DataFrame, numbered: DataFrame, large: Sequence[LargeGroup],
    scorer: Scorer, schema: T.StructType,
) -> DataFrame:
    """Score every query block of the large groups with all database blocks of its group, read one after the other.

    Each group is a product of partitions: one for each query block, and one for each slice of the database.
    """
    spark = q_rows.sparkSession
    names = scorer.keys

    def stored(rows: DataFrame, blocks: str, n: int) -> DataFrame:
        """Number of group and block, and the packed rows; each block is a file, so that none is read with others."""
        if names:
            rows = rows.join(F.broadcast(numbered), names)
        else:
            rows = rows.crossJoin(F.broadcast(numbered))
        rows = rows.withColumn("_b", F.pmod(F.xxhash64("_id"), F.col(blocks)).cast("int")).drop("gq", "gd")
        path = scratch_path(spark, "blocks")
        in_blocks = rows.repartition(n, "_g", "_b").groupBy("_g", "_b").applyInArrow(pack_block, BLOCK_TABLE)
        in_blocks.write.option("maxRecordsPerFile", 1).parquet(path)
        return spark.read.schema(BLOCK_TABLE).parquet(path)

    q_blocks = stored(q_rows, "gq", sum(g.q_blocks for g in large))
    db_blocks = stored(db_rows, "gd", sum(g.db_blocks for g in large))
    hits = []
    for number, group in enumerate(large):
        queries = q_blocks.where(F.col("_g") == number).select(F.col("_b").alias("_qb"), F.col("_block").alias("_q"))
        rows = db_blocks.where(F.col("_g") == number).select(F.col("_b"), F.col("_block").alias("_db"))
        queries = queries.repartitionById(group.q_blocks, "_qb")
        rows = rows.repartitionById(group.slices, F.col("_b") % group.slices).drop("_b")
        # the side on the right is held, one block a task; that on the left goes by
        pairs = rows.hint("shuffle_replicate_nl").crossJoin(queries)
        hits.append(pairs.mapInArrow(scorer.streamed(), schema))
    return functools.reduce(DataFrame.unionByName, hits)


def pack_block(key: tuple, rows: pa.Table) -> pa.Table:
    """One row with all rows of a block."""
    number, block = key
    return pa.table({"_g": pa.array([number.as_py()], pa.int32()), "_b": pa.array([block.as_py()], pa.int32()),
                     "_block": pa.array([packed(rows.drop_columns(["_g", "_b"]))], pa.binary())})


def top_k(hits: DataFrame, keys: Sequence[str], k: int, score: str, tie: str) -> DataFrame:
    """The k best hits per key.  Spark cuts to k before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(score), F.asc(tie))
    ranked = hits.withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= k)


def with_payload(
    hits: DataFrame, side: DataFrame, on: dict[str, str], columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Attach chosen columns of a side to its hits by key (never by position).

    ``on`` maps columns of ``hits`` to columns of ``side``.  A row that is a hit of
    very many queries makes a skewed key; keys of ``side`` are unique, so Spark's
    adaptive skew join can split the hits of such a key over tasks.
    """
    names = {c: f"_p_{i}" for i, c in enumerate(on.values())}
    payload = side.select(*[F.col(c).alias(n) for c, n in names.items()],
                          *[c for c in columns if c not in hits.columns])
    condition = [F.col(h) == F.col(names[s]) for h, s in on.items()]
    return hits.join(payload, condition, how).drop(*names.values())
