"""Cells in two levels, for databases that need more centroids than a task can hold.

Top centroids are few and travel with every task. Each has its own leaf centroids, which stay a table:
rows, or queries, of a top cell meet its leaves in one task, a block of rows at a time, so a top
cell that holds most of the table is many tasks. A million cells are a thousand leaves in each of a
thousand top cells; of width 1,024 no task holds more than 8 MB of centroids.

A row lies in the nearest leaf of its nearest top cell. A query goes down a beam: it takes the leaves
of its nearest ``beam`` top cells and of those the ``nprobe`` nearest leaves. What lies beyond the beam is
not seen, so the join is approximate unless beam and probes take all cells.

Rows without a vector are in no cell; an empty database has no cells and gives no hits.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from twinshelf.kernels import to_matrix
from twinshelf.operators import centroids as fitting
from twinshelf.operators.ann import complete, knn_in_cells, nearest_cells, nearest_places, tuning_sample
from twinshelf.operators.knn import knn_join, top_k
from twinshelf.operators.rows import By, guard_groups
from twinshelf.operators.small import measured
from twinshelf.session import cut
from twinshelf.sources.tables import exists

# Centroids of one level that a task holds, and vectors of a block that meets them.
LEVEL_BYTES = 64 << 20
BLOCK_ROWS = 16_384
# Rows that a cell has on average if the number of cells is not given.
ROWS_PER_CELL = 256
TOPS = "top int, centroid array<double>"
LEAVES = "_top int, _cell int, _centroid array<double>"


def tree_shape(n_cells: int, width: int) -> tuple[int, int]:
    """Top cells and leaves of each, whose product is at least ``n_cells``; refused if a level is too large."""
    tops = max(1, math.isqrt(n_cells))
    leaves = max(1, math.ceil(n_cells / tops))
    if 8 * leaves * max(width, 1) > LEVEL_BYTES:
        most = (LEVEL_BYTES // (8 * width)) ** 2
        raise ValueError(f"two levels of {n_cells} cells of width {width} are too large; use at most {most}")
    return tops, leaves


@dataclass(frozen=True)
class CellTree:
    """Database vectors stored by top cell, and the centroids of both levels."""

    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        """The rows with their ``cell``."""
        # an empty database leaves no files that could tell the columns
        columns = self.spark.read.parquet(f"{self.path}/columns").schema
        return self.spark.read.schema(columns).parquet(f"{self.path}/rows").drop("_top")

    def leaves(self) -> DataFrame:
        return self.spark.read.schema(LEAVES).parquet(f"{self.path}/leaves")

    def tops(self) -> np.ndarray:
        stored = self.spark.read.schema(TOPS).parquet(f"{self.path}/tops")
        return np.array([r["centroid"] for r in stored.orderBy("top").collect()])


def block_rows_of(width: int) -> int:
    return max(1, min(BLOCK_ROWS, LEVEL_BYTES // (8 * max(width, 1))))


def beside_leaves(
    rows: DataFrame, leaves: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: T.StructType,
    block_rows: int,
) -> DataFrame:
    """``work`` on blocks of the rows of each ``_top`` and all leaves of that top cell.

    Rows are counted first and dealt to blocks by the hash of their columns; leaves are repeated once a block.
    """
    counts = rows.groupBy("_top").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_blocks"))
    blocks = measured(counts).for_join()
    own = F.pmod(F.xxhash64(*(c for c in rows.columns if c != "_top")), F.col("_blocks")).cast("int")
    left = rows.join(blocks, "_top").withColumn("_block", own).drop("_blocks")
    every = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    right = leaves.join(blocks, "_top").withColumn("_block", every).drop("_blocks")
    keys = ["_top", "_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)


def sorted_leaves(leaves: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    leaves = leaves.sort_by("_cell")
    return leaves["_cell"].to_numpy(), to_matrix(leaves["_centroid"])


def build_tree(
    db: DataFrame, path: str, *, vec: str, n_cells: int | None = None, max_iter: int = 10, seed: int = 7,
) -> CellTree:
    """Write ``db`` by top cell and leaf; a finished tree that is already there is used as it is.

    The top cells are fitted on a bounded weighted sample of all rows, the leaves of each top cell on a
    bounded sample of its own rows.
    """
    tree = CellTree(db.sparkSession, path)
    if exists(tree.spark, f"{path}/rows"):
        return tree
    n, width = db.where(F.col(vec).isNotNull()).agg(F.count(F.lit(1)), F.max(F.size(vec))).first()
    width = width or 1
    n_tops, n_leaves = tree_shape(n_cells or max(1, n // ROWS_PER_CELL), width)
    tops = fitting.fit(db, vec, n_tops, max_iter, seed) if n else np.empty((0, width))
    table = pa.table({"top": pa.array(range(len(tops)), pa.int32()),
                      "centroid": pa.array(tops.tolist(), pa.list_(pa.float64()))})
    tree.spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(f"{path}/tops")
    topped = db.withColumn("_top", F.explode(nearest_cells(tops, 1)(F.col(vec))))
    fit_leaves(topped, vec, n_leaves, width, max_iter, seed).write.mode("overwrite").parquet(f"{path}/leaves")

    schema = T.StructType([*db.schema.fields, T.StructField("_top", T.IntegerType()), T.StructField("cell", T.IntegerType())])
    names = [f.name for f in schema]
    tree.spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")

    def place(rows: pa.Table, leaves: pa.Table) -> pa.Table:
        cell, centroids = sorted_leaves(leaves)
        near = nearest_places(to_matrix(rows[vec]), centroids, 1)[:, 0] if rows.num_rows else np.empty(0, np.int64)
        return rows.append_column("cell", pa.array(cell[near], pa.int32())).select(names)

    placed = beside_leaves(topped, tree.leaves(), place, schema, block_rows_of(width))
    # sorted by leaf inside the files, so that a scan for some cells can pass over row groups
    dealt = placed.hint("rebalance", "_top").sortWithinPartitions("_top", "cell")
    dealt.write.mode("overwrite").partitionBy("_top").parquet(f"{path}/rows")
    return tree


def fit_leaves(topped: DataFrame, vec: str, n_leaves: int, width: int, max_iter: int, seed: int) -> DataFrame:
    """Leaf centroids of each ``_top``; a task sees a sample of bounded size, drawn by hash."""
    size = fitting.sample_size(n_leaves, width, 64)
    own = F.pmod(F.xxhash64(F.lit(seed), *(c for c in topped.columns if c != "_top")), F.lit(1 << 30)) / (1 << 30)
    drawn = topped.select("_top", F.col(vec).alias("_vec"), own.alias("_own"))
    counts = measured(drawn.groupBy("_top").agg(F.count(F.lit(1)).alias("_n"), F.min("_own").alias("_least"))).for_join()
    # one row at least, whatever the bound
    sample = drawn.join(counts, "_top").where((F.col("_own") < size / F.col("_n")) | (F.col("_own") == F.col("_least")))

    def fit(rows: pa.Table) -> pa.Table:
        points = to_matrix(rows["_vec"])
        found = fitting.weighted_means(points, np.ones(len(points)), n_leaves, max_iter, seed)
        top = rows["_top"][0].as_py()
        return pa.table({
            "_top": pa.array([top] * len(found), pa.int32()),
            "_cell": pa.array(range(top * n_leaves, top * n_leaves + len(found)), pa.int32()),
            "_centroid": pa.array(found.tolist(), pa.list_(pa.float64())),
        })

    return sample.select("_top", "_vec").groupBy("_top").applyInArrow(fit, LEAVES)


def cells_in_beam(
    q: DataFrame, tree: CellTree, tops: np.ndarray, keys: list[str], vec: str, beam: int, nprobe: int,
) -> DataFrame:
    """``keys`` and ``_cells``, numbers of the nearest leaves in the beam, nearest first."""
    asked = q.select(*keys, vec).withColumn("_top", F.explode(nearest_cells(tops, beam)(F.col(vec))))
    near = T.ArrayType(T.StructType([T.StructField("far", T.DoubleType()), T.StructField("cell", T.IntegerType())]))
    schema = T.StructType([*(q.schema[c] for c in keys), T.StructField("_near", near)])
    kind = to_arrow_schema(schema)

    def descend(rows: pa.Table, leaves: pa.Table) -> pa.Table:
        if not rows.num_rows or not leaves.num_rows:
            return kind.empty_table()
        cell, centroids = sorted_leaves(leaves)
        points = to_matrix(rows[vec])
        place = nearest_places(points, centroids, nprobe)
        far = np.empty(place.shape)
        for i in range(place.shape[1]):
            far[:, i] = ((points - centroids[place[:, i]]) ** 2).sum(axis=1)
        values = pa.StructArray.from_arrays(
            [pa.array(far.ravel()), pa.array(cell[place].ravel(), pa.int32())], ["far", "cell"]
        )
        offsets = pa.array(np.arange(len(points) + 1) * place.shape[1], pa.int32())
        return pa.table([*(rows[c] for c in keys), pa.ListArray.from_arrays(offsets, values)], names=kind.names)

    width = tops.shape[1] if len(tops) else 1
    found = beside_leaves(asked, tree.leaves(), descend, schema, block_rows_of(width))
    # a query has at most ``beam`` rows of ``nprobe`` leaves
    nearest = F.slice(F.sort_array(F.flatten(F.collect_list("_near"))), 1, nprobe)
    return found.groupBy(*keys).agg(F.transform(nearest, lambda x: x["cell"]).alias("_cells"))


def knn_tree(
    q: DataFrame, tree: CellTree, *, k: int, q_vec: str, db_vec: str, beam: int | None = None, nprobe: int | None = None,
    q_id: str = "q_id", db_id: str = "db_id", by: By = (), min_group_size: int = 1, block_rows: int = 16_384,
    exclude_self: bool = False, score: str = "score", target_recall: float = 0.95,
) -> DataFrame:
    """Top-k join against the ``nprobe`` nearest leaves in each query's beam of ``beam`` top cells.

    What is not given is chosen so that sampled queries find ``target_recall`` of their exact hits. A query
    with fewer hits than k, and than its group can give, gets its exact result.
    """
    q, db = guard_groups(q, tree.rows(), by, min_group_size)
    tops = tree.tops()
    names, keys = [n for _, _, n in by], [*(c for c, _, _ in by), q_id]
    common = dict(k=k, q_vec=q_vec, db_vec=db_vec, q_id=q_id, db_id=db_id,
                  block_rows=block_rows, exclude_self=exclude_self, score=score)
    if not len(tops):  # no rows, so no hits
        return knn_join(q, db, by=by, **common)
    if beam is None or nprobe is None:
        beam, nprobe = choose_probes(q, db, tree, tops, by, target_recall, common, beam, nprobe)
    near = cells_in_beam(q, tree, tops, keys, q_vec, beam, nprobe)
    # leaves of all top cells are numbered through
    n_cells = (tree.leaves().agg(F.max("_cell")).first()[0] or 0) + 1
    found = knn_in_cells(q.select(*keys, q_vec).join(near, keys), db, nprobe, n_cells, by, **common)
    return complete(top_k(found, [*names, q_id], k, score, db_id), q, db, by=by, **common)


def choose_probes(
    q: DataFrame, db: DataFrame, tree: CellTree, tops: np.ndarray, by: By, target_recall: float, common: dict,
    beam: int | None, nprobe: int | None,
) -> tuple[int, int]:
    """The least beam, and of its leaves the least number, that hold enough of sampled queries' exact hits."""
    q_id, db_id, q_vec = common["q_id"], common["db_id"], common["q_vec"]
    names, keys = [n for _, _, n in by], [*(c for c, _, _ in by), q_id]
    sample = tuning_sample(q, q_id, q_vec)
    hits = knn_join(sample, db, by=by, **common).select(*names, q_id, db_id)
    on = {**{n: c for _, c, n in by}, db_id: db_id}
    held = db.select(*[F.col(c).alias(f"_d_{n}") for n, c in on.items()], "cell")
    asked = sample.select(*[F.col(c).alias(f"_q_{c}") for c in keys], q_vec)
    same = [F.col(n) == F.col(f"_q_{c}") for n, c in zip([*names, q_id], keys)]
    # at most ``TUNING_QUERIES`` times k rows; the sample's own columns stay for the second step
    pairs = cut(
        hits.join(held, [F.col(n) == F.col(f"_d_{n}") for n in on]).join(asked, same)
        .join(tree.leaves().select("_top", F.col("_cell").alias("cell")), "cell")
        .select(*[F.col(f"_q_{c}").alias(c) for c in keys], q_vec, "_top", "cell")
    )
    local = pairs.select(q_vec, "_top").toArrow()
    if not local.num_rows:
        return beam or len(tops), nprobe or 1
    if beam is None:
        order = nearest_places(to_matrix(local[q_vec]), tops, len(tops))
        rank = (order == local["_top"].to_numpy()[:, None]).argmax(axis=1) + 1
        # the leaves lose hits as well, so the beam loses half of what may be lost
        beam = int(np.quantile(rank, (1 + target_recall) / 2, method="higher"))
    if nprobe is None:
        most = beam * tree.leaves().groupBy("_top").count().agg(F.max("count")).first()[0]
        near = cells_in_beam(sample, tree, tops, keys, q_vec, beam, most)
        place = F.array_position("_cells", F.col("cell"))
        ranks = pairs.join(near, keys).select(F.when(place > 0, place).otherwise(most).alias("rank")).toArrow()
        nprobe = int(np.quantile(ranks["rank"].to_numpy(), target_recall, method="higher"))
    return beam, nprobe
