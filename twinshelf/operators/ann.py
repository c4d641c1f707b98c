"""Top-k joins that compare a query only with rows of buckets near to it.

Both forms reduce to :func:`knn_join` with the bucket as one more group column,
so a bucket that holds a large share of the rows is cut into a grid like any
other group.

*Cells* are those of centroids. A query takes its nearest cells first; after that it goes on,
in the order of a bound, through cells that may still hold a better row: no row of a cell with
centroid c and radius r scores more than q·c + |q| r. With ``exact`` every query goes on until no
cell is left whose bound reaches its k-th score, so nothing is missed and cells far away are never
read; otherwise only queries with too few hits do. Where the cells that queries take are a good share of all cells,
pairs meet once in a grid instead of once a cell, and those of other cells are left out there.

*Planes* are sign bits. A query takes, in each table, the buckets that its vector is nearest to
leaving its own: those whose flipped bits have the least sum of squared margins. Where the probes of all tables
are a good share of the buckets, pairs meet once in a grid, and those out of reach are left out there.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.kernels import CellScorer, ProbeScorer, ReachScorer, least_sums, to_matrix
from twinshelf.operators import centroids as fitting
from twinshelf.operators.knn import MOST_COPIES, knn_join, top_k
from twinshelf.operators.rows import By, guard_groups, matching
from twinshelf.operators.small import measured
from twinshelf.session import cut
from twinshelf.sources.tables import exists

# Centroids travel with every task; more than this is refused.
CENTROID_BYTES = 512 << 20
# Distances of some rows to all centroids that a task holds at once.
DISTANCE_BYTES = 32 << 20
# Queries whose exact hits decide how much is probed, and rows of a table without a set number of cells.
TUNING_QUERIES = 200
# A score is rounded; a row that rounds to the k-th score may be this much below it.
ROUNDING, COARSE_ROUNDING = 1.1e-5, 0.11
MOST_TABLES, MOST_BITS = 16, 20
# Sums of margins of some rows that a task holds at once.
SUM_BYTES = 512 << 10
# A matrix product of all pairs costs less than the pairs of the probed buckets if these are such a share, tables added up.
DENSE_SHARE = 0.125
CENTROIDS = "cell int, centroid array<double>, n_cells int"
# Cells that a query goes on to at once; every further step takes four times as many.
FIRST_STEP = 4


def matrix_udf(fn: Callable[[np.ndarray], np.ndarray]) -> Callable[[Column], Column]:
    """Row-wise ``fn`` on Arrow batches: (rows, width) floats in, (rows, n) ints out.

    A null vector gives null, which ``explode`` drops.
    """

    @F.arrow_udf("array<int>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            valid = vectors.is_valid().to_numpy(zero_copy_only=False)
            if not valid.any():
                yield pa.nulls(len(vectors), pa.list_(pa.int32()))
                continue
            out = fn(to_matrix(vectors.drop_null())).astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(valid * out.shape[1])]).astype(np.int32)
            yield pa.ListArray.from_arrays(offsets, pa.array(out.ravel()), mask=pa.array(~valid))

    # see batch_encoder: keeps Spark from evaluating it again in derived filters
    return apply.asNondeterministic()


def nearest_cells(centroids: np.ndarray, n: int) -> Callable[[Column], Column]:
    """Numbers of the ``n`` nearest centroids, nearest first.

    Rows are taken so many at a time that their distances stay under ``DISTANCE_BYTES``,
    and only the n nearest are put in order.
    """
    return matrix_udf(lambda vectors: nearest_places(vectors, centroids, n))


def nearest_places(vectors: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    centroids = np.asarray(centroids, dtype=np.float64)
    half_norms = (centroids**2).sum(axis=1) / 2
    n = min(n, len(centroids))
    rows = max(1, DISTANCE_BYTES // (8 * max(len(centroids), 1)))
    out = np.empty((len(vectors), n), dtype=np.int64)
    for at in range(0, len(vectors) if n else 0, rows):
        # argmin |x - c|² = argmin (|c|²/2 - x·c)
        distance = half_norms - vectors[at:at + rows] @ centroids.T
        near = np.sort(np.argpartition(distance, n - 1, axis=1)[:, :n], axis=1)
        order = np.argsort(np.take_along_axis(distance, near, axis=1), axis=1, kind="stable")
        out[at:at + rows] = np.take_along_axis(near, order, axis=1)
    return out


def in_reach(
    vectors: pa.Array, kth: pa.Array, centroids: np.ndarray, radii: np.ndarray, nprobe: int,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of the valid rows: their numbers, how many cells they go on to, and all cells in the order of bounds."""
    valid = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
    if not len(valid) or not len(centroids):
        return
    points = to_matrix(vectors.drop_null())
    floor = kth.to_numpy(zero_copy_only=False).astype(np.float64)[valid]
    floor = floor - np.where(floor > 1, COARSE_ROUNDING, ROUNDING)
    step = max(1, DISTANCE_BYTES // (16 * len(centroids)))
    for at in range(0, len(points), step):
        part = points[at:at + step]
        near = nearest_places(part, centroids, nprobe)
        bounds = part @ centroids.T + np.linalg.norm(part, axis=1)[:, None] * radii
        np.put_along_axis(bounds, near, -np.inf, axis=1)
        # a null k-th score is nan, below which nothing is
        bounds[bounds < floor[at:at + step, None]] = -np.inf
        yield valid[at:at + step], np.isfinite(bounds).sum(axis=1), np.argsort(-bounds, axis=1, kind="stable")


def further_cells(
    centroids: np.ndarray, radii: np.ndarray, nprobe: int, start: int, stop: int,
) -> Callable[[Column, Column], Column]:
    """Cells, of all but the ``nprobe`` nearest, that may hold a row to beat ``kth``.

    They come in the order of their bounds, the ``start``-th to the ``stop``-th of them; a
    null ``kth`` lets every cell in. A last element below 0 tells how many more would follow.
    """
    centroids = np.asarray(centroids, dtype=np.float64)

    @F.arrow_udf("array<int>")
    def apply(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for vectors, kth in batches:
            out: list[list[int] | None] = [None] * len(vectors)
            for some, counts, order in in_reach(vectors, kth, centroids, radii, nprobe):
                for row, n, cells in zip(some, counts.tolist(), order):
                    taken = cells[start:min(stop, n)].tolist()
                    out[row] = [*taken, stop - n] if n > stop else taken
            yield pa.array(out, pa.list_(pa.int32()))

    return apply.asNondeterministic()


def all_further_cells(
    centroids: np.ndarray, radii: np.ndarray, nprobe: int, start: int,
) -> Callable[[Column, Column], Column]:
    """All the cells of :func:`further_cells` from the ``start``-th on, as one bit for each cell."""
    centroids = np.asarray(centroids, dtype=np.float64)

    @F.arrow_udf("binary")
    def apply(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for vectors, kth in batches:
            out: list[bytes | None] = [None] * len(vectors)
            for some, counts, order in in_reach(vectors, kth, centroids, radii, nprobe):
                place = np.arange(order.shape[1])
                taken = np.zeros(order.shape, bool)
                np.put_along_axis(taken, order, (place >= start) & (place < counts[:, None]), axis=1)
                for row, bits in zip(some, np.packbits(taken, axis=1, bitorder="little")):
                    out[row] = bits.tobytes()
            yield pa.array(out, pa.binary())

    return apply.asNondeterministic()


def cell_bits(n_cells: int) -> Callable[[Column], Column]:
    """A list of cells as one bit for each cell; once more for cells that are listed again."""

    @F.arrow_udf("array<binary>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            out: list[list[bytes] | None] = []
            for cells in lists.to_numpy(zero_copy_only=False):
                cells = np.sort(cells if cells is not None else np.empty(0, np.int64))
                again = np.arange(len(cells)) - np.searchsorted(cells, cells)
                out.append([])
                for time in range(again.max(initial=-1) + 1):
                    taken = np.zeros(n_cells, bool)
                    taken[cells[again == time]] = True
                    out[-1].append(np.packbits(taken, bitorder="little").tobytes())
            yield pa.array(out, pa.list_(pa.binary()))

    return apply.asNondeterministic()


def near_bits(centroids: np.ndarray, n: int) -> Callable[[Column], Column]:
    """The ``n`` nearest centroids as one bit for each; null for a null vector."""

    @F.arrow_udf("binary")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            out: list[bytes | None] = [None] * len(vectors)
            valid = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
            if len(valid):
                points = to_matrix(vectors.drop_null())
                step = max(1, DISTANCE_BYTES // (8 * len(centroids)))
                for at in range(0, len(points), step):
                    near = nearest_places(points[at:at + step], centroids, n)
                    taken = np.zeros((len(near), len(centroids)), bool)
                    np.put_along_axis(taken, near, True, axis=1)
                    for row, bits in zip(valid[at:at + step], np.packbits(taken, axis=1, bitorder="little")):
                        out[row] = bits.tobytes()
            yield pa.array(out, pa.binary())

    return apply.asNondeterministic()


def with_near_cells(q: DataFrame, centroids: np.ndarray, nprobe: int, vec: str) -> DataFrame:
    """``q`` with its nearest cells in the form that :func:`knn_in_cells` needs, made by one function."""
    if many_cells(nprobe, len(centroids)):
        return q.withColumn("_probed", near_bits(centroids, nprobe)(F.col(vec)))
    return q.withColumn("_cells", nearest_cells(centroids, nprobe)(F.col(vec)))


def many_cells(nprobe: int, n_cells: int) -> bool:
    """Whether queries that take so many cells each meet the rows in a grid."""
    return nprobe > MOST_COPIES and nprobe >= DENSE_SHARE * n_cells


def knn_in_cells(
    q: DataFrame, db: DataFrame, nprobe: int, n_cells: int, by: By, *, join: Callable[..., DataFrame] | None = None, **args,
) -> DataFrame:
    """Hits of ``q`` in the about ``nprobe`` cells that its column ``_cells``, or ``_probed``, lists; ranks are not final.

    A query is sent to each of its cells, or, if these are many, once for each block of rows.
    """
    join = join or knn_join
    if "_probed" in q.columns:
        return knn_dense(q, db, by, join=join, **args)
    if many_cells(nprobe, n_cells):
        asked = q.withColumn("_probed", F.explode(cell_bits(n_cells)(F.col("_cells"))))
        return knn_dense(asked.drop("_cells"), db, by, join=join, **args)
    probes = q.withColumn("_cell", F.explode("_cells")).drop("_cells").where("_cell >= 0")
    return join(probes, db, by=[*by, ("_cell", "cell", "cell")], **args).drop("cell", "rank")


def knn_dense(
    q: DataFrame, db: DataFrame, by: By, *, join: Callable[..., DataFrame] | None = None,
    scorer: Callable[..., CellScorer] = CellScorer, **args,
) -> DataFrame:
    """Hits of ``q`` in the cells of its column ``_probed``; ranks are not final."""
    return (join or knn_join)(q, db, by=by, q_more=["_probed"], db_more=["cell"], scorer=scorer, **args).drop("rank")


def train_centroids(
    vectors: DataFrame, vec: str, n_cells: int, max_iter: int = 10, seed: int = 7,
) -> np.ndarray:
    """Coarse centroids by weighted k-means on a bounded sample of the vectors."""
    check_centroids(n_cells, vectors, vec)
    return fitting.fit(vectors, vec, n_cells, max_iter, seed)


def check_centroids(n_cells: int, vectors: DataFrame, vec: str) -> None:
    """Refuse a number of cells whose centroids don't fit into every task, before any work.

    A larger database has more rows per cell, and a large cell is scored as a grid, so
    fewer cells give the same result with more work.
    """
    first = vectors.where(F.col(vec).isNotNull()).select(F.size(vec)).first()
    width = first[0] if first else 1
    if 8 * n_cells * width > CENTROID_BYTES:
        most = CENTROID_BYTES // (8 * width)
        raise ValueError(f"{n_cells} cells of width {width} are more than every task can hold; use at most {most}")


def cells_for(db: DataFrame, vec: str) -> int:
    """A number of cells for a database: the root of its rows, as many as every task can hold at most."""
    n, width = db.where(F.col(vec).isNotNull()).agg(F.count(F.lit(1)), F.max(F.size(vec))).first()
    return max(1, min(round(math.sqrt(n)), CENTROID_BYTES // (8 * (width or 1))))


@dataclass(frozen=True)
class CellIndex:
    """Database vectors stored by cell, and the centroids of the cells."""

    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows").drop("_row_key", "_far")

    def radii(self, n_cells: int) -> np.ndarray:
        """Distance of the farthest row of each cell; one number a cell is read."""
        far = self.spark.read.parquet(f"{self.path}/rows").groupBy("cell").agg(F.max("_far").alias("far"))
        out = np.zeros(n_cells)
        for row in far.collect():
            out[row["cell"]] = row["far"]
        return out

    def centroids(self) -> np.ndarray:
        stored = self.spark.read.schema(CENTROIDS).parquet(f"{self.path}/centroids")
        return np.array([r["centroid"] for r in stored.orderBy("cell").collect()])


def build_cells(
    db: DataFrame, path: str, *, vec: str, n_cells: int | None = None, max_iter: int = 10, seed: int = 7,
) -> CellIndex:
    """Write ``db`` by cell, or bring what an earlier run has left there up to date.

    The centroids are written before the rows, so a run that stopped in between continues with
    the same cells.  Rows of ``db`` that the index lacks are added;
    if it has rows that are no longer in ``db``, all rows are assigned again.  An index
    with another number of cells is refused; without a number, a stored index keeps its own.
    """
    spark = db.sparkSession
    index = CellIndex(spark, path)
    if not exists(spark, f"{path}/centroids"):
        n_cells = cells_for(db, vec) if n_cells is None else n_cells
        centroids = train_centroids(db, vec, n_cells, max_iter, seed)
        table = pa.table({
            "cell": pa.array(range(len(centroids)), pa.int32()), "centroid": pa.array(centroids.tolist(), pa.list_(pa.float64())),
            "n_cells": pa.array([n_cells] * len(centroids), pa.int32()),
        })
        spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    else:
        stored = spark.read.schema(CENTROIDS).parquet(f"{path}/centroids")
        built_for = stored.first()["n_cells"]
        if n_cells is not None and built_for != n_cells:
            raise ValueError(f"the index at {path} has {built_for} cells, not {n_cells}")
        centroids = index.centroids()
    # the key tells rows apart by all their columns; rows without a vector have no cell
    keyed = db.where(F.col(vec).isNotNull()).withColumn("_row_key", F.xxhash64(*db.columns))
    mode = "overwrite"
    if exists(spark, f"{path}/rows"):
        stored = spark.read.parquet(f"{path}/rows").select("_row_key")
        state = [
            tuple(keys.agg(F.count(F.lit(1)), F.sum(F.col("_row_key").cast("decimal(38,0)"))).first())
            for keys in (keyed, stored)
        ]
        if state[0] == state[1]:
            return index
        if stored.join(keyed.select("_row_key"), "_row_key", "left_anti").isEmpty():
            keyed, mode = cut(keyed.join(stored, "_row_key", "left_anti")), "append"
    placed = place_in_cells(centroids)(F.col(vec))
    assigned = keyed.withColumn("_placed", placed).where(F.col("_placed").isNotNull())
    assigned = assigned.select(*keyed.columns, "_placed.cell", "_placed._far")
    # rebalance: one file per small cell, several for a large one
    assigned.hint("rebalance", "cell").write.mode(mode).partitionBy("cell").parquet(f"{path}/rows")
    return index


def place_in_cells(centroids: np.ndarray) -> Callable[[Column], Column]:
    """Nearest cell of each vector and the distance to its centroid, a little rounded up."""

    @F.arrow_udf("struct<cell: int, _far: double>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            points = to_matrix(vectors)
            cell = nearest_places(points, centroids, 1)[:, 0]
            far = np.linalg.norm(points - centroids[cell], axis=1) * (1 + 1e-9)
            yield pa.StructArray.from_arrays([pa.array(cell, pa.int32()), pa.array(far)], ["cell", "_far"])

    return apply.asNondeterministic()


def index_info(index: CellIndex, vec: str) -> DataFrame:
    """Rows, vector length and vector bytes per cell."""
    length = F.max(F.size(vec))
    return index.rows().groupBy("cell").agg(
        F.count(F.lit(1)).alias("n_rows"),
        length.cast("long").alias("dim"),
        (F.count(F.lit(1)) * length * 4).alias("n_bytes"),
    )


def knn_cells(
    q: DataFrame, index: CellIndex, *, k: int, q_vec: str, db_vec: str, nprobe: int | None = None,
    q_id: str = "q_id", db_id: str = "db_id", by: By = (), min_group_size: int = 1,
    block_rows: int = 16_384, exclude_self: bool = False, score: str = "score", exact: bool = False,
    target_recall: float = 0.95,
) -> DataFrame:
    """Top-k join against the ``nprobe`` nearest cells of each query, and further ones as needed.

    With ``exact`` no query stops before the bound of its next cell is below its k-th score.
    Otherwise only a query with fewer hits than k, and than its group can give, goes on; without
    ``nprobe`` it is chosen so that sampled queries reach ``target_recall``.
    """
    q, db = guard_groups(q, index.rows(), by, min_group_size)
    centroids = index.centroids()
    names = [n for _, _, n in by]
    keys = [*names, q_id]
    common = dict(k=k, q_vec=q_vec, db_vec=db_vec, q_id=q_id, db_id=db_id,
                  block_rows=block_rows, exclude_self=exclude_self, score=score)
    if nprobe is None:
        nprobe = 1 if exact else choose_nprobe(q, db, centroids, by, target_recall, common)

    n_cells = len(centroids)
    near = with_near_cells(q, centroids, nprobe, q_vec)
    hits = cut(top_k(knn_in_cells(near, db, nprobe, n_cells, by, **common), keys, k, score, db_id))
    if nprobe >= n_cells:
        return hits
    open_ = queries_to_go_on(hits, q, db, by, exact, q_id, q_vec, k, exclude_self, score)
    radii, start, width = index.radii(n_cells), 0, max(nprobe, FIRST_STEP)
    while True:
        further = further_cells(centroids, radii, nprobe, start, start + width)
        # cells depend on the k-th score, which is better after each round; those probed
        # before are always the first in the order, or out of reach
        open_ = cut(open_.withColumn("_cells", further(F.col(q_vec), F.col("_kth"))).where(F.size("_cells") > 0))
        last = F.element_at("_cells", -1)
        reach = F.when(last < 0, F.size("_cells") - 1 - last).otherwise(F.size("_cells"))
        asked, cells = open_.agg(F.count(F.lit(1)), F.sum(reach)).first()
        if not asked:
            return hits
        if width > MOST_COPIES and many_cells(cells / asked, n_cells):
            rest = all_further_cells(centroids, radii, nprobe, start)(F.col(q_vec), F.col("_kth"))
            found = knn_dense(open_.withColumn("_probed", rest).drop("_cells", "_kth"), db, by, **common)
            return cut(top_k(hits.drop("rank").unionByName(found), keys, k, score, db_id))
        found = knn_in_cells(open_.drop("_kth"), db, 0, n_cells, by, **common)
        hits = cut(top_k(hits.drop("rank").unionByName(found), keys, k, score, db_id))
        left = open_.where(F.element_at("_cells", -1) < 0).drop("_cells", "_kth")
        open_ = with_kth(left, hits, by, q_id, k, score)
        start, width = start + width, 4 * width


def with_kth(queries: DataFrame, hits: DataFrame, by: By, q_id: str, k: int, score: str) -> DataFrame:
    """``queries`` with ``_kth``, the score of their k-th hit, null if there are fewer."""
    renamed = {n: f"_h_{n}" for n in (*(n for _, _, n in by), q_id)}
    last = hits.where(F.col("rank") == k).select(
        *[F.col(n).alias(h) for n, h in renamed.items()], F.col(score).alias("_kth")
    )
    on = [F.col(c) == F.col(renamed[n]) for c, n in [*((c, n) for c, _, n in by), (q_id, q_id)]]
    return queries.join(last, on, "left").drop(*renamed.values())


def queries_to_go_on(
    hits: DataFrame, q: DataFrame, db: DataFrame, by: By, exact: bool, q_id: str, q_vec: str, k: int,
    exclude_self: bool, score: str,
) -> DataFrame:
    """All queries, or those with fewer hits than k and than their group can give; with ``_kth``."""
    keys = [*(c for c, _, _ in by), q_id]
    queries = with_kth(q.select(*keys, q_vec), hits, by, q_id, k, score)
    if exact:
        return queries
    # An upper bound from the group columns alone: rows without a vector only make some
    # queries of tiny groups go on in vain. A row may be barred from matching itself.
    reachable = F.count(F.lit(1)) - (1 if exclude_self else 0)
    short = queries.where(F.col("_kth").isNull())
    renamed = {n: f"_s_{n}" for n in (*(n for _, _, n in by), q_id)}
    counts = hits.groupBy(*renamed).agg(F.count(F.lit(1)).alias("_hits"))
    counts = counts.select(*[F.col(n).alias(a) for n, a in renamed.items()], "_hits")
    on = [F.col(c) == F.col(renamed[n]) for c, n in [*((c, n) for c, _, n in by), (q_id, q_id)]]
    short = short.join(counts, on, "left").drop(*renamed.values())
    if by:
        sizes = db.groupBy(*[F.col(c).alias(f"_g_{n}") for _, c, n in by]).agg(reachable.alias("_reachable"))
        small = measured(sizes).for_join()
        short = short.join(small, [F.col(c) == F.col(f"_g_{n}") for c, _, n in by]).drop(*[f"_g_{n}" for _, _, n in by])
    else:
        short = short.withColumn("_reachable", db.agg(reachable).scalar())
    lacking = F.coalesce("_hits", F.lit(0)) < F.least(F.lit(k), F.col("_reachable"))
    return short.where(lacking).drop("_hits", "_reachable")


def tuning_sample(q: DataFrame, q_id: str, q_vec: str) -> DataFrame:
    """``TUNING_QUERIES`` queries, by least hashed id; tasks send no more than that each."""
    order = F.xxhash64(F.lit("tuning"), q_id)
    return cut(q.where(F.col(q_vec).isNotNull()).orderBy(order, q_id).limit(TUNING_QUERIES))


def choose_nprobe(
    q: DataFrame, db: DataFrame, centroids: np.ndarray, by: By, target_recall: float, common: dict,
) -> int:
    """The least number of nearest cells that hold ``target_recall`` of sampled queries' exact hits."""
    q_id, db_id, q_vec = common["q_id"], common["db_id"], common["q_vec"]
    sample = tuning_sample(q, q_id, q_vec)
    hits = knn_join(sample, db, by=by, **common)
    on = {**{n: c for _, c, n in by}, db_id: db_id}
    held = db.select(*[F.col(c).alias(f"_d_{n}") for n, c in on.items()], "cell")
    found = hits.join(held, [F.col(n) == F.col(f"_d_{n}") for n in on]).select(q_id, "cell")
    vectors = sample.select(F.col(q_id).alias("_q"), q_vec)
    pairs = found.join(vectors, F.col(q_id) == F.col("_q")).select(q_vec, "cell").toArrow()
    if not pairs.num_rows:
        return len(centroids)
    order = nearest_places(to_matrix(pairs[q_vec]), centroids, len(centroids))
    rank = (order == pairs["cell"].to_numpy()[:, None]).argmax(axis=1) + 1
    return int(np.quantile(rank, min(target_recall, 1.0), method="higher"))


def sign_planes(tables: int, bits: int, width: int) -> np.ndarray:
    """±1 hyperplanes, one per (table, bit), from the first hex digit of an md5.

    The rule makes them the same in every run and on every engine.
    """

    def sign(table: int, bit: int, place: int) -> int:
        digit = hashlib.md5(f"{table}:{bit}:{place}".encode()).hexdigest()[0]
        return 1 if int(digit, 16) < 8 else -1

    return np.array([
        [[sign(t, b, i) for i in range(width)] for b in range(bits)] for t in range(tables)
    ], dtype=np.float64)


def squared_margins(vectors: np.ndarray, planes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits, and what leaving each costs: (rows, bits) of one table."""
    sides = vectors @ planes.T
    return sides > 0, sides**2


def largest_costs(margins: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes``-th least cost of a bucket, for each row; a little more, as sums in another order differ in their last digits.

    So few rows are taken at a time that their sums stay in the processor cache.
    """
    step = max(1, SUM_BYTES // (16 * probes))
    sums = [least_sums(margins[at:at + step], probes)[:, -1] for at in range(0, len(margins), step)]
    return np.concatenate(sums) * (1 + 1e-9) + 1e-12


def plane_codes(planes: np.ndarray) -> Callable[[Column], Column]:
    """Bucket number per table: one bit per hyperplane, set on its positive side."""
    weights = 1 << np.arange(planes.shape[1])

    def codes(vectors: np.ndarray) -> np.ndarray:
        return np.stack([(vectors @ table.T > 0) @ weights for table in planes], axis=1)

    return matrix_udf(codes)


def plane_probes(planes: np.ndarray, probes: int, shift: int) -> Callable[[Column], Column]:
    """Where each query probes: table, prefix (a code without its ``shift`` lowest bits) and limit.

    The limit is the ``probes``-th least cost of a bucket in that table; a bucket's cost is the
    sum of squared margins of the bits in which it differs. Prefixes are those with such a bucket.
    """
    bits = planes.shape[1]
    prefixes = ((np.arange(1 << (bits - shift))[:, None] >> np.arange(bits - shift)) & 1).astype(np.float64)
    kind = pa.struct([("table", pa.int32()), ("prefix", pa.int32()), ("limit", pa.float64())])

    @F.arrow_udf("array<struct<table: int, prefix: int, limit: double>>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            out: list[list[dict] | None] = [None] * len(vectors)
            valid = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
            if len(valid):
                points = to_matrix(vectors.drop_null())
                for row in valid:
                    out[row] = []
                step = max(1, DISTANCE_BYTES // (8 * len(prefixes)))
                for t, table in enumerate(planes):
                    positive, margins = squared_margins(points, table)
                    limits = largest_costs(margins, probes)
                    for at in range(0, len(points), step):
                        some = slice(at, at + step)
                        high, cost = positive[some, shift:], margins[some, shift:]
                        costs = (cost * high).sum(axis=1)[:, None] + (cost * (1 - 2 * high)) @ prefixes.T
                        place, prefix = np.nonzero(costs <= limits[some, None])
                        for i, p in zip(place.tolist(), prefix.tolist()):
                            out[valid[at + i]].append({"table": t, "prefix": p, "limit": float(limits[at + i])})
            yield pa.array(out, pa.list_(kind))

    return apply.asNondeterministic()


def plane_limits(planes: np.ndarray, probes: int) -> Callable[[Column], Column]:
    """The limit of :func:`plane_probes` in each table."""

    @F.arrow_udf("array<double>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            valid = vectors.is_valid().to_numpy(zero_copy_only=False)
            if not valid.any():
                yield pa.nulls(len(vectors), pa.list_(pa.float64()))
                continue
            points = to_matrix(vectors.drop_null())
            limits = np.stack([largest_costs(squared_margins(points, t)[1], probes) for t in planes], axis=1)
            offsets = np.concatenate([[0], np.cumsum(valid * len(planes))]).astype(np.int32)
            yield pa.ListArray.from_arrays(offsets, pa.array(limits.ravel()), mask=pa.array(~valid))

    return apply.asNondeterministic()


def knn_planes(
    q: DataFrame, db: DataFrame, *, k: int, width: int, q_vec: str, db_vec: str,
    tables: int | None = None, bits: int | None = None, probes: int | None = None,
    q_id: str = "q_id", db_id: str = "db_id", by: By = (), min_group_size: int = 1,
    block_rows: int = 16_384, exclude_self: bool = False, score: str = "score", target_recall: float = 0.9,
) -> DataFrame:
    """Top-k join among rows in the ``probes`` buckets of each table that are nearest to the query.

    What is not given is chosen from the data, so that sampled queries reach ``target_recall``.
    A query with fewer hits than k, and than its group can give, gets its exact result.
    """
    q, db = guard_groups(q, db, by, min_group_size)
    common = dict(k=k, q_vec=q_vec, db_vec=db_vec, q_id=q_id, db_id=db_id,
                  block_rows=block_rows, exclude_self=exclude_self, score=score)
    groups = [F.col(c) for _, c, _ in by]
    most = db.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0
    if tables is None or bits is None or probes is None:
        tables, bits, probes = choose_planes(q, db, most, width, by, target_recall, common, tables, bits, probes)
    planes = sign_planes(tables, bits, width)
    keys = [*(n for _, _, n in by), q_id]
    if tables * probes >= DENSE_SHARE * (1 << bits):
        found = knn_join(
            q.withColumn("_limits", plane_limits(planes, probes)(F.col(q_vec))),
            db.withColumn("_codes", plane_codes(planes)(F.col(db_vec))), by=by, q_more=["_limits"], db_more=["_codes"],
            scorer=lambda *args: ReachScorer(*args, planes=planes), **common,
        )
        # a query that comes twice has its hits once
        pairs = found.select(*keys, db_id, score).repartition(*keys).distinct()
        return complete(top_k(pairs, keys, k, score, db_id), q, db, by=by, **common)
    # rows of a table whose codes begin alike are one group, of a block or so, and not a group a bucket
    shift = max(0, bits - max(0, math.ceil(math.log2(max(most, 1) / block_rows))))
    held = db.select("*", F.posexplode(plane_codes(planes)(F.col(db_vec))).alias("_table", "_code"))
    held = held.withColumn("_prefix", F.shiftright("_code", shift))
    asked = q.withColumn("_probe", F.explode(plane_probes(planes, probes, shift)(F.col(q_vec))))
    asked = asked.select(*q.columns, "_probe.table", "_probe.prefix", F.col("_probe.limit").alias("_limit"))
    found = knn_join(
        asked, held, by=[*by, ("table", "_table", "_table"), ("prefix", "_prefix", "_prefix")],
        q_more=["_limit"], db_more=["_code"],
        scorer=lambda *args: ProbeScorer(*args, planes=planes, table="_table"), **common,
    )
    # One shuffle by query serves both the removal of repeated pairs and the rank.
    pairs = found.select(*keys, db_id, score).repartition(*keys).distinct()
    return complete(top_k(pairs, keys, k, score, db_id), q, db, by=by, **common)


def choose_planes(
    q: DataFrame, db: DataFrame, most: int, width: int, by: By, target_recall: float, common: dict,
    tables: int | None, bits: int | None, probes: int | None,
) -> tuple[int, int, int]:
    """Tables, bits and probes that find ``target_recall`` of sampled queries' exact hits at least cost.

    A bucket has a row or two of the largest group, unless ``bits`` is given. For each pair of a
    sampled query and an exact hit the number of probes is found after which each table has it;
    from these follow the probes that any number of tables needs, and the cheapest choice is taken.
    """
    q_id, db_id, q_vec, db_vec = (common[c] for c in ("q_id", "db_id", "q_vec", "db_vec"))
    bits = bits or max(1, min(MOST_BITS, math.ceil(math.log2(max(most, 2)))))
    sample = tuning_sample(q, q_id, q_vec)
    hits = knn_join(sample, db, by=by, **common)
    on = {**{n: c for _, c, n in by}, db_id: db_id}
    held = db.select(*[F.col(c).alias(f"_d_{n}") for n, c in on.items()], F.col(db_vec).alias("_found"))
    found = hits.join(held, [F.col(n) == F.col(f"_d_{n}") for n in on]).select(q_id, "_found")
    asked = sample.select(F.col(q_id).alias("_q"), F.col(q_vec).alias("_asked"))
    pairs = found.join(asked, F.col(q_id) == F.col("_q")).select("_asked", "_found").toArrow()
    if not pairs.num_rows:
        return tables or 1, bits, probes or 1
    a, b = to_matrix(pairs["_asked"]), to_matrix(pairs["_found"])
    limit = min(1 << bits, 4_096)
    ranks = []
    for table in sign_planes(tables or MOST_TABLES, bits, width):
        own, margins = squared_margins(a, table)
        cost = (margins * (own != (b @ table.T > 0))).sum(axis=1)
        sums = least_sums(margins, limit)
        ranks.append((sums < cost[:, None] * (1 - 1e-12)).sum(axis=1) + 1)
    first = np.minimum.accumulate(np.stack(ranks), axis=0)
    # the sample may flatter: aim a deviation higher
    aim = min(1.0, target_recall + math.sqrt(target_recall * (1 - target_recall) / len(a)))
    choices = []
    for n in range(tables or 1, len(ranks) + 1):
        need = probes or int(np.quantile(first[n - 1], aim, method="higher"))
        choices.append((need > limit, n * need, n, min(need, limit)))
    _, _, n, need = min(choices)
    return n, bits, need


def complete(
    hits: DataFrame, q: DataFrame, db: DataFrame, *, k: int, q_vec: str, db_vec: str,
    q_id: str, db_id: str, by: By, block_rows: int, exclude_self: bool, score: str,
) -> DataFrame:
    """Give queries with too few hits their exact result.

    A query is short if it has fewer hits than k and than its group can give.
    """
    names = [n for _, _, n in by]
    hits = cut(hits)
    counts = hits.groupBy(*names, q_id).agg(F.count(F.lit(1)).alias("_hits"))
    groups = [F.col(c).alias(n) for _, c, n in by]
    # An upper bound from the group columns alone: rows without a vector only make
    # some queries of tiny groups take the exact pass in vain.  A row may be barred
    # from matching itself, so one row less may be reachable.
    reachable = F.count(F.lit(1)) - (1 if exclude_self else 0)
    queries = q.select(*[F.col(c).alias(n) for c, _, n in by], F.col(q_id))
    if names:
        sizes = db.select(*groups).groupBy(*names).agg(reachable.alias("_reachable"))
        queries = queries.join(measured(sizes).for_join(), names)
    else:
        queries = queries.withColumn("_reachable", db.agg(reachable).scalar())
    short = cut(
        queries.join(counts, [*names, q_id], "left")
        .where(F.coalesce("_hits", F.lit(0)) < F.least(F.lit(k), F.col("_reachable")))
        .select(*names, q_id)
    )
    if short.isEmpty():
        return hits
    left = matching(q, short, {**{c: n for c, _, n in by}, q_id: q_id})
    exact = knn_join(
        left, db, k=k, q_vec=q_vec, db_vec=db_vec, q_id=q_id, db_id=db_id, by=by,
        block_rows=block_rows, exclude_self=exclude_self, score=score,
    )
    keys = {c: c for c in (*names, q_id)}
    return matching(hits, short, keys, "left_anti").unionByName(exact)
