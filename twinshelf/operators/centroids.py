"""Centroids fitted on a weighted sample of bounded size.

The sample is a coreset by sensitivity: one pass takes the mean of all vectors and the sum of
squared distances to it, a second keeps each vector with a probability that is half uniform and
half in proportion to its own squared distance, with the inverse of that probability as its weight.
Rare far vectors are kept as surely as dense regions are, and a cost measured on the
sample is close to that on all rows whatever the centroids are. The iterations then need
no further scan.

A sample has about ``rows_per_cell`` vectors for each cell, and never more than ``SAMPLE_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinshelf.kernels import to_matrix

SAMPLE_BYTES = 64 << 20
LEAST_SAMPLE = 4_096
# Distances of sample rows to all centroids that are held at once.
DISTANCE_BYTES = 32 << 20
# Marks in the table of sums, beside the numbers of the dimensions.
ROWS, SQUARES = -1, -2


def uniform(places: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row number; the same in every attempt of a task."""
    x = (places.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).astype(np.float64) / 2.0**64


def moments(vectors: DataFrame, vec: str) -> tuple[int, np.ndarray, float]:
    """Number of vectors, their mean, and the sum of squared distances to it."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, squares, total = 0, 0.0, np.zeros(0)
        for batch in batches:
            points = to_matrix(batch.column(0).drop_null())
            if not len(points):
                continue
            rows += len(points)
            squares += float((points**2).sum())
            total = points.sum(axis=0) + (total if len(total) else 0.0)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([ROWS, SQUARES, *range(len(total))], pa.int32()), pa.array([rows, squares, *total], pa.float64())],
                names=["dim", "total"],
            )

    parts = vectors.select(F.col(vec)).mapInArrow(add, "dim int, total double")
    sums = {r["dim"]: r["total"] for r in parts.groupBy("dim").agg(F.sum("total").alias("total")).collect()}
    n = int(sums.pop(ROWS, 0))
    squares = sums.pop(SQUARES, 0.0)
    mean = np.array([sums[i] for i in range(len(sums))]) / max(n, 1)
    return n, mean, max(squares - n * float((mean**2).sum()), 0.0)


def sample_size(n_cells: int, width: int, rows_per_cell: int) -> int:
    return max(1, min(max(n_cells * rows_per_cell, LEAST_SAMPLE), SAMPLE_BYTES // (8 * max(width, 1))))


def coreset(vectors: DataFrame, vec: str, size: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """About ``size`` vectors and their weights; all of them, with weight one, if there are no more."""
    n, mean, spread = moments(vectors, vec)

    def chance(points: np.ndarray) -> np.ndarray:
        if n <= size:
            return np.ones(len(points))
        far = ((points - mean) ** 2).sum(axis=1) / spread if spread > 0 else 1.0 / n
        return np.minimum(1.0, size * (0.5 / n + 0.5 * far))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            if not batch.num_rows:
                continue
            points = to_matrix(batch.column(0))
            p = chance(points)
            kept = np.flatnonzero(uniform(batch.column(1).to_numpy(), seed) < p)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept)).cast(pa.list_(pa.float64())), pa.array(1 / p[kept])],
                names=["point", "weight"],
            )

    numbered = vectors.select(F.col(vec), F.monotonically_increasing_id().alias("place"))
    drawn = numbered.mapInArrow(draw, "point array<double>, weight double").toArrow()
    return to_matrix(drawn["point"]), drawn["weight"].to_numpy()


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each point, and the squared distance."""
    half = (centroids**2).sum(axis=1) / 2
    step = max(1, DISTANCE_BYTES // (8 * len(centroids)))
    cell, short = np.empty(len(points), np.int64), np.empty(len(points))
    for at in range(0, len(points), step):
        part = points[at : at + step]
        distance = half - part @ centroids.T
        cell[at : at + step] = distance.argmin(axis=1)
        short[at : at + step] = 2 * distance.min(axis=1) + (part**2).sum(axis=1)
    return cell, np.maximum(short, 0.0)


def weighted_means(points: np.ndarray, weights: np.ndarray, n_cells: int, max_iter: int, seed: int) -> np.ndarray:
    """Lloyd's iterations from a start spread by distance; an empty cell moves to a far point."""
    pick = np.random.default_rng(seed)
    if len(points) <= n_cells:
        return points
    # a start in rounds: points are drawn in proportion to weight times distance, many at a time
    chosen = points[pick.choice(len(points), 1, p=weights / weights.sum())]
    while len(chosen) < n_cells:
        _, far = nearest(points, chosen)
        mass = weights * far
        free = np.count_nonzero(mass)
        if not free:
            break
        more = min(n_cells - len(chosen), max(1, len(chosen)), free)
        chosen = np.vstack([chosen, points[pick.choice(len(points), more, replace=False, p=mass / mass.sum())]])
    for _ in range(max_iter):
        cell, far = nearest(points, chosen)
        mass = np.bincount(cell, weights, len(chosen))
        moved = np.stack([np.bincount(cell, weights * column, len(chosen)) for column in points.T], axis=1)
        used = mass > 0
        moved[used] /= mass[used][:, None]
        moved[~used] = points[np.argsort(-weights * far, kind="stable")[: np.count_nonzero(~used)]]
        if np.allclose(moved, chosen):
            break
        chosen = moved
    return chosen


def fit(vectors: DataFrame, vec: str, n_cells: int, max_iter: int = 10, seed: int = 7, rows_per_cell: int = 64) -> np.ndarray:
    """``n_cells`` centroids, fewer if there are fewer different vectors."""
    first = vectors.where(F.col(vec).isNotNull()).select(F.size(vec)).first()
    points, weights = coreset(vectors, vec, sample_size(n_cells, first[0] if first else 1, rows_per_cell), seed)
    return weighted_means(points, weights, n_cells, max_iter, seed)
