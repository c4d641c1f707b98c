"""Hard negatives by Fagin's threshold algorithm.

For each anchor, its best rows of the same label are its positives; for each positive, the best
rows of other labels whose score lies in a window below the positive's are its hard negatives.
Scores are integer inner products; ties go to the smaller id.

Both searches are top-k searches over shards of candidates. A shard keeps, for each dimension,
its rows in the order of that component. An anchor reads all these lists side by side, from
the end that its own sign in the dimension favours (sorted access), a stretch at a time. Rows met
for the first time are scored in full (random access). No unseen row can score more than the
threshold, the sum over the dimensions of the anchor's component times the value read last, so
the anchor stops once the threshold is strictly below the k-th score of each of its windows, or
below the window itself; at equality it goes on, as a tie may have the smaller id.

Anchors are taken in blocks and candidates in shards, both of a bounded size whatever label or
key holds most of the rows; each (shard, block) is one unit of work that returns at most k rows for
each window, and these are merged. In the first search shards and blocks are of one label, so
only rows of the anchor's label are read. The work is that of a stated query set against all rows.

Cases: rows with a null id, label or vector, or with a component that is null or no finite
number, take no part; of rows with one id the one with the least label, then the least vector, is
used, so repeated rows count once; shorter vectors are filled up with zeros; empty vectors score
zero; an anchor without a row of its label, or a positive without a row in its window, gives no
row; an empty table gives an empty result; other columns are ignored; a score that takes more
than 62 bits is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from twinshelf.llm.common import partitions, stored, table

SCALE = 256
#: Rows of a shard of candidates, and of a block of anchors.
SHARD_ROWS = 8_192
BLOCK_ROWS = 1_024
#: Components of a shard, so that wide vectors make shards of fewer rows.
SHARD_CELLS = 1 << 20
#: Pairs of an anchor and a candidate that one task may have to look at.
PAIRS_PER_TASK = 100_000_000
#: Sorted accesses of the first stretch, in each list; every further stretch is twice as long.
STRETCH = 64
LEAST = -(1 << 62)


def usable(rows: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """``id``, ``label`` and integer ``vec`` of the rows that take part, one for each id."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    parts = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite)
    whole = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    kept = parts.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), whole.alias("vec"))
    least = F.min(F.struct("label", "vec"))
    return kept.groupBy("id").agg(least.alias("row")).select("id", "row.label", "row.vec")


def to_matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros to ``width``."""
    lists = vectors.combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    out = np.zeros((len(lists), width), np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
    return out


def exact(*sides: np.ndarray) -> list[np.ndarray]:
    """The sides as doubles where no score can pass 2^53, or else as unbounded integers."""
    most = sides[0].shape[1]
    for side in sides:
        most *= max(int(side.max(initial=0)), -int(side.min(initial=0)))
    return [side.astype(np.float64 if most < 2**53 else object) for side in sides]


class Shard:
    """Candidates in the order of their ids, and their order in each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.rising = np.ascontiguousarray(np.argsort(self.vectors, axis=0, kind="stable").T)

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple]:
        """For each (least, most) score, positions and scores of the ``k`` best allowed rows in it."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        unseen = np.ones(n, bool)
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
        depth, stretch = 0, STRETCH
        while unseen.any():
            # sorted access: the next stretch of each list, from the end that the sign favours
            stop = min(depth + stretch, n)
            met = np.zeros(n, bool)
            met[self.rising[up, n - stop : n - depth]] = True
            met[self.rising[down, depth:stop]] = True
            if not len(up) and not len(down):
                met[:] = True
            # random access: rows met for the first time
            met &= unseen
            unseen &= ~met
            new = np.flatnonzero(met & allowed)
            scores = (self.vectors[new] @ anchor).astype(np.int64)
            best = [self.merged(*held, new, scores, window, k) for held, window in zip(best, windows)]
            threshold = (anchor[up] * self.vectors[self.rising[up, n - stop], up]).sum()
            threshold += (anchor[down] * self.vectors[self.rising[down, stop - 1], down]).sum()
            if all(threshold < (max(least, held[1][-1]) if len(held[0]) == k else least)
                   for held, (least, _) in zip(best, windows)):
                break
            depth, stretch = stop, 2 * stretch
        return best

    @staticmethod
    def merged(
        at: np.ndarray, scores: np.ndarray, new: np.ndarray, more: np.ndarray, window: tuple[int, int], k: int,
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best of those held and the new ones in the window, ties by position, which is by id."""
        least = max(window[0], scores[-1]) if len(at) == k else window[0]
        inside = (more >= least) & (more <= window[1])
        at, scores = np.concatenate([at, new[inside]]), np.concatenate([scores, more[inside]])
        order = np.lexsort((at, -scores))[:k]
        return at[order], scores[order]


def numbered(rows: DataFrame, parts: Column, own: str) -> DataFrame:
    """``rows`` dealt into ``parts`` parts by a hash of the id."""
    return rows.withColumn(own, F.pmod(F.xxhash64("id"), parts).cast("int"))


def copied(rows: DataFrame, parts: Column, other: str) -> DataFrame:
    """A copy of each row for every part of the other side."""
    return rows.withColumn(other, F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))


def searched(
    anchors: DataFrame, rows: DataFrame, keys: list[str], pairs: int, width: int, k: int, same: bool,
    schema: T.StructType,
) -> DataFrame:
    """The best rows of each shard for the anchors of each block, in the ``windows`` of every anchor.

    ``keys`` tell the (shard, block) of both sides, ``pairs`` how many pairs all of them have.
    """
    # work grows with pairs, not with bytes
    n = max(partitions(rows.sparkSession), -(-pairs // PAIRS_PER_TASK))
    # columns of the same table on both sides need names of their own
    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])
    anchors, rows = (side.repartition(n, *keys) for side in (anchors, rows))
    arrow = to_arrow_schema(schema)

    def cell(block: pa.Table, shard: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in schema.names]
        if block.num_rows and shard.num_rows:
            vectors, candidates = exact(*(to_matrix(side["vec"], width) for side in (block, shard)))
            found = Shard(shard["id"].to_numpy(), shard["label"].to_numpy(), candidates)
            asked = zip(block["id"].to_pylist(), block["label"].to_pylist(), block["windows"].to_pylist())
            for (anchor, label, windows), vector in zip(asked, vectors):
                allowed = (found.labels == label) == same
                allowed &= found.ids != anchor
                bounds = [(w["least"], w["most"]) for w in windows]
                for window, (at, scores) in zip(windows, found.search(vector, allowed, bounds, k)):
                    columns = ([anchor] * len(at), [window["positive_id"]] * len(at),
                               [window["positive_score"]] * len(at), found.ids[at].tolist(), scores.tolist())
                    for have, more in zip(out, columns):
                        have.extend(more)
        return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(out, arrow.types)], schema=arrow)

    return anchors.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(cell, schema)


def top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best of each key with their ``rank``; every task cuts to k before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 3,
    least_percent: int = 50, most_percent: int = 95, id_col: str = "vec_id", label_col: str = "label",
    vec_col: str = "embedding", scale: int = SCALE, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``is_anchor`` is a condition on the column ``id``. A negative's score is at least ``least_percent``
    and at most ``most_percent`` in a hundred of the positive's.
    """
    rows = stored(usable(rows, id_col, label_col, vec_col, scale), "integer-vectors")
    anchors = rows.filter(is_anchor)
    width, total, asking = rows.agg(F.max(F.size("vec")), F.count(F.lit(1)), F.count_if(is_anchor)).first()
    width = max(width or 1, 1)
    shard_rows = max(1, min(shard_rows, SHARD_CELLS // width))
    kind = rows.schema["id"].dataType
    schema = T.StructType([
        T.StructField("anchor_id", kind), T.StructField("positive_id", kind),
        T.StructField("positive_score", T.LongType()), T.StructField("other_id", kind),
        T.StructField("score", T.LongType()),
    ])
    window = f"array<struct<positive_id: {kind.simpleString()}, positive_score: long, least: long, most: long>>"

    # positives: shards and blocks are of one label, and every anchor meets all shards of its own
    parts = {"shard": F.ceil(F.count(F.lit(1)) / shard_rows), "block": F.ceil(F.count_if(is_anchor) / block_rows)}
    sizes = rows.groupBy("label").agg(
        *[n.alias(f"n_{part}") for part, n in parts.items()],
        (F.count(F.lit(1)) * F.count_if(is_anchor)).alias("pairs"),
    )
    sizes = stored(sizes.filter("n_block > 0"), "label-sizes")
    pairs = sizes.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]
    everything = F.array(F.struct(F.lit(None), F.lit(0), F.lit(LEAST), F.lit(-LEAST))).cast(window)
    found = searched(
        copied(numbered(anchors.join(sizes, "label"), F.col("n_block"), "block"), F.col("n_shard"), "shard")
        .withColumn("windows", everything),
        copied(numbered(rows.join(sizes, "label"), F.col("n_shard"), "shard"), F.col("n_block"), "block"),
        ["label", "shard", "block"], pairs, width, positives, True, schema,
    )
    found = stored(top(found, ["anchor_id"], positives).select("anchor_id", "other_id", "score"), "positives")

    # negatives: every anchor meets all shards, and the windows of its positives go with it
    least, most = (F.expr(f"(score * {p} + {up} - pmod(score * {p} + {up}, 100)) div 100")
                   for p, up in ((least_percent, 99), (most_percent, 0)))
    bounds = F.collect_list(F.struct("other_id", "score", least, most)).cast(window)
    asked = found.filter(least <= most).groupBy(F.col("anchor_id").alias("id")).agg(bounds.alias("windows"))
    shards, blocks = F.lit(max(1, -(-total // shard_rows))), F.lit(max(1, -(-asking // block_rows)))
    found = searched(
        copied(numbered(anchors.join(asked, "id"), blocks, "block"), shards, "shard"),
        copied(numbered(rows, shards, "shard"), blocks, "block"),
        ["shard", "block"], total * asking, width, negatives, False, schema,
    )
    best = top(found, ["anchor_id", "positive_id"], negatives)
    return best.select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector; labels of every 7th are moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("id") % 50 == 0)


QUERIES: list[Callable] = [op12_hard_negatives]

ORACLES = {
    "op12_hard_negatives": """
        WITH rows AS (
          SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
          SELECT a.id AS anchor_id, r.id, a.label = r.label AS same,
                 list_inner_product(a.vec, r.vec)::BIGINT AS score
          FROM rows a JOIN rows r ON a.id <> r.id WHERE a.id % 50 = 0
        ), positives AS (
          SELECT * FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        ), found AS (
          SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score,
                 n.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank
          FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
           AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        )
        SELECT * FROM found WHERE rank <= 3
    """,
}
