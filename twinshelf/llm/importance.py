"""Importance resampling towards a target distribution, drawn by a distributed quickselect.

Features are hashed runs of words. Every task counts its texts' features in one array, and
the arrays' non-zero places are added up by bucket: the only thing that reaches the driver are
``buckets`` counts of each side, however large the corpus is. From them comes a gain for each
bucket, floor(1000 ln(share in the target / share in the corpus)) with one added to every count.
A second pass looks the gains up in an array: a text's weight is the sum over its features.

Adding Gumbel noise to the weights makes the k highest scores a draw without replacement in
proportion to exp(weight / 1000). The noise comes from a hash of the id, so a task that runs
again gives the same scores.

The k-th highest score is found without sorting the corpus. Keys are (score descending, id,
number of features, place), the place being the row's number in the written scores, so no two
are equal. In each round some random keys of the range that is left are pivots; one pass
counts exactly how many keys lie below and at each of them, and the k-th key either is a pivot
or lies between two, so the range shrinks to a share of 1 / (pivots + 1) or so. What is left
is written, so all rounds together read little more than the first. The winners alone are then
sorted, by ranges, and numbered.

Cases: a null or empty text has no features, weight 0 and no rank; a null id counts as the
text ``None`` in the hash and comes before other ids in a tie; repeated rows are drawn each by
itself, ties of score and id by number of features, then by place; with an empty corpus the
result is empty; with an empty target every gain is that of a count of zero; very long texts
are taken in pieces; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinshelf.llm.common import stored, table
from twinshelf.operators.rows import row_index

BUCKETS = 10_000
LONGEST = 3
SEED = 42
PIVOTS = 15
#: Bytes of a text whose words are held at a time.
PIECE = 1 << 22
#: Lower-cases A-Z, keeps 0-9, a-z and all bytes of other letters; the rest of ASCII becomes a blank.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def word_pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, so many at a time."""
    data = (text or "").encode().translate(FOLD)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def feature_hashes(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """For pieces of a text, the number of words and the crc32 of each run of 1 to ``LONGEST``
    words that ends in the piece. A run's sum goes on from that of the run one word shorter."""
    before: list[bytes] = []
    for words in word_pieces(text):
        run = before + words
        tails = list(map(b" ".__add__, run))
        level = list(map(crc32, run))
        sums = level[len(before):]
        for n in range(1, LONGEST):
            level = list(map(crc32, tails[n:], level))
            sums += level[max(len(before) - n, 0):]
        yield len(words), np.fromiter(sums, np.uint32, len(sums))
        before = run[len(run) - min(LONGEST - 1, len(run)):]


def bucket_counts(texts: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """How many features of all texts each bucket has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, hashes in feature_hashes(text):
                    total += np.bincount(hashes % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    parts = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long")
    held = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[held["bucket"].to_numpy()] = held["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1) (S + buckets) / ((s + 1) (T + buckets)))) for each bucket, in doubles."""
    s_all, t_all = (float(side.sum() + len(side)) for side in (corpus, target))
    ratios = ((t + 1.0) * s_all / ((s + 1.0) * t_all) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def noise(row_id: object, seed: int) -> int:
    """Gumbel noise in thousandths, from a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{row_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(
    docs: DataFrame, weights: np.ndarray, *, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """For each row ``id``, ``n_words``, ``n_features``, ``weight`` and ``score``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n_words = n_features = weight = 0
                for n, hashes in feature_hashes(text):
                    n_words += n
                    n_features += len(hashes)
                    weight += int(weights[hashes % len(weights)].sum())
                rows.append((n_words, n_features, weight, weight + noise(row_id, seed)))
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                names=["id", "n_words", "n_features", "weight", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, f"id {kind}, n_words long, n_features long, weight long, score long")


def key_order(key: Sequence[str], row: Row, schema: T.StructType) -> tuple[Column, Column]:
    """Whether a row's key lies below that of ``row``, and whether it is the same; null is least."""
    below, same = F.lit(False), F.lit(True)
    for name in key:
        own, other = F.col(name), F.lit(row[name]).cast(schema[name].dataType)
        less = F.lit(False) if row[name] is None else own.isNull() | (own < other)
        below = below | (same & F.coalesce(less, F.lit(False)))
        same = same & own.eqNullSafe(other)
    return below, same


def select_key(rows: DataFrame, key: Sequence[str], k: int, pivots: int = PIVOTS, seed: int = SEED) -> Row | None:
    """The ``k``-th least key (from 1) of ``rows``, whose keys are all different; None if there are fewer."""
    left = rows.select(*key)
    for turn in range(1_000):
        some = left.orderBy(F.xxhash64(F.lit(seed + turn), *key), *key).limit(pivots).collect()
        if not some:
            return None
        tests = [key_order(key, row, rows.schema) for row in some]
        counts = left.agg(*[F.count_if(x).alias(f"{name}{i}") for i, pair in enumerate(tests)
                            for name, x in zip(("below", "same"), pair)]).first()
        low, high = None, None  # the nearest pivots on both sides of the k-th key
        for i, row in enumerate(some):
            below, same = counts[f"below{i}"], counts[f"same{i}"]
            if below < k <= below + same:
                return row
            if k > below + same and (low is None or below + same > low[0]):
                low = (below + same, i)
            if k <= below and (high is None or below < high[0]):
                high = (below, i)
        if low:
            left = left.filter(~tests[low[1]][0] & ~tests[low[1]][1])
            k -= low[0]
        if high:
            left = left.filter(tests[high[1]][0])
        left = stored(left, "select-range")
    raise RuntimeError("the keys are not all different")


def resample(
    docs: DataFrame, target: DataFrame, *, percent: int = 5, min_words: int = 20, buckets: int = BUCKETS,
    seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """For each row ``id``, ``n_words``, ``n_features``, ``weight``, ``score`` and, if it is drawn, ``rank``.

    Of the rows with ``min_words`` words or more, ``percent`` in a hundred are drawn, rounded down.
    """
    weights = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    rows = scored(docs, weights, seed=seed, id_col=id_col, text_col=text_col)
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()), "scores")
    key = ["descending", "id", "n_features", "place"]
    keyed = rows.withColumn("descending", -F.col("score"))
    able = keyed.filter(F.col("n_words") >= min_words)
    k = able.count() * percent // 100
    last = select_key(able, key, k, seed=seed) if k else None
    drawn = F.lit(False)
    if last is not None:
        below, same = key_order(key, last, keyed.schema)
        drawn = (F.col("n_words") >= min_words) & (below | same)
    winners = row_index(keyed.filter(drawn), key, "rank")
    columns = ["id", "n_words", "n_features", "weight", "score"]
    lost = keyed.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    return lost.union(winners.select(*columns, (F.col("rank") + 1).alias("rank")))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards ``benchmark``, and the rank of those drawn."""
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


QUERIES: list[Callable] = [op11_importance]

#: crc32 by its definition, a byte at a time: ``steps`` are the eight constants whose exclusive
#: or, over the set bits of a byte, is what the byte adds.
_CRC = """
    list_reduce(
      list_concat([4294967295::BIGINT], list_transform(
        range(1, octet_length(encode(f)) + 1),
        lambda i: ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, {bits})
    )
"""


def _crc_sql() -> str:
    steps = []
    for bit in range(8):
        value = 1 << bit
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        steps.append(value)
    bits = f"((xor(c, b) & 1) * {steps[0]}::BIGINT)"
    for bit in range(1, 8):
        bits = f"xor({bits}, ((xor(c, b) >> {bit}) & 1) * {steps[bit]}::BIGINT)"
    return f"xor({_CRC.format(bits=bits)}, 4294967295)"


ORACLES = {
    "op11_importance": rf"""
        WITH texts AS (
          SELECT 0 AS side, doc_id AS id, text FROM documents
          UNION ALL SELECT 1, item_id, text FROM benchmark
        ), split AS (
          SELECT side, id, regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM texts
        ), runs AS (
          SELECT side, id, unnest(list_concat(w,
              list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
              list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
          FROM split
        ), hashed AS (
          SELECT f, {_crc_sql()} % 10000 AS bucket FROM (SELECT DISTINCT f FROM runs)
        ), placed AS (
          SELECT side, id, bucket, count(*) AS n FROM runs JOIN hashed USING (f) GROUP BY ALL
        ), sizes AS (
          SELECT coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s_all,
                 coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t_all FROM placed
        ), counts AS (
          SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s,
                 coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t FROM placed GROUP BY bucket
        ), gained AS (
          SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain
          FROM counts, sizes
        ), weighed AS (
          SELECT id, sum(n * gain)::BIGINT AS weight, sum(n)::BIGINT AS n_features
          FROM placed JOIN gained USING (bucket) WHERE side = 0 GROUP BY id
        ), scores AS (
          SELECT d.id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
                 coalesce(weight, 0) AS weight,
                 coalesce(weight, 0) + floor(-1000 * ln(-ln(
                   (('0x' || sha256('42:' || d.id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
          FROM split d LEFT JOIN weighed w ON w.id = d.id WHERE side = 0
        ), ranked AS (
          SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
                 count(*) FILTER (n_words >= 20) OVER () AS n_able
          FROM scores
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_words >= 20 AND place <= 5 * n_able // 100 THEN place END AS rank
        FROM ranked
    """,
}
