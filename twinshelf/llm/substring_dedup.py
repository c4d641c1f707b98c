"""Removal of repeated passages by Rabin-Karp hashes of word windows.

Every window of ``size`` consecutive words of a document is hashed. Windows are dealt
by the leading bits of their hash into buckets, all windows of a hash into one, where
those that also start in a document with a smaller id are found. A window's words go;
windows that touch or overlap merge into maximal intervals. Windows are judged on the
input, not on what is left.

A window travels as 7 bytes of hash (the bucket holds the rest) and the compressed
differences of ids and places: windows of about 4 MB of text are sent together, a row
per bucket. The number of buckets grows with the text, so that a bucket holds the
windows of about 32 MB. A window that a third of all documents share is at most one
in as many windows as a document has words, so no bucket stands out. Texts move once, to
meet the places found in them.

Two different windows share a 64-bit hash once in 2**65 / n**2 runs over n windows (one
run in 2,000 for 130 million); for corpora far beyond 10**9 windows two such hashes
would be wanted.

Cases: a null text has no words; documents with fewer words than a window lose nothing;
a null id is smaller than any other; rows of one id are one document, which never
repeats itself: what goes in one of them goes in all; an empty table gives an empty
result; other columns are ignored. Ids are integers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.llm import hashing
from twinshelf.llm.common import partitions, table
from twinshelf.llm.regroup import FOUND, Outbox, by_document, slots_for

CHUNK = 1 << 22
BUCKET_BYTES = 32 << 20
FEWEST_BITS = 10  # at least 8: the top byte of a hash is given by the bucket
NO_ID = np.iinfo(np.int64).min


def packed(values: np.ndarray) -> bytes:
    """Bytes of the values by significance, compressed."""
    return zstandard.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def unpacked(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def chunk_rows(docs: list[tuple[int, np.ndarray, np.ndarray]], bits: int) -> Iterator[tuple]:
    """(bucket, n, hashes, ids, places) of the windows of some documents (id, hashes, places)."""
    docs = [d for d in sorted(docs, key=lambda d: d[0]) if len(d[1])]
    if not docs:
        return
    h = np.concatenate([x for _, x, _ in docs])
    ids = np.repeat(np.array([i for i, _, _ in docs], np.int64), [len(x) for _, x, _ in docs])
    places = np.concatenate([p for _, _, p in docs])
    bucket = (h >> np.uint64(64 - bits)).astype(np.uint32)
    order = np.argsort(bucket, kind="stable")
    bucket, h, ids, places = bucket[order], h[order], ids[order], places[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    low = np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :7]  # little-endian
    for a, b in zip([0, *cuts], [*cuts, len(h)]):
        gaps = np.diff(ids[a:b], prepend=0)
        yield int(bucket[a]), b - a, low[a:b].tobytes(), packed(gaps), packed(places[a:b])


def window_rows(docs: DataFrame, size: int, bits: int) -> DataFrame:
    kind = pa.schema([
        ("bucket", pa.int32()), ("n", pa.int32()), ("h", pa.binary()), ("ids", pa.binary()), ("places", pa.binary())
    ])

    def flush(waiting: list) -> pa.RecordBatch:
        columns = list(zip(*chunk_rows(waiting, bits))) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], schema=kind)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_buffer()
                _, words = hashing.words(data.to_pybytes())
                found = hashing.windows(words, size)
                waiting.append((NO_ID if i is None else i, found, np.arange(len(found), dtype=np.uint32)))
                held += data.size
                if held >= CHUNK:
                    yield flush(waiting)
                    waiting, held = [], 0
        yield flush(waiting)

    return docs.mapInArrow(compute, "bucket int, n int, h binary, ids binary, places binary")


def repeated_in(h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which windows also start in a document with a smaller id."""
    order = np.lexsort((ids, h))
    h, ids = h[order], ids[order]
    first = np.concatenate([[True], h[1:] != h[:-1]])
    least = ids[first][np.cumsum(first) - 1]
    out = np.empty(len(h), bool)
    out[order] = ids > least
    return out


def repeats(rows: DataFrame) -> DataFrame:
    """Places of repeated windows, one row per document that has any."""
    slots = slots_for(rows)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, out = None, [], Outbox(slots)

        def close() -> None:
            h = np.zeros((sum(p[0] for p in parts), 8), np.uint8)
            h[:, :7] = np.frombuffer(b"".join(p[1] for p in parts), np.uint8).reshape(-1, 7)
            ids = np.concatenate([np.cumsum(unpacked(p[2], np.int64)) for p in parts])
            places = np.concatenate([unpacked(p[3], np.uint32) for p in parts])
            gone = repeated_in(h.view(np.uint64).reshape(-1), ids)
            out.add(ids[gone], places[gone], np.ones(int(gone.sum()), np.int64))
            parts.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != bucket:
                    if parts:
                        close()
                    bucket = row[0]
                    if out.full():
                        yield out.send()
                parts.append(row[1:])
        if parts:
            close()
        yield out.send()

    n = partitions(rows.sparkSession)
    dealt = rows.repartition(n, "bucket").sortWithinPartitions("bucket")
    return by_document(dealt.mapInArrow(judge, FOUND))


def intervals(places: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs of words covered by windows that start at the places."""
    if not len(places):
        return []
    places = np.unique(places).astype(np.int64)
    cut = np.flatnonzero(np.diff(places) > size) + 1
    first, last = places[np.concatenate([[0], cut])], places[np.concatenate([cut - 1, [len(places) - 1]])]
    return [(int(a), int(b) + size) for a, b in zip(first, last)]


def remove_repeats(docs: DataFrame, *, size: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, words, removed intervals (first word, word after the last) and the kept text."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(FEWEST_BITS, math.ceil(math.log2(max(total, 1) / BUCKET_BYTES)))
    found = repeats(window_rows(texts, size, bits))
    sent = found.select(F.col("id").alias("__id"), F.col("starts").alias("places"))
    met = texts.join(sent, F.coalesce("id", F.lit(int(NO_ID))) == F.col("__id"), "left").select("id", "text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_words": [], "intervals": [], "kept": []}
            for text, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = text.encode().split()
                spans = intervals(np.frombuffer(places or b"", np.uint32), size)
                spans = [(a, min(b, len(words))) for a, b in spans if a < len(words)]
                out["n_words"].append(len(words))
                out["intervals"].append([{"start": a, "end": b} for a, b in spans])
                for a, b in reversed(spans):
                    del words[a:b]
                out["kept"].append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out["n_words"], pa.int64()),
                 pa.array(out["intervals"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(out["kept"], pa.string())],
                names=["id", "n_words", "intervals", "kept"],
            )

    done = met.mapInArrow(cut, "id long, n_words long, intervals array<struct<start:long,end:long>>, kept string")
    return done.withColumnRenamed("id", id_col)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What 13-word windows of documents with smaller ids leave of every document."""
    cut = remove_repeats(table(spark, sf_dir, "documents"), size=13)
    removed = F.aggregate("intervals", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return cut.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES: list[Callable] = [op7_substring_dedup]

ORACLES = {
    "op7_substring_dedup": r"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), words AS (
          SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d
        ), grams AS (
          SELECT doc_id, place AS i, string_agg(word, ' ') OVER f AS gram, count(*) OVER f AS n
          FROM words
          WINDOW f AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
        ), firsts AS (
          SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS least FROM grams WHERE n = 13
        ), gone AS (
          SELECT DISTINCT doc_id, i + k AS place FROM firsts, range(13) r(k) WHERE least < doc_id
        ), kept AS (
          SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS body
          FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
        ), counts AS (
          SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
               sha256(coalesce(body, '')) AS kept_sha256
        FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
}
