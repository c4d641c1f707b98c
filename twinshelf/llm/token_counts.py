"""Token counts without a shuffle: a broadcast table of frequent pre-tokens, then a
cache in each worker.

The model never joins a character to a following word boundary (``check_model`` makes
sure of it), so a text is the sum of its pre-tokens: runs of spaces with the word behind
them. Lengths of frequent pre-tokens are broadcast once as a hash table of at most
``table_size`` entries; any other pre-token is encoded once per worker and remembered in
a cache of at most ``CACHE_SIZE`` entries. Only the lengths travel, no pre-token does.

Cases: a null text counts as empty and has 0 tokens; repeated rows give repeated rows;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.llm.common import table

CACHE_SIZE = 400_000
#: Longer pre-tokens are encoded each time, so that one strange text can't fill the cache.
CACHED_CHARS = 64
MARK = "▁"
PRE_TOKEN = re.compile(" +[^ ]*")


@lru_cache(maxsize=2)
def load_model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_model(path: str) -> None:
    """Refuse a model for which pre-tokens are not independent of each other."""
    model = load_model(path)
    joined = [
        p for p in map(model.id_to_piece, range(model.get_piece_size())) if MARK in p.lstrip(MARK)
    ]
    spaces = model.encode("a  b", out_type=str)
    if joined or "".join(spaces) != MARK + "a" + 2 * MARK + "b":
        raise ValueError(f"{path}: pieces cross word boundaries: {joined[:3] or spaces}")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens without the first space of each; the model puts one before the text."""
    if MARK in text:
        text = text.replace(MARK, " ")
    words = text.split(" ")
    if "" in words:
        return [x[1:] for x in PRE_TOKEN.findall(" " + text)]
    return words


class WorkerCache(dict):
    """Pre-token to length: the first tier's entries, then what this worker has met."""

    def __init__(self, frequent: dict[str, int], model) -> None:
        super().__init__(frequent)
        self.frequent, self.model = frequent, model

    def __missing__(self, word: str) -> int:
        # a lone space is a token of its own; the library would see an empty text
        n = len(self.model.encode(word)) if word else 1
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHE_SIZE + len(self.frequent):
                self.clear()
                self.update(self.frequent)
            self[word] = n
        return n


_caches: dict[tuple, WorkerCache] = {}


def worker_cache(key: tuple[str, str], frequent: Broadcast) -> WorkerCache:
    """The cache of this worker process, kept from task to task of one run."""
    if key not in _caches:
        _caches.clear()
        _caches[key] = WorkerCache(frequent.value, load_model(key[0]))
    return _caches[key]


def frequent_lengths(texts: DataFrame, path: str, sample_docs: int, table_size: int) -> dict:
    """Lengths of the most frequent pre-tokens of ``sample_docs`` texts.

    The sample only decides what is found in the first tier; counts don't depend on it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(x for x in pre_tokens(text) if len(x) <= CACHED_CHARS)
        cache = WorkerCache({}, load_model(path))
        top = [x for x, _ in seen.most_common(table_size)]
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(top, pa.string()), "n": pa.array([cache[x] for x in top], pa.int32())}
        )

    sample = texts.filter("text is not null and text <> ''").limit(sample_docs).coalesce(1)
    return {r.word: r.n for r in sample.mapInArrow(count, "word string, n int").collect()}


def count_tokens(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
    sample_docs: int = 2_000, table_size: int = 65_536,
) -> DataFrame:
    """Id, UTF-8 bytes and tokens of each text."""
    check_model(path)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(
        frequent_lengths(texts.select("text"), path, sample_docs, table_size)
    )

    key = (path, uuid.uuid4().hex)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = worker_cache(key, frequent).__getitem__
        for batch in batches:
            tokens = [
                sum(map(lengths, pre_tokens(x))) if x else 0 for x in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(tokens, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    kind = texts.schema["id"].dataType.simpleString()
    return (
        texts.withColumn("n_bytes", F.octet_length("text").cast("long"))
        .mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
        .withColumnRenamed("id", id_col)
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document under the 32k piece vocabulary."""
    import public_tokenizers

    counts = count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


QUERIES: list[Callable] = [op8_token_counts]
