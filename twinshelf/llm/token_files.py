"""Token ids as Arrow files of fixed-size lists.

Documents are ranged by id into shards. A shard is one Arrow IPC file whose batches hold
``BATCH`` sequences of ``length`` ids and as many mask bits, so sequence k is row k mod
``BATCH`` of batch k div ``BATCH``: a reader maps the file and takes it without a copy or a
parse. The documents of a shard follow each other gaplessly; the rest of its last sequence
is masked out. Beside it, an index file has each document's id, start and number of ids.

Files are written into the shared folder under names of their own for each attempt; the
manifest, committed by Spark, lists those of the attempts that counted. What a lost
executor leaves behind is in no manifest.

Cases: a null text counts as empty and is its end id alone; null ids come first; rows of
one id are ordered by text; repeated rows are written repeatedly; an empty table gives a
manifest without documents; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.llm.common import partitions, stored, table
from twinshelf.llm.encoding import encoder
from twinshelf.session import scratch_path

LENGTH = 2048
BATCH = 512


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it; a path without a scheme is a local one."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class ShardWriter:
    """Writes ids into sequences of equal length, a batch at a time."""

    def __init__(self, sink, kind: pa.DataType, length: int) -> None:
        self.length, self.numpy = length, kind.to_pandas_dtype()
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.file = pa.ipc.new_file(sink, self.schema)
        self.waiting, self.held, self.written = [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.numpy))
        self.held += len(ids)
        size = BATCH * self.length
        if self.held >= size:
            flat = np.concatenate(self.waiting)
            for at in range(0, len(flat) - size + 1, size):
                self._batch(flat[at : at + size], size)
            rest = flat[len(flat) // size * size :]
            self.waiting, self.held = [rest], len(rest)

    def _batch(self, flat: np.ndarray, used: int) -> None:
        mask = np.arange(len(flat)) < used
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (flat, mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.written += used

    def close(self) -> int:
        if self.held:
            flat = np.concatenate(self.waiting)
            self._batch(np.pad(flat, (0, -len(flat) % self.length)), len(flat))
        self.file.close()
        return self.written


def write_files(
    docs: DataFrame, path: str, end_id: int, *, folder: str | None = None, length: int = LENGTH,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write all documents; the manifest: shard, file, index, n_docs, n_ids, start."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}"
        store, at = open_store(name)
        store.create_dir(at.rpartition("/")[0], recursive=True)
        own = encoder(path)
        # two bytes hold every id of a vocabulary below 65,536
        kind = pa.uint16() if max(own.library.get_vocab_size(), end_id + 1) <= 1 << 16 else pa.uint32()
        end = np.array([end_id], "<u4")
        start, n_docs = 0, 0
        schema = None
        with store.open_output_stream(at + ".arrow") as sink, store.open_output_stream(at + ".index") as index:
            writer, entries = ShardWriter(sink, kind, length), None
            for batch in batches:
                starts, sizes = [], []
                for text in batch.column(1).to_pylist():
                    ids = np.frombuffer(own.ids(text), "<u4")
                    writer.add(ids)
                    writer.add(end)
                    starts.append(start)
                    sizes.append(len(ids) + 1)
                    start += len(ids) + 1
                n_docs += len(sizes)
                if entries is None:
                    schema = pa.schema([("id", batch.schema.field(0).type), ("start", pa.int64()), ("n", pa.int64())])
                    entries = pa.ipc.new_file(index, schema)
                entries.write_batch(pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=schema))
            if entries is not None:
                entries.close()
            writer.close()
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "file": [name + ".arrow"], "index": [name + ".index"],
            "n_docs": pa.array([n_docs], pa.int64()), "n_ids": pa.array([start], pa.int64()),
        })

    ranged = (
        docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
        .repartitionByRange(partitions(spark), "id").sortWithinPartitions("id", "text")
    )
    written = stored(
        ranged.mapInArrow(write, "shard int, file string, index string, n_docs long, n_ids long"), "manifest"
    )
    # one row per shard; where each begins follows from the sizes of those before it
    rows = written.filter("n_docs > 0").orderBy("shard").collect()
    starts = list(accumulate((r.n_ids for r in rows), initial=0))
    return spark.createDataFrame(
        [(*r, s) for r, s in zip(rows, starts)],
        "shard int, file string, index string, n_docs long, n_ids long, start long",
    )


def ids_between(file: pa.ipc.RecordBatchFileReader, length: int, start: int, end: int) -> Iterator[np.ndarray]:
    """The ids of a place in a shard, as views of the batches that hold them."""
    size = BATCH * length
    for k in range(start // size, -(-end // size)):
        flat = file.get_batch(k).column(0).flatten().to_numpy()
        yield flat[max(start - k * size, 0) : end - k * size]


def read_files(spark: SparkSession, manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Rows id, start (over all shards), n_tokens, ids_crc32 from the files alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, at = open_store(row["file"])
                local = isinstance(store, fs.LocalFileSystem)
                source = pa.memory_map(at) if local else store.open_input_file(at)
                file = pa.ipc.open_file(source)
                length = file.schema.field("ids").type.list_size
                index = pa.ipc.open_file(store.open_input_file(open_store(row["index"])[1]))
                for k in range(index.num_record_batches):
                    docs = index.get_batch(k)
                    sums = []
                    for start, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist()):
                        crc = 0
                        for part in ids_between(file, length, start, start + n):
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    starts = pa.array(docs.column(1).to_numpy() + row["start"], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [docs.column(0), starts, docs.column(2), pa.array(sums, pa.int64())],
                        names=["id", "start", "n_tokens", "ids_crc32"],
                    )

    dealt = manifest.repartition(partitions(spark), "shard")
    return dealt.mapInArrow(read, f"id {id_type}, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum in the files written for all of them."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    manifest = write_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    found = read_files(spark, manifest, docs.schema["doc_id"].dataType.simpleString())
    return found.withColumnRenamed("id", "doc_id")


QUERIES: list[Callable] = [op6_token_files]
