"""Packing of tokenised documents by bin completion.

Documents longer than a sequence are cut into full sequences, the first piece having
the rest. All other pieces are packed into as few sequences as possible. What has to be
decided depends on the lengths alone, so the driver plans with a histogram of at most
``size`` lengths, however many pieces there are: it completes the sequence of the
largest piece left with an undominated filling (of all fillings of one sum, the one with
the largest pieces), best sums first, and repeats the same filling as often as both last.
Branches whose waste can't beat the incumbent are cut; the first incumbent is the
best-fit solution. ``MAX_NODES`` bounds the search; beyond it the incumbent stands.

The plan is a table of slots: for each length, runs of equal slots, with the sequences
and the offset that they stand for. A piece's rank among those of its length is its rank in its
task plus the number in the tasks before; it takes the slot of its rank.

Cases: a null or empty text is its end id alone; repeated rows are packed repeatedly; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinshelf.llm.common import table
from twinshelf.llm.encoding import encoder
from twinshelf.session import scratch_path

SIZE = 2048
MAX_NODES = 3_000

#: A filling: the lengths in one sequence, and how many sequences are filled like that.
Filling = tuple[tuple[int, ...], int]


def best_fit(counts: dict[int, int], size: int) -> list[Filling]:
    """Best-fit decreasing on a histogram: each length into the fullest sequences it fits."""
    open_: dict[int, Counter] = {}  # room left: contents of such sequences
    full: Counter = Counter()

    def put(content: tuple[int, ...], room: int, n: int) -> None:
        if room:
            open_.setdefault(room, Counter())[content] += n
        else:
            full[content] += n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r, c in open_.items() if r >= length and c), default=None)
            if room is None:
                each = size // length
                put((length,) * each, size - each * length, left // each)
                if left % each:
                    put((length,) * (left % each), size - left % each * length, 1)
                break
            content, n = open_[room].popitem()
            fits = room // length
            n_full = min(n, left // fits)
            if n_full:
                put(content + (length,) * fits, room - fits * length, n_full)
                left -= n_full * fits
                n -= n_full
            if n and left:  # fewer than one sequence takes
                put(content + (length,) * left, room - left * length, 1)
                n, left = n - 1, 0
            if n:
                open_[room][content] += n
    done = [*full.items(), *((c, n) for held in open_.values() for c, n in held.items())]
    return [(c, n) for c, n in done if n]


def fillings(counts: np.ndarray, room: int) -> Iterator[tuple[int, ...]]:
    """Undominated fillings of a room: for each reachable sum, fullest first, the one with
    the largest pieces."""
    lengths = [int(x) for x in np.flatnonzero(counts[: room + 1])]
    reach, sums = [1], 1  # bit s: some of the lengths so far add up to s
    mask = (1 << (room + 1)) - 1
    for x in lengths:
        left, step = min(int(counts[x]), room // x), 1
        while left:
            take = min(step, left)
            sums |= (sums << (take * x)) & mask
            left -= take
            step *= 2
        reach.append(sums)
    for total in range(room, -1, -1):
        if not reach[-1] >> total & 1:
            continue
        content, rest = [], total
        for k in range(len(lengths) - 1, -1, -1):
            x, n = lengths[k], 0
            while rest >= x and n < counts[x] and (reach[k] >> rest & 1 == 0 or _prefer(reach[k], rest, x, n, counts[x])):
                rest -= x
                n += 1
            content += [x] * n
            if not rest:
                break
        yield tuple(content)


def _prefer(below: int, rest: int, x: int, n: int, count: int) -> bool:
    """Whether one more of the larger length still leaves a sum that smaller ones reach."""
    return any(below >> (rest - j * x) & 1 for j in range(1, min(rest // x, int(count) - n) + 1))


def complete(counts: dict[int, int], size: int, max_nodes: int = MAX_NODES) -> list[Filling]:
    """Fillings that use up the histogram, in as few sequences as the search finds."""
    best = best_fit(counts, size)
    n_best = sum(n for _, n in best)
    total = sum(x * n for x, n in counts.items())
    least = -(-total // size)
    left = np.zeros(size + 1, np.int64)
    for x, n in counts.items():
        left[x] = n
    path: list[tuple[Filling, Iterator]] = []
    used, waste, nodes = 0, 0, 0
    choices = None  # of the sequence to be completed now
    while n_best > least:
        nodes += 1
        rest = np.flatnonzero(left)
        if not len(rest) and choices is None:
            if used < n_best:
                best, n_best = [f for f, _ in path], used
        filling = None
        if len(rest) and (choices is not None or waste + total <= (n_best - 1) * size):
            largest = int(rest[-1])
            if choices is None:
                left[largest] -= 1
                choices = fillings(left.copy(), size - largest)
                left[largest] += 1
            filling = next(choices, None)
        if filling is not None:
            content = (largest, *filling)
            need = Counter(content)
            n = min(int(left[x]) // k for x, k in need.items())
            lost = (size - sum(content)) * n
            if waste + lost + total <= (n_best - 1) * size:
                for x, k in need.items():
                    left[x] -= k * n
                path.append(((content, n), choices))
                used, waste, choices = used + n, waste + lost, None
                continue
        # nothing that could beat the incumbent is left here: undo the last filling
        if not path or nodes > max_nodes:
            break
        (content, n), choices = path.pop()
        for x in content:
            left[x] += n
        used, waste = used - n, waste - (size - sum(content)) * n
    return best


def slots_of(plan: list[Filling], first: int) -> dict[str, np.ndarray]:
    """For each length, runs of slots by rank: length, from, sequence, step and offset.

    A slot's run covers ``n`` sequences; the piece of rank from + i goes to sequence + i.
    """
    rows, seen, sequence = [], Counter(), first
    for content, n in plan:
        offset = 0
        for x in content:
            rows.append((x, seen[x], sequence, offset))
            seen[x] += n
            offset += x
        sequence += n
    rows.sort()
    names = ("length", "first", "sequence", "offset")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 4).T))


def tokenise(docs: DataFrame, path: str, end_id: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces: id, piece, start, length, ids (32-bit, little-endian), task and rank in it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(path), np.array([end_id], "<u4").tobytes()
        task, ranks = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            row, out = [], {k: [] for k in ("piece", "start", "length", "ids", "rank")}
            for at, text in enumerate(batch.column(1).to_pylist()):
                ids = own.ids(text) + end
                n = len(ids) // 4
                edges = [0, *range(n % size or size, n, size), n]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    row.append(at)
                    for key, value in (("piece", piece), ("start", a), ("length", b - a),
                                       ("ids", ids[4 * a : 4 * b]), ("rank", ranks[b - a])):
                        out[key].append(value)
                    ranks[b - a] += 1
            arrays = [batch.column(0).take(pa.array(row, pa.int64()))]
            arrays += [pa.array(out[k], t) for k, t in (
                ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()))]
            arrays += [pa.array([task] * len(row), pa.int32()), pa.array(out["rank"], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "piece", "start", "length", "ids", "task", "rank"])

    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(cut, f"id {kind}, piece int, start long, length long, ids binary, task int, rank long")


def pack(
    docs: DataFrame, path: str, *, end_id: int, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces with their place: id, piece, start, length, ids, sequence_id, offset."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "pieces")
    # written once: ranks inside a task depend on the order in which its rows came
    tokenise(docs, path, end_id, size, id_col, text_col).write.option("compression", "zstd").parquet(folder)
    pieces = spark.read.parquet(folder)
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    n_full = counts.pop(size, 0)  # nothing fits beside these
    plan = complete(counts, size) + ([((size,), n_full)] if n_full else [])
    slots = spark.sparkContext.broadcast(slots_of(plan, 0))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slots.value
        key = (s["length"] << 44) + s["first"]
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            sequence = s["sequence"][at] + rank - s["first"][at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(s["offset"][at], pa.int64())],
                names=["id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )

    ranked = pieces.join(bases, ["length", "task"]).select(
        "id", "piece", "start", "length", "ids", (F.col("base") + F.col("rank")).alias("rank")
    )
    kind = pieces.schema["id"].dataType.simpleString()
    placed = ranked.mapInArrow(
        place, f"id {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long"
    )
    return placed.withColumnRenamed("id", id_col)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    import public_tokenizers

    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


QUERIES: list[Callable] = [op5_packing]
