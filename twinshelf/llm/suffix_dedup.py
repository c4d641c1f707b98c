"""Removal of repeated byte strings by column-wise suffix sorting.

Each byte covered by a ``size``-byte string that also starts elsewhere, in another
document or the same, is removed; strings are judged on the input.

1. *Anchors.* Of the ``GRAM``-byte strings in a window of ``size`` bytes, the one with the least
   hash is the window's anchor. Equal windows have equal anchors, and one anchor stands for
   a run of about 70 windows, so a run (anchor, document, first window, windows) is all that
   is dealt out to find the anchors that occur more than once. Runs of other anchors have
   no repeated window and end here.
2. *Shards.* The bytes under each remaining run, a fragment of at most 336 bytes, go
   to the shard of its anchor, equal fragments of a task as one. Equal fragments are
   repeated as a whole. Different fragments of an anchor are sorted together.
3. *Column-wise construction* (``sort_columns``). A symbol is ``WIDE`` bytes, and a fragment is
   ``WIDE`` strings, one for each place in a symbol where it may end. Strings are aligned at their ends; each round
   puts one more symbol in front of every string's suffix and inserts it where the
   collection's Burrows-Wheeler transform says, by one stable sequential pass over the transform,
   with the common prefixes of the new suffix and its successor updated from range minima.
   A suffix that shares ``size`` bytes with a neighbour starts a repeated window. The suffixes are
   those of single bytes, one for each place, but a round inserts ``WIDE`` of a fragment, so that the passes go
   over ``WIDE`` times fewer rows in all. A collection is
   sorted as soon as it has ``MAX_FRAGMENTS``, so the two sequential files, the transform and the
   common prefixes, are arrays of some ten thousand entries; there is no need to keep them on disk.
4. *Hot anchors* with more than ``MAX_DISTINCT`` different fragments (a passage in very many
   documents, each with other words around it) have no bound there. Their windows are dealt
   out by a hash of all ``size`` bytes, many in a row, and counted.

Cases: a null text is empty; texts shorter than a window lose nothing; repeated rows repeat
each other; rows of one id must have one text; a row without an id is a document of its own
text (inside, its key is below any id of more than -2^62); an empty table gives an empty result;
other columns are ignored. Ids are integers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.llm import hashing
from twinshelf.llm.common import partitions, stored, table
from twinshelf.llm.regroup import FOUND, Outbox, by_document, slots_for
from twinshelf.llm.substring_dedup import BUCKET_BYTES, CHUNK, FEWEST_BITS, chunk_rows, packed, unpacked

SIZE = 200
GRAM = 64
PIECE = 1 << 21  # bytes of a text taken at a time; a place in it takes 22 bits
PLACE = np.uint64((1 << 22) - 1)
MAX_DISTINCT = 256
MAX_FRAGMENTS = 128
WIDE = 8  # most bytes in a symbol, a power of two up to a machine word


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive values, by doubling."""
    have = 1
    while have < size:
        step = min(have, size - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def runs(data: np.ndarray, size: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, first window, windows, tied) of the windows of a text, piece by piece.

    ``tied``: the anchor is at several places under the run, so that windows of the run
    itself may be equal.
    """
    span = size - gram + 1
    for at in range(0, len(data) - size + 1, PIECE):
        part = data[at : at + PIECE + size - 1].astype(np.uint64) + np.uint64(1)
        grams = hashing.windows(part, gram)
        place = np.arange(len(grams), dtype=np.uint64)
        # the first of the least: ties in the hash go to the left, in equal windows alike
        place = (sliding_least((grams & ~PLACE) | place, span) & PLACE).astype(np.int64)
        anchor = grams[place]
        new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        first = np.flatnonzero(new)
        n = np.diff(first, append=len(anchor))
        if n.max() > span:  # one anchor all along, as in a text of one letter
            parts = [np.arange(a, a + k, span) for a, k in zip(first, n)]
            ends = first + n
            n = np.concatenate([np.diff(p, append=e) for p, e in zip(parts, ends)])
            first = np.concatenate(parts)
        tied = place[first] != place[first + n - 1]
        yield anchor[first], first + at, n, tied


def run_rows(texts: DataFrame, size: int, gram: int, bits: int) -> DataFrame:
    """Runs by bucket of their anchor: hashes, ids, first windows, and windows with the tie."""
    names = ["bucket", "n", "h", "ids", "starts", "sizes"]

    def flush(waiting: list) -> pa.RecordBatch:
        rows = []
        if waiting:
            waiting.sort(key=lambda x: x[0])
            h = np.concatenate([x[1] for x in waiting])
            ids = np.repeat(np.array([x[0] for x in waiting], np.int64), [len(x[1]) for x in waiting])
            starts = np.concatenate([x[2] for x in waiting]).astype(np.uint32)
            sizes = np.concatenate([x[3] | (x[4].astype(np.int64) << 15) for x in waiting]).astype(np.uint16)
            bucket = (h >> np.uint64(64 - bits)).astype(np.uint32)
            order = np.argsort(bucket, kind="stable")
            bucket, h, ids, starts, sizes = (x[order] for x in (bucket, h, ids, starts, sizes))
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            low = h.view(np.uint8).reshape(-1, 8)[:, :7]
            for a, b in zip([0, *cuts], [*cuts, len(h)]):
                rows.append((int(bucket[a]), b - a, low[a:b].tobytes(), packed(np.diff(ids[a:b], prepend=0)),
                             packed(starts[a:b]), packed(sizes[a:b])))
        columns = list(zip(*rows)) or [[]] * 6
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                for found in runs(data, size, gram):
                    waiting.append((i, *found))
                held += len(data)
                if held >= 4 * CHUNK:
                    yield flush(waiting)
                    waiting, held = [], 0
        yield flush(waiting)

    return texts.mapInArrow(compute, "bucket int, n int, h binary, ids binary, starts binary, sizes binary")


def repeated_runs(rows: DataFrame) -> DataFrame:
    """(id, anchors, starts, sizes): runs whose anchor occurs more than once."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []

        def close() -> pa.RecordBatch:
            low = np.frombuffer(b"".join(p[1] for p in parts), np.uint8).reshape(-1, 7)
            h = np.zeros((len(low), 8), np.uint8)
            h[:, :7] = low
            h = h.view(np.uint64).reshape(-1) | (np.uint64(bucket & 0xFF) << np.uint64(56))
            ids = np.concatenate([np.cumsum(unpacked(p[2], np.int64)) for p in parts])
            starts = np.concatenate([unpacked(p[3], np.uint32) for p in parts])
            sizes = np.concatenate([unpacked(p[4], np.uint16) for p in parts])
            parts.clear()
            _, where, n = np.unique(h, return_inverse=True, return_counts=True)
            keep = np.flatnonzero((n[where] > 1) | (sizes >> 15 > 0))
            keep = keep[np.argsort(ids[keep], kind="stable")]
            h, ids, starts, sizes = (x[keep] for x in (h, ids, starts, sizes))
            cuts = np.flatnonzero(np.diff(ids)) + 1 if len(ids) else np.empty(0, np.int64)
            edges = list(zip([0, *cuts], [*cuts, len(ids)])) if len(ids) else []
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[a] for a, _ in edges], pa.int64()),
                 *(pa.array([x[a:b].tobytes() for a, b in edges], pa.binary()) for x in (h, starts, sizes))],
                names=["id", "anchors", "starts", "sizes"],
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != bucket:
                    if parts:
                        yield close()
                    bucket = row[0]
                parts.append(row[1:])
        if parts:
            yield close()

    n = partitions(rows.sparkSession)
    dealt = rows.repartition(n, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(judge, "id long, anchors binary, starts binary, sizes binary")


def document_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, text): the id is the key; rows without one are told apart by their texts."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    own = F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(-(1 << 63))
    return texts.select("id", F.coalesce("id", own).alias("key"), "text")


def fragments(texts: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """(anchor, tied, n, body, ids, starts): bytes under the runs, equal ones of a batch once."""
    gathered = found.groupBy("id").agg(*(F.collect_list(c).alias(c) for c in ("anchors", "starts", "sizes")))
    met = texts.join(gathered.withColumnRenamed("id", "key"), "key").select("key", "text", "anchors", "starts", "sizes")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, tuple[list, list]] = {}
            lists = (batch.column(k).to_pylist() for k in (2, 3, 4))
            for i, text, *blobs in zip(batch.column(0).to_pylist(), batch.column(1), *lists):
                data = text.as_buffer().to_pybytes()
                anchors, starts, sizes = (
                    np.frombuffer(b"".join(b), k) for b, k in zip(blobs, (np.int64, np.uint32, np.uint16))
                )
                for anchor, a, k in zip(anchors.tolist(), starts.tolist(), sizes.tolist()):
                    body = data[a : a + (k & 0x7FFF) + size - 1]
                    ids, places = seen.setdefault((anchor, body, k), ([], []))
                    ids.append(i)
                    places.append(a)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in seen], pa.int64()), pa.array([x[2] >> 15 > 0 for x in seen], pa.bool_()),
                 pa.array([x[1] for x in seen], pa.binary()),
                 pa.array([np.array(x[0], np.int64).tobytes() for x in seen.values()], pa.binary()),
                 pa.array([np.array(x[1], np.uint32).tobytes() for x in seen.values()], pa.binary())],
                names=["anchor", "tied", "body", "ids", "starts"],
            )

    return met.mapInArrow(cut, "anchor long, tied boolean, body binary, ids binary, starts binary")


def least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of ``values[first : last + 1]`` for each pair, from the least over powers of two."""
    level = (np.frexp(last - first + 1)[1] - 1).astype(np.int64)
    table = np.empty((int(level.max()) + 1, len(values)), values.dtype)
    table[0] = values
    for k in range(len(table) - 1):
        step = 1 << k
        np.minimum(table[k, :-step], table[k, step:], out=table[k + 1, :-step])
    flat, row = table.reshape(-1), level * len(values)
    return np.minimum(flat.take(row + first), flat.take(row + last + 1 - (1 << level)))


def columns(bodies: list[bytes], wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of ``wide`` bytes by distance from the end, and how many each string has.

    A body is ``wide`` strings, read from its end and from the ``wide - 1`` places before it,
    so that a symbol starts at every place. Symbols are numbered; the last number is the end.
    """
    data = np.frombuffer(b"".join(bodies), np.uint8)
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, wide)).view(f"u{wide}").reshape(-1)
    known, symbol = np.unique(grams, return_inverse=True)
    sizes = np.array([len(b) for b in bodies])
    skipped = np.arange(wide)
    lengths = ((sizes[:, None] - skipped) // wide).reshape(-1)
    ends = (np.cumsum(sizes)[:, None] - skipped).reshape(-1)
    before = np.full((int(lengths.max()) + 2, len(ends)), len(known), np.min_scalar_type(len(known)))
    back = np.arange(1, len(before) - 1)[:, None]
    live = back <= lengths
    before[1:-1][live] = symbol.take((ends - wide * back)[live])
    return before, lengths


def sort_columns(bodies: list[bytes], size: int) -> np.ndarray:
    """For each body and each place in it: does the window there occur again in the bodies?

    Rows are the suffixes inserted so far, in order; ``bwt`` has the symbol before each, or
    the end, and ``lcp`` how many symbols (at most a window's) it shares with the row above.
    A symbol is as many bytes, up to ``WIDE``, as divide ``size``: a round then reads so
    many bytes of every string, and there are that much fewer rounds over the rows.
    """
    wide = math.gcd(size, WIDE)
    need = size // wide
    before, lengths = columns(bodies, wide)
    m, rounds, end = len(lengths), len(before) - 2, before[-1, 0]
    bwt, lcp = before[1].copy(), np.zeros(m, np.uint8)
    newest, who = np.arange(m), np.arange(m)
    for j in range(1, rounds + 1):
        order = np.argsort(bwt, kind="stable")
        order = order[: len(order) - np.count_nonzero(lengths < j)]
        fresh = np.zeros(len(bwt), bool)
        fresh[newest] = True
        fresh = fresh.take(order)
        at, old = np.flatnonzero(fresh), ~fresh
        parents = order.take(at)
        who = who[np.searchsorted(newest, parents)]
        grown = np.empty(m + len(order), bwt.dtype)
        grown[:m] = bwt[:m]
        tail = grown[m:]
        tail[old] = bwt[m:]
        tail[at] = before[j + 1, who]
        shared = np.zeros(m + len(order), np.uint8)
        own = shared[m:]
        own[old] = lcp[m:]
        # new rows and the rows below them: one more than the least between their parents
        fresh[1:] |= ~old[:-1]
        change = np.flatnonzero(fresh)
        inner = change[change > 0]
        low, high = order.take(inner - 1), order.take(inner)
        same = bwt.take(low) == bwt.take(high)
        own[change] = 0
        inner, low, high = inner[same], low[same], high[same]
        if len(inner):
            own[inner] = np.minimum(least_between(lcp, low + 1, high), need - 1) + 1
        bwt, lcp, newest = grown, shared, m + at
    order = np.argsort(bwt, kind="stable")
    order = order[: len(order) - np.count_nonzero(bwt == end)]
    longer = np.zeros(len(bwt), np.int64)  # row of a suffix with one more symbol
    longer[order] = m + np.arange(len(order))
    again = lcp >= need
    again[:-1] |= again[1:].copy()
    sizes = np.array([len(b) for b in bodies])
    out = np.zeros((len(bodies), int(sizes.max()) - size + 1), bool)
    row, live = np.arange(m), np.arange(m)
    for j in range(1, rounds + 1):
        keep = lengths[live] >= j
        row, live = longer[row[keep]], live[keep]
        if j >= need:
            body, skipped = np.divmod(live, wide)
            out[body, sizes[body] - skipped - wide * j] = again[row]
    return out


class Shards:
    """Judges the fragments of one anchor after another; results and leftovers are drained."""

    def __init__(self, size: int, max_distinct: int = MAX_DISTINCT) -> None:
        self.size, self.max_distinct = size, max_distinct
        self.waiting: list[tuple[bytes, list]] = []  # fragments to be sorted with others
        self.done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # ids, first windows, windows
        self.hot: list[tuple[int, int, bytes]] = []  # id, first window, bytes
        self.start()

    def start(self) -> None:
        self.distinct: dict[bytes, list] = {}
        self.tied = self.is_hot = False

    def add(self, tied: bool, body: bytes, ids: np.ndarray, starts: np.ndarray) -> None:
        self.tied |= tied
        if body in self.distinct:
            self.distinct[body].append((ids, starts))
        elif len(self.distinct) < self.max_distinct and not self.is_hot:
            self.distinct[body] = [(ids, starts)]
        else:
            if not self.is_hot:
                self.is_hot = True
                for known, places in self.distinct.items():
                    for x in places:
                        self.pass_on(known, *x)
                self.distinct = {}
            self.pass_on(body, ids, starts)

    def pass_on(self, body: bytes, ids: np.ndarray, starts: np.ndarray) -> None:
        """To the count of whole windows; what is known to be repeated is settled here."""
        if len(ids) > 1:
            self.settle(body, [(ids, starts)])
        self.hot.append((int(ids[0]), int(starts[0]), body))

    def settle(self, body: bytes, places: list, windows: np.ndarray | None = None) -> None:
        n = len(body) - self.size + 1
        ids, starts = (np.concatenate([p[k] for p in places]).astype(np.int64) for k in (0, 1))
        first, count = (np.array([0]), np.array([n])) if windows is None else stretches(windows[:n])
        if len(first):
            self.done.append((
                np.repeat(ids, len(first)), (starts[:, None] + first[None, :]).ravel(), np.tile(count, len(ids))
            ))

    def close(self) -> None:
        """The anchor has no more fragments."""
        for body, places in self.distinct.items():
            if sum(len(x[0]) for x in places) > 1:
                self.settle(body, places)
        if len(self.distinct) > 1 or self.tied:
            self.waiting += self.distinct.items()
        self.start()
        if len(self.waiting) >= MAX_FRAGMENTS:
            self.sort()

    def sort(self) -> None:
        if self.waiting:
            windows = sort_columns([body for body, _ in self.waiting], self.size)
            for (body, places), found in zip(self.waiting, windows):
                if found.any():
                    self.settle(body, places, found)
            self.waiting = []


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the true runs start and how long they are."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    first = np.flatnonzero(edge == 1)
    return first, np.flatnonzero(edge == -1) - first


def judge_fragments(rows: DataFrame, size: int, max_distinct: int) -> DataFrame:
    """Repeated windows by slot of their document, and (id, start, body) of hot anchors."""
    slots = slots_for(rows)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, anchor, out = Shards(size, max_distinct), None, Outbox(slots)

        def drain() -> Iterator[pa.RecordBatch]:
            for found in shards.done:
                out.add(*found)
            hot, shards.done, shards.hot = shards.hot, [], []
            if hot:
                rest = [pa.nulls(len(hot), k) for k in (pa.int32(), *[pa.binary()] * 3)]
                own = [pa.array(c, k) for c, k in zip(zip(*hot), (pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([*rest, *own], names=names)

        def send() -> pa.RecordBatch:
            sent = out.send()
            rest = [pa.nulls(sent.num_rows, k) for k in (pa.int64(), pa.int64(), pa.binary())]
            return pa.RecordBatch.from_arrays([*sent.columns, *rest], names=names)

        for batch in batches:
            for key, tied, body, ids, starts in zip(*(c.to_pylist() for c in batch.columns)):
                if key != anchor:
                    shards.close()
                    anchor = key
                shards.add(tied, body, np.frombuffer(ids, np.int64), np.frombuffer(starts, np.uint32))
            yield from drain()
            if out.full():
                yield send()
        shards.close()
        shards.sort()
        yield from drain()
        yield send()

    names = ["slot", "ids", "starts", "counts", "id", "start", "body"]
    n = partitions(rows.sparkSession)
    dealt = rows.repartition(n, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(judge, f"{FOUND}, id long, start long, body binary")


def count_windows(hot: DataFrame, size: int, bits: int) -> DataFrame:
    """Windows of ``hot`` (id, start, body) that occur more than once, by slot."""
    slots = slots_for(hot)
    names = ["bucket", "n", "h", "ids", "places"]

    def flush(waiting: list) -> pa.RecordBatch:
        # a document's windows side by side; those of overlapping fragments once
        by_id: dict[int, list] = {}
        for i, start, h in waiting:
            by_id.setdefault(i, []).append((start + np.arange(len(h)), h))
        rows = []
        for i, found in by_id.items():
            places, at = np.unique(np.concatenate([x[0] for x in found]), return_index=True)
            rows.append((i, np.concatenate([x[1] for x in found])[at], places.astype(np.uint32)))
        columns = list(zip(*chunk_rows(rows, bits))) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            for i, start, body in zip(*(c.to_pylist() for c in batch.columns)):
                h = hashing.windows(np.frombuffer(body, np.uint8).astype(np.uint64) + np.uint64(1), size)
                waiting.append((i, start, h))
                held += len(h)
                if held >= CHUNK // 4:
                    yield flush(waiting)
                    waiting, held = [], 0
        yield flush(waiting)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, out = None, [], Outbox(slots)

        def close() -> None:
            low = np.frombuffer(b"".join(p[1] for p in parts), np.uint8).reshape(-1, 7)
            h = np.zeros((len(low), 8), np.uint8)
            h[:, :7] = low
            ids = np.concatenate([np.cumsum(unpacked(p[2], np.int64)) for p in parts])
            places = np.concatenate([unpacked(p[3], np.uint32) for p in parts])
            parts.clear()
            _, where, n = np.unique(h.view(np.uint64).reshape(-1), return_inverse=True, return_counts=True)
            keep = n[where] > 1
            out.add(ids[keep], places[keep], np.ones(int(keep.sum()), np.int64))

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

    dealt = hot.mapInArrow(deal, "bucket int, n int, h binary, ids binary, places binary")
    dealt = dealt.repartition(partitions(hot.sparkSession), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(judge, FOUND)


def spans(starts: np.ndarray, counts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by windows, from runs of window starts."""
    order = np.argsort(starts, kind="stable")
    first, last = starts[order], (starts + counts - 1 + size)[order]
    reach = np.maximum.accumulate(last)
    new = np.concatenate([[True], first[1:] > reach[:-1]])
    begin = np.flatnonzero(new)
    return list(zip(first[begin].tolist(), reach[np.append(begin[1:], len(first)) - 1].tolist()))


def remove_repeats(
    docs: DataFrame, *, size: int = SIZE, gram: int = GRAM, max_distinct: int = MAX_DISTINCT,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Id, length in bytes, removed spans (first byte, byte after the last) and the kept bytes."""
    texts = document_key(docs, id_col, text_col)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(FEWEST_BITS, math.ceil(math.log2(max(total, 1) / (16 * BUCKET_BYTES))))
    found = repeated_runs(run_rows(texts.select("key", "text"), size, gram, bits))
    judged = stored(judge_fragments(fragments(texts, found, size), size, max_distinct), "judged-windows")
    hot = judged.filter("body is not null").select("id", "start", "body")
    gone = judged.filter("slot is not null").select("slot", "ids", "starts", "counts")
    by_id = by_document(gone.union(count_windows(hot, size, FEWEST_BITS))).withColumnRenamed("id", "key")
    met = texts.join(by_id, "key", "left").select("id", "text", "starts", "counts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_bytes": [], "spans": [], "kept": []}
            gone = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for text, blobs in zip(batch.column(1), gone):
                data = text.as_buffer().to_pybytes()
                found = []
                if blobs[0]:
                    starts, n = (np.frombuffer(b, np.uint32).astype(np.int64) for b in blobs)
                    found = [(a, min(b, len(data))) for a, b in spans(starts, n, size) if a < len(data)]
                edges = [0, *(x for s in found for x in s), len(data)]
                out["n_bytes"].append(len(data))
                out["spans"].append([{"start": a, "end": b} for a, b in found])
                out["kept"].append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out["n_bytes"], pa.int64()),
                 pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(out["kept"], pa.binary())],
                names=["id", "n_bytes", "spans", "kept"],
            )

    done = met.mapInArrow(cut, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return done.withColumnRenamed("id", id_col)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What strings of 200 bytes that occur again leave of every document."""
    cut = remove_repeats(table(spark, sf_dir, "documents"), size=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES: list[Callable] = [op2_suffix_dedup]
