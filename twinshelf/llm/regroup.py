"""Places found in many shards, brought together by document.

A task sends what it has found as one row per slot, a slot being a fixed share of the ids, so
that the rows that travel are bounded by tasks times slots and not by documents times tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from twinshelf.llm.common import partitions
from twinshelf.llm.hashing import mix

FOUND = "slot int, ids binary, starts binary, counts binary"


class Outbox:
    """Finds (id, start, count) of one task, sent when ``most`` of them wait."""

    def __init__(self, slots: int, most: int = 2_000_000) -> None:
        self.slots, self.most = slots, most
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((ids, starts, counts))
        self.held += len(ids)

    def full(self) -> bool:
        return self.held >= self.most

    def send(self) -> pa.RecordBatch:
        rows = []
        if self.held:
            ids, starts, counts = (np.concatenate([w[k] for w in self.waiting]).astype(np.int64) for k in range(3))
            slot = (mix(ids.view(np.uint64)) % np.uint64(self.slots)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            slot, ids, starts, counts = (x[order] for x in (slot, ids, starts, counts))
            cuts = np.flatnonzero(np.diff(slot)) + 1
            rows = [
                (int(slot[a]), ids[a:b].tobytes(), starts[a:b].astype(np.uint32).tobytes(), counts[a:b].astype(np.uint32).tobytes())
                for a, b in zip([0, *cuts], [*cuts, len(ids)])
            ]
        self.waiting, self.held = [], 0
        columns = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, [pa.int32(), *[pa.binary()] * 3])],
            names=["slot", "ids", "starts", "counts"],
        )


def slots_for(docs: DataFrame) -> int:
    return 2 * partitions(docs.sparkSession)


def by_document(found: DataFrame) -> DataFrame:
    """(id, starts, counts): one row per document of the rows that outboxes have sent."""

    def rows(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, starts, counts = (
            np.frombuffer(b"".join(p[k] for p in parts), kind)
            for k, kind in enumerate((np.int64, np.uint32, np.uint32))
        )
        order = np.lexsort((starts, ids))
        ids, starts, counts = ids[order], starts[order], counts[order]
        cuts = np.flatnonzero(np.diff(ids)) + 1
        edges = list(zip([0, *cuts], [*cuts, len(ids)]))
        for at in range(0, len(edges), 10_000):
            some = edges[at : at + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[a] for a, _ in some], pa.int64()),
                 *(pa.array([x[a:b].tobytes() for a, b in some], pa.binary()) for x in (starts, counts))],
                names=["id", "starts", "counts"],
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, parts = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != slot:
                    if parts:
                        yield from rows(parts)
                    slot, parts = row[0], []
                parts.append(row[1:])
        if parts:
            yield from rows(parts)

    n = partitions(found.sparkSession)
    dealt = found.repartition(n, "slot").sortWithinPartitions("slot")
    return dealt.mapInArrow(merge, "id long, starts binary, counts binary")
