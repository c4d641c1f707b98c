"""NumPy work on one Arrow batch or one cell; imported by the tasks.

Nothing here imports Spark, so a fresh Python worker starts quickly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Scores held at a time inside a task; few enough to stay in the processor cache.
SCORE_BUFFER = 1_000_000
# In single precision as many bytes hold twice as many, and a product of more rows costs less a row.
SINGLE_BUFFER = 4 * SCORE_BUFFER
# Rows of a scanned side scored together.
SCAN_ROWS = 16_384
# Columns whose largest score is looked at first, and how many such groups there are for each hit.
GROUP_COLUMNS, GROUPS_PER_HIT = 32, 8
# Codes ask for many hits; few groups for each still tell the best from the rest.
CODE_GROUPS_PER_HIT = 2
# So many near rows for each hit are looked at before all are, where some are out of reach.
NEAR_PER_HIT = 4
# Lengths of vectors whose products single precision can hold.
LONGEST = 1e15
# Hits that a task makes at a time.
HITS_PER_TASK = 1_000_000
# Bytes of text split at a time inside a task.
TEXT_BUFFER = 4 << 20

# Channel means and deviations of the public ImageNet statistics.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)


def to_matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list<float> column as a float64 matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = len(vectors)
    if rows == 0:
        return flat.reshape(0, 0)
    width, rest = divmod(len(flat), rows)
    lengths = pc.min_max(pc.list_value_length(vectors)).as_py()
    if rest or lengths["min"] != width or lengths["max"] != width:
        raise ValueError(f"vectors of different lengths: {lengths}")
    return flat.reshape(rows, width)


def rounded(scores: np.ndarray) -> np.ndarray:
    """Same rule as ``functions.scores.round_score``."""
    out = np.round(scores, 5)
    large = scores > 1
    out[large] = np.round(scores[large], 1)
    return out


def best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and rounded score of the k best entries per row, best first.

    Best is by rounded score, then by lower column.  Rounding keeps the order, so
    the k-th score is found first and only entries that can round to as much are
    rounded.  Entries above the k-th rounded score are all in; those level with it
    fill up by column, so many copies of a vector cost no sort.  -inf is no hit.
    """
    n = scores.shape[1]
    k = min(k, n)
    kth = np.partition(scores, n - k, axis=1)[:, n - k]
    row, col = np.nonzero(scores >= one_step_below(kth)[:, None])
    return best_entries(row, col, scores[row, col], kth, k)


def one_step_below(score: np.ndarray) -> np.ndarray:
    """A little more than one rounding step below."""
    return score - np.where(score <= 1, 1.1e-5, 0.11)


def best_entries(row: np.ndarray, col: np.ndarray, value: np.ndarray, kth: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """:func:`best_columns` of entries in the order of rows and columns; ``kth`` is the k-th score of each row."""
    rows = len(kth)
    value = rounded(value)
    bar = rounded(kth)[row]
    above = np.flatnonzero(value > bar)
    level = np.flatnonzero((value == bar) & (value > -np.inf))
    free = k - np.bincount(row[above], minlength=rows)
    # entries come in column order, so the place among the level ones is a count
    counts = np.bincount(row[level], minlength=rows)
    place = np.arange(len(level)) - np.repeat(np.cumsum(counts) - counts, counts)
    best = np.concatenate([above, level[place < np.repeat(free, counts)]])
    row, col, value = row[best], col[best], value[best]
    order = np.lexsort((col, -value, row))
    return row[order], col[order], value[order]


def best_of_product(
    q: np.ndarray, db: np.ndarray, single: np.ndarray, longest: float, k: int, floor: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """:func:`best_columns` of ``q @ db.T``; None if it would not pay.

    The product is made in single precision (``single`` is ``db`` in it), which tells the few entries that can
    be among the best; only these are scored in double precision. ``floor`` has a rounded score for each row below
    which entries are of no use; such entries may be left out.
    """
    found = near_entries(q, single, longest, k, floor)
    if found is None:
        return None
    row, col, _ = found
    value = np.einsum("ij,ij->i", q[row], db[col])
    return best_of_entries(row, col, value, len(q), k)[:3]


def near_entries(
    q: np.ndarray, single: np.ndarray, longest: float, k: int, floor: np.ndarray | None = None,
    groups_per_hit: int = GROUPS_PER_HIT,
) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Row and column of all entries of ``q @ db.T`` that reach a bound, in their order, and the bound of each row.

    The bound is a little below the ``floor`` of a row, if it has one, or else below the k-th of the largest entries of
    some groups of columns, which is at most the k-th score, so that few more than ``k`` entries reach it.
    A single product is off by at most (width + 4) / 2^24 of the lengths.
    """
    rows, n = len(q), len(single)
    width = n // GROUP_COLUMNS
    if width < groups_per_hit * k:
        return None
    scores = q.astype(np.float32) @ single.T
    grouped = scores[:, :width * GROUP_COLUMNS].reshape(rows, GROUP_COLUMNS, width)
    tops = grouped.max(axis=1)
    if floor is None or not np.isfinite(floor).all():
        low = np.partition(tops, width - k, axis=1)[:, width - k].astype(np.float64)
        low = low if floor is None else np.where(np.isfinite(floor), floor, low)
    else:
        low = floor
    off = 2.0**-23 * (q.shape[1] + 4) * np.linalg.norm(q, axis=1) * longest
    bound = one_step_below(low - off)
    least = np.nextafter((bound - off - 2.0**-23 * np.abs(low)).astype(np.float32), np.float32(-np.inf))[:, None]
    if not np.isfinite(low).all():
        return None
    # the few groups of columns that have such an entry are looked at
    row, group = np.divmod(np.flatnonzero(tops >= least), width)
    if len(row) > rows * n // GROUP_COLUMNS // 2:
        return None
    place, member = np.nonzero(grouped[row, :, group] >= least[row])
    last, rest = np.nonzero(scores[:, width * GROUP_COLUMNS:] >= least)
    row, col = np.r_[row[place], last], np.r_[member * width + group[place], rest + width * GROUP_COLUMNS]
    if len(row) > rows * n // GROUP_COLUMNS:
        return None
    order = np.argsort(row * n + col)
    return row[order], col[order], bound


def best_of_entries(
    row: np.ndarray, col: np.ndarray, value: np.ndarray, rows: int, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """:func:`best_columns` of entries in the order of rows and columns, and the k-th score of each row, -inf if there are fewer."""
    place = np.arange(len(row)) - np.searchsorted(row, row)
    beside = np.full((rows, max(place.max(initial=0) + 1, k)), -np.inf)
    beside[row, place] = value
    kth = np.partition(beside, beside.shape[1] - k, axis=1)[:, beside.shape[1] - k]
    fit = value >= one_step_below(kth)[row]
    return *best_entries(row[fit], col[fit], value[fit], kth, k), kth


def best_that_fit(
    q: np.ndarray, db: np.ndarray, single: np.ndarray, longest: float, k: int, near: int, floor: np.ndarray | None,
    fits: Callable[[np.ndarray, np.ndarray], np.ndarray], groups_per_hit: int = GROUPS_PER_HIT,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries that fit, of the rows of which they are known, and which rows that are.

    Only the ``near`` best or so of each row are looked at; ``fits`` is told their rows and columns.
    """
    found = near_entries(q, single, longest, min(near, len(db)), floor, groups_per_hit)
    if found is None:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.zeros(len(q), bool)
    row, col, bound = found
    fit = fits(row, col)
    row, col = row[fit], col[fit]
    value = np.einsum("ij,ij->i", q[row], db[col])
    row, col, value, kth = best_of_entries(row, col, value, len(q), k)
    # all entries above the bound are known, and none below it can be as good as the k-th, or as the floor
    done = one_step_below(kth) >= bound
    if floor is not None:
        done |= one_step_below(floor) >= bound
    return row[done[row]], col[done[row]], value[done[row]], done


def by_group(table: pa.Table, keys: Sequence[str]) -> dict[tuple, pa.Table]:
    """Rows of each combination of the key columns."""
    if not keys:
        return {(): table}
    numbered = table.select(keys).append_column("_row", pa.array(np.arange(table.num_rows)))
    grouped = numbered.group_by(keys).aggregate([("_row", "list")])
    names = zip(*(grouped[k].to_pylist() for k in keys))
    return {name: table.take(rows.values) for name, rows in zip(names, grouped["_row_list"])}


def in_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Consecutive batches put together until they have at least ``rows`` rows."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(waiting)
            waiting, size = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


@dataclass(frozen=True)
class Scorer:
    """Scores tables with the columns ``keys``, ``_id`` and ``_vec``."""

    keys: Sequence[str]
    k: int
    exclude_self: bool
    schema: pa.Schema

    def cell(self) -> Callable[[pa.Table, pa.Table], pa.Table]:
        """Function of the query and database rows of one cell."""
        return lambda q, db: self.score(q, db)

    def against(self, held, held_is_db: bool) -> Callable:
        """Function of the batches of one side, with the other side broadcast."""

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            partners = by_group(held.value, self.keys)
            best: dict[tuple, pa.Table] = {}
            for block in in_blocks(batches, SCAN_ROWS):
                for name, rows in by_group(block, self.keys).items():
                    if name not in partners:
                        continue
                    if held_is_db:  # a query meets all its rows at once
                        few = max(1, HITS_PER_TASK // min(self.k, max(partners[name].num_rows, 1)))
                        for at in range(0, rows.num_rows, few):
                            yield from self.score(rows.slice(at, few), partners[name]).to_batches()
                        continue
                    # the task keeps k rows per query, however many blocks it scans
                    hits = self.score(partners[name], rows)
                    best[name] = self.merged(best[name], hits) if name in best else hits
            for hits in best.values():
                yield from hits.to_batches()

        return scan

    def streamed(self) -> Callable:
        """Function of pairs of packed blocks: ``_db`` meets ``_q``, the block of queries with the number ``_qb``.

        The queries of a block keep k rows each, however many blocks they meet.
        """

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            met: dict[int, Running] = {}
            for batch in batches:
                for number, q, db in zip(batch["_qb"].to_pylist(), batch["_q"], batch["_db"]):
                    if number not in met:
                        # a copy, as the batch has all pairs that came along
                        met[number] = Running(self, unpacked(pa.py_buffer(q.as_py())))
                    met[number].meet(unpacked(db.as_buffer()))
            for running in met.values():
                yield from running.finished().to_batches()

        return scan

    def merged(self, *tables: pa.Table) -> pa.Table:
        """The k best hits per query of tables that score different database rows."""
        q_id, db_id, score = self.schema.names[-4:-1]
        hits = pa.concat_tables(tables)
        hits = hits.take(pc.sort_indices(
            hits, sort_keys=[(q_id, "ascending"), (score, "descending"), (db_id, "ascending")]
        ))
        if hits.num_rows == 0:
            return hits
        query = hits[q_id].combine_chunks().dictionary_encode().indices.to_numpy()
        rank = np.arange(len(query)) - np.searchsorted(query, query) + 1
        ranked = hits.set_column(hits.num_columns - 1, "rank", pa.array(rank.astype(np.int32)))
        return ranked.filter(pa.array(rank <= self.k))

    def score(self, q: pa.Table, db: pa.Table, floor: np.ndarray | None = None) -> pa.Table:
        """The k best database rows per query; a score that is no number is no hit.

        ``floor`` has a rounded score for each query, or -inf; rows that score less may be left out.
        """
        q, floor = with_vectors(q, floor)
        db = db.filter(pc.is_valid(db["_vec"]))
        if q.num_rows == 0 or db.num_rows == 0:
            return self.schema.empty_table()
        db = db.take(pc.sort_indices(db["_id"]))
        q_matrix, db_matrix = to_matrix(q["_vec"]), to_matrix(db["_vec"])
        if q_matrix.shape[1] != db_matrix.shape[1]:
            raise ValueError(
                f"vectors of different lengths: {q_matrix.shape[1]} and {db_matrix.shape[1]}"
            )
        finite = np.isfinite(q_matrix).all() and np.isfinite(db_matrix).all()
        own = self.own_columns(q, db) if self.exclude_self else None
        reach = self.reach(q, db)
        lengths = [np.linalg.norm(side, axis=1).max() for side in (q_matrix, db_matrix)]
        single = None
        if finite and max(lengths) < LONGEST and reach is None and own is None:
            single = db_matrix.astype(np.float32)
        step = max(1, SCORE_BUFFER // db.num_rows)
        parts = []

        def in_double(start: int, stop: int) -> None:
            for start in range(start, stop, step):
                end = min(start + step, stop)
                scores = q_matrix[start:end] @ db_matrix.T
                if reach is not None:
                    scores += reach(start, end)
                if not finite:
                    scores[np.isnan(scores)] = -np.inf
                if own is not None:
                    mine = own[start:end]
                    scores[np.flatnonzero(mine >= 0), mine[mine >= 0]] = -np.inf
                parts.append(self.ranked(*best_columns(scores, self.k), start))

        longer = step if single is None else max(1, SINGLE_BUFFER // db.num_rows)
        for start in range(0, q.num_rows, longer):
            stop = min(start + longer, q.num_rows)
            best = None
            if single is not None:
                least = floor[start:stop] if floor is not None else None
                best = best_of_product(q_matrix[start:stop], db_matrix, single, lengths[1], min(self.k, db.num_rows), least)
            if best is None:
                in_double(start, stop)
            else:
                parts.append(self.ranked(*best, start))
        return self.hits(q, db, *(np.concatenate(p) for p in zip(*parts)))

    def hits(self, q: pa.Table, db: pa.Table, row: np.ndarray, col: np.ndarray, value: np.ndarray, rank: np.ndarray) -> pa.Table:
        columns = [q[name].take(pa.array(row)) for name in self.keys]
        columns += [q["_id"].take(pa.array(row)), db["_id"].take(pa.array(col)),
                    pa.array(value, pa.float64()), pa.array(rank.astype(np.int32))]
        return pa.Table.from_arrays(columns, names=self.schema.names).cast(self.schema)

    @staticmethod
    def ranked(row: np.ndarray, col: np.ndarray, value: np.ndarray, start: int) -> tuple[np.ndarray, ...]:
        return row + start, col, value, np.arange(len(row)) - np.searchsorted(row, row) + 1

    def reach(self, q: pa.Table, db: pa.Table) -> Callable[[int, int], np.ndarray] | None:
        """For the queries of a stretch, 0 for database rows that count and -inf for others; None if all count."""
        return None

    @staticmethod
    def own_columns(q: pa.Table, db: pa.Table) -> np.ndarray:
        """Position of each query among the database rows, -1 if it is not there."""
        found = pc.index_in(q["_id"].combine_chunks(), value_set=db["_id"].combine_chunks())
        return found.fill_null(-1).to_numpy(zero_copy_only=False)


def with_vectors(q: pa.Table, floor: np.ndarray | None) -> tuple[pa.Table, np.ndarray | None]:
    """Queries that have a vector, and their floors."""
    valid = pc.is_valid(q["_vec"])
    return q.filter(valid), floor if floor is None else floor[valid.to_numpy()]


def packed(table: pa.Table) -> bytes:
    """A table as one value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(value: pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


class Running:
    """The k best hits so far of a block of queries, which meets blocks of the database one after the other.

    Hits are merged when there are half as many new ones as kept ones. From then on rows below the k-th score
    of a query are left out, so that later blocks give few.
    """

    def __init__(self, scorer: Scorer, q: pa.Table, floor: np.ndarray | None = None) -> None:
        self.scorer, self.q = scorer, q
        self.best, self.new, self.floor, self.given = scorer.schema.empty_table(), [], floor, floor

    def meet(self, db: pa.Table) -> None:
        self.new.append(self.scorer.score(self.q, db, self.floor))
        if 2 * sum(hits.num_rows for hits in self.new) >= self.best.num_rows:
            self.merge()

    def merge(self) -> None:
        self.best, self.new = self.scorer.merged(self.best, *self.new), []
        last = self.best.filter(pc.equal(self.best["rank"], self.scorer.k))
        query, score = last.column_names[-4], last.column_names[-2]
        place = pc.index_in(self.q["_id"].cast(last.schema.field(query).type), value_set=last[query].combine_chunks())
        known = place.is_valid().to_numpy()
        self.floor = np.full(self.q.num_rows, -np.inf)
        self.floor[known] = last[score].to_numpy()[place.drop_null().to_numpy()]
        if self.given is not None:
            self.floor = np.maximum(self.floor, self.given)

    def finished(self) -> pa.Table:
        self.merge()
        return self.best


def least_sums(values: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` least sums of subsets of each row, in order, all of them if there are fewer.

    No value is negative, so the least sums with one value more are among the least
    ones without it, each with and without the new value.
    """
    sums = np.zeros((len(values), 1))
    for column in values.T:
        sums = np.concatenate([sums, sums + column[:, None]], axis=1)
        if sums.shape[1] > n:
            sums = np.partition(sums, n - 1, axis=1)[:, :n]
    return np.sort(sums, axis=1)


def nearest_words(points: np.ndarray, words: Sequence[np.ndarray]) -> np.ndarray:
    """For each stretch of the points' columns the number of its nearest word, less 128."""
    out = np.empty((len(points), len(words)), np.int8)
    step, at = max(1, SCORE_BUFFER // max(map(len, words))), 0
    for part, some in enumerate(words):
        own = points[:, at : at + some.shape[1]]
        half = (some**2).sum(axis=1) / 2
        for lo in range(0, len(points), step):
            out[lo : lo + step, part] = (half - own[lo : lo + step] @ some.T).argmin(axis=1) - 128
        at += some.shape[1]
    return out


def decoded(codes: np.ndarray, words: Sequence[np.ndarray]) -> np.ndarray:
    """Points that the codes stand for."""
    return np.concatenate([some[codes[:, part] + 128] for part, some in enumerate(words)], axis=1)


@dataclass(frozen=True)
class CellScorer(Scorer):
    """Scores rows of the cells that a query probes, where these are a good share of all cells.

    All pairs of a block are one matrix product, and those of other cells are left out. The database side has
    its ``cell``, the query side ``_probed``, one bit for each cell; without that column all cells count.
    """

    def reach(self, q: pa.Table, db: pa.Table) -> Callable[[int, int], np.ndarray] | None:
        bits = self.probed(q)
        if bits is None:
            return None
        cells, own = np.unique(db["cell"].to_numpy(), return_inverse=True)
        return lambda lo, hi: np.take(np.where(bits[lo:hi][:, cells >> 3] >> (cells & 7) & 1, 0.0, -np.inf), own, axis=1)


    @staticmethod
    def probed(q: pa.Table) -> np.ndarray | None:
        """A row of bytes for each query, with one bit for each cell."""
        if "_probed" not in q.column_names:
            return None
        return np.frombuffer(b"".join(q["_probed"].to_pylist()), np.uint8).reshape(q.num_rows, -1)


@dataclass(frozen=True)
class CodeScorer(CellScorer):
    """Scores queries against decoded rows: ``_vec`` of the database side is a code.

    The column ``cell`` tells whose centroid a decoded residual belongs to. Rows are decoded ``SCAN_ROWS`` at a
    time, so a block may have very many; the best so far go along. Of these only the nearest are looked at first, as
    most of them are in cells that the query probes.
    """

    words: Sequence[np.ndarray] = ()
    centroids: np.ndarray = None

    def score(self, q: pa.Table, db: pa.Table, floor: np.ndarray | None = None) -> pa.Table:
        q, floor = with_vectors(q, floor)
        db = db.filter(pc.is_valid(db["_vec"]))
        if q.num_rows == 0 or db.num_rows == 0:
            return self.schema.empty_table()
        db = db.take(pc.sort_indices(db["_id"]))
        if db.num_rows > SCAN_ROWS:
            running = Running(self, q, floor)
            for at in range(0, db.num_rows, SCAN_ROWS):
                running.meet(db.slice(at, SCAN_ROWS))
            return running.finished()
        queries, cells = to_matrix(q["_vec"]), db["cell"].to_numpy()
        points = decoded(to_matrix(db["_vec"]).astype(np.int64), self.words) + self.centroids[cells]
        own = self.own_columns(q, db) if self.exclude_self else np.full(q.num_rows, -1)
        probed = self.probed(q)
        k = min(self.k, len(points))
        finite = np.isfinite(queries).all() and np.isfinite(points).all()
        lengths = [np.linalg.norm(side, axis=1).max() for side in (queries, points)]
        single = points.astype(np.float32) if finite and max(lengths) < LONGEST else None
        parts, left = [], np.arange(len(queries))
        if single is not None:
            open_, step = [], max(1, SINGLE_BUFFER // len(points))
            for at in range(0, len(queries), step):
                some = slice(at, at + step)

                def fits(row: np.ndarray, col: np.ndarray) -> np.ndarray:
                    fit = col != own[some][row]
                    if probed is not None:
                        cell = cells[col]
                        fit &= (probed[some][row, cell >> 3] >> (cell & 7) & 1).astype(bool)
                    return fit

                row, col, value, done = best_that_fit(
                    queries[some], points, single, lengths[1], k, k + k // 2 + 1, None if floor is None else floor[some],
                    fits, CODE_GROUPS_PER_HIT,
                )
                parts.append(self.ranked(row, col, value, at))
                open_.append(np.flatnonzero(~done) + at)
            left = np.concatenate(open_)
        step = max(1, SCORE_BUFFER // len(points))
        for at in range(0, len(left), step):
            some = left[at:at + step]
            scores = queries[some] @ points.T
            if probed is not None:
                scores[(probed[some][:, cells >> 3] >> (cells & 7) & 1) == 0] = -np.inf
            scores[np.isnan(scores)] = -np.inf
            barred = np.flatnonzero(own[some] >= 0)
            scores[barred, own[some][barred]] = -np.inf
            row, col, value = best_columns(scores, k)
            parts.append((some[row], col, value, np.arange(len(row)) - np.searchsorted(row, row) + 1))
        return self.hits(q, db, *(np.concatenate(p) for p in zip(*parts)))


@dataclass(frozen=True)
class ListedScorer(Scorer):
    """Scores rows that the query names in its list ``_listed`` of ids; as often as they are listed."""

    def score(self, q: pa.Table, db: pa.Table, floor: np.ndarray | None = None) -> pa.Table:
        q, _ = with_vectors(q, floor)
        db = db.filter(pc.is_valid(db["_vec"]))
        if q.num_rows == 0 or db.num_rows == 0:
            return self.schema.empty_table()
        db = db.take(pc.sort_indices(db["_id"]))
        queries, rows = to_matrix(q["_vec"]), to_matrix(db["_vec"])
        if queries.shape[1] != rows.shape[1]:
            raise ValueError(f"vectors of different lengths: {queries.shape[1]} and {rows.shape[1]}")
        # rows of one id are a run
        ids = db["_id"].combine_chunks().dictionary_encode()
        number = ids.indices.to_numpy()
        firsts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        sizes = np.diff(np.r_[firsts, len(number)])
        lists = q["_listed"].combine_chunks()
        run = pc.index_in(lists.flatten(), value_set=ids.dictionary)
        here = np.flatnonzero(run.is_valid().to_numpy(zero_copy_only=False))
        run = run.take(pa.array(here)).to_numpy()
        n = sizes[run]
        row = np.repeat(pc.list_parent_indices(lists).to_numpy()[here], n)
        col = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(firsts[run], n)
        order = np.lexsort((col, row))
        row, col = row[order], col[order]
        value = np.empty(len(row))
        for at in range(0, len(row), SCAN_ROWS):
            some = slice(at, at + SCAN_ROWS)
            value[some] = np.einsum("ij,ij->i", queries[row[some]], rows[col[some]])
        fit = ~np.isnan(value)
        best = best_of_entries(row[fit], col[fit], value[fit], q.num_rows, self.k)[:3]
        return self.hits(q, db, *self.ranked(*best, 0))


@dataclass(frozen=True)
class ProbeScorer(Scorer):
    """Scores only rows in buckets that the query probes.

    The database side has a bucket's ``_code``, the query side ``_limit``, the largest cost of a
    bucket that it probes; the key column ``table`` tells which of the ``planes`` apply.
    """

    planes: np.ndarray = None
    table: str = ""

    def score(self, q: pa.Table, db: pa.Table, floor: np.ndarray | None = None) -> pa.Table:
        q, db = (side.filter(pc.is_valid(side["_vec"])) for side in (q, db))
        if q.num_rows == 0 or db.num_rows == 0:
            return self.schema.empty_table()
        db = db.take(pc.sort_indices(db, sort_keys=[("_code", "ascending"), ("_id", "ascending")]))
        queries, rows = to_matrix(q["_vec"]), to_matrix(db["_vec"])
        planes = self.planes[q[self.table][0].as_py()]
        code = db["_code"].to_numpy()
        firsts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        sizes = np.diff(np.r_[firsts, len(code)])
        buckets = ((code[firsts][:, None] >> np.arange(len(planes))) & 1).astype(np.float64)
        limits = q["_limit"].to_numpy()
        own = self.own_columns(q, db) if self.exclude_self else np.full(q.num_rows, -1)
        place = pc.rank(db["_id"], sort_keys="ascending", tiebreaker="first").to_numpy().astype(np.int64)
        parts, step = [], max(1, SCORE_BUFFER // max(len(firsts), 1))
        for at in range(0, len(queries), step):
            some = queries[at:at + step]
            sides = some @ planes.T
            positive, margins = sides > 0, sides**2
            cost = (margins * positive).sum(axis=1)[:, None] + (margins * (1 - 2 * positive)) @ buckets.T
            row, bucket = np.nonzero(cost <= limits[at:at + step, None])
            for lo, hi in self.in_parts(sizes[bucket], row):
                parts.append(self.best_pairs(some, rows, row[lo:hi], firsts[bucket[lo:hi]], sizes[bucket[lo:hi]],
                                             own[at:at + step], place, at))
        row, col, value, rank = (np.concatenate(p) for p in zip(*parts)) if parts else [np.empty(0, np.int64)] * 4
        columns = [q[name].take(pa.array(row)) for name in self.keys]
        columns += [q["_id"].take(pa.array(row)), db["_id"].take(pa.array(col)),
                    pa.array(value, pa.float64()), pa.array(rank.astype(np.int32))]
        return pa.Table.from_arrays(columns, names=self.schema.names).cast(self.schema)

    @staticmethod
    def in_parts(sizes: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of whole rows with about ``SCORE_BUFFER`` / 8 pairs."""
        ends = np.cumsum(sizes)
        lo = 0
        while lo < len(row):
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + SCORE_BUFFER // 8, side="right")))
            hi = int(np.searchsorted(row, row[hi - 1], side="right"))
            yield lo, hi
            lo = hi

    def best_pairs(self, queries, rows, row, first, size, own, place, at) -> tuple[np.ndarray, ...]:
        """The k best of the pairs given as runs of database rows."""
        ends = np.cumsum(size)
        pair = np.repeat(row, size)
        col = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(first, size)
        scores = np.concatenate([
            np.einsum("ij,ij->i", queries[pair[i:i + SCAN_ROWS]], rows[col[i:i + SCAN_ROWS]])
            for i in range(0, len(pair), SCAN_ROWS)
        ])
        # a score that is no number is no hit, nor is the row itself where that is barred
        fit = (scores > -np.inf) & (col != own[pair])
        pair, col, value = pair[fit], col[fit], rounded(scores[fit])
        order = np.lexsort((place[col], -value, pair))
        pair, col, value = pair[order], col[order], value[order]
        rank = np.arange(len(pair)) - np.searchsorted(pair, pair) + 1
        best = rank <= self.k
        return pair[best] + at, col[best], value[best], rank[best]


@dataclass(frozen=True)
class ReachScorer(Scorer):
    """Scores rows that lie, in some table, in a bucket that the query probes.

    For queries that probe a good share of the buckets: all pairs of a block are one matrix product. Most of the best
    rows are in reach then, so that only these are looked at, in the order of their bounds; a query of which fewer
    than k of them are in reach looks at all rows. The database side has ``_codes``, its bucket in each table, the query side
    ``_limits``, the largest cost of a bucket that it probes. Rows of one id and vector count once.
    """

    planes: np.ndarray = None

    def score(self, q: pa.Table, db: pa.Table, floor: np.ndarray | None = None) -> pa.Table:
        q, floor = with_vectors(q, floor)
        db = db.filter(pc.is_valid(db["_vec"]))
        if q.num_rows == 0 or db.num_rows == 0:
            return self.schema.empty_table()
        db = db.take(pc.sort_indices(db["_id"]))
        rows = to_matrix(db["_vec"])
        ids = pc.rank(db["_id"], sort_keys="ascending", tiebreaker="min").to_numpy()
        if (ids[1:] == ids[:-1]).any():
            _, first = np.unique(np.column_stack([ids.astype(np.float64), rows]), axis=0, return_index=True)
            first.sort()
            db, rows = db.take(pa.array(first)), rows[first]
        queries, limits = to_matrix(q["_vec"]), to_matrix(q["_limits"])
        if queries.shape[1] != rows.shape[1]:
            raise ValueError(f"vectors of different lengths: {queries.shape[1]} and {rows.shape[1]}")
        codes = to_matrix(db["_codes"]).astype(np.int64)
        barred = self.own_columns(q, db) if self.exclude_self else np.full(q.num_rows, -1)
        finite = np.isfinite(queries).all() and np.isfinite(rows).all()
        lengths = [np.linalg.norm(side, axis=1).max() for side in (queries, rows)]
        single = rows.astype(np.float32) if finite and max(lengths) < LONGEST else None
        parts, left = [], np.arange(len(queries))
        if single is not None:
            step = max(1, SINGLE_BUFFER // len(rows))
            open_ = []
            for at in range(0, len(queries), step):
                some = slice(at, at + step)
                k = min(self.k, len(rows))
                row, col, value, done = best_that_fit(
                    queries[some], rows, single, lengths[1], k, NEAR_PER_HIT * k, None if floor is None else floor[some],
                    lambda i, j: (j != barred[some][i]) & self.in_reach(queries[some], limits[some], codes, i, j),
                )
                parts.append(self.ranked(row, col, value, at))
                open_.append(np.flatnonzero(~done) + at)
            left = np.concatenate(open_)
        if len(left):
            # per table: bits of the buckets that have rows, and which of them each row is in
            bits = np.arange(self.planes.shape[1])
            found = [np.unique(own, return_inverse=True) for own in codes.T]
            buckets = [(((own[:, None] >> bits) & 1).astype(np.float64), place) for own, place in found]
            step = max(1, SCORE_BUFFER // len(rows))
            for at in range(0, len(left), step):
                some = left[at:at + step]
                row, col, value = self.best_of_all(queries[some], limits[some], barred[some], rows, buckets)
                parts.append((some[row], col, value, np.arange(len(row)) - np.searchsorted(row, row) + 1))
        return self.hits(q, db, *(np.concatenate(p) for p in zip(*parts)))

    def in_reach(self, queries: np.ndarray, limits: np.ndarray, codes: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        """Which pairs of a query and a row are in reach in some table."""
        reached = np.zeros(len(row), bool)
        bits = np.arange(self.planes.shape[1])
        for table, planes in enumerate(self.planes):
            sides = queries @ planes.T
            positive, margins = sides > 0, sides**2
            other = (codes[col, table][:, None] >> bits & 1) != positive[row]
            reached |= np.einsum("ij,ij->i", other, margins[row]) <= limits[row, table]
        return reached

    def best_of_all(
        self, queries: np.ndarray, limits: np.ndarray, barred: np.ndarray, rows: np.ndarray,
        buckets: list[tuple[np.ndarray, np.ndarray]],
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        reached = np.zeros((len(queries), len(rows)), bool)
        for table, planes in enumerate(self.planes):
            sides = queries @ planes.T
            positive, margins = sides > 0, sides**2
            set_bits, own = buckets[table]
            cost = (margins * positive).sum(axis=1)[:, None] + (margins * (1 - 2 * positive)) @ set_bits.T
            reached |= np.take(cost <= limits[:, table, None], own, axis=1)
        scores = queries @ rows.T
        scores[~reached | np.isnan(scores)] = -np.inf
        scores[np.flatnonzero(barred >= 0), barred[barred >= 0]] = -np.inf
        return best_columns(scores, self.k)


def vectors_to_arrow(matrix: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Unit float32 rows; zero and invalid rows become null."""
    norms = np.linalg.norm(matrix.astype(np.float64), axis=1)
    usable = norms > 0 if valid is None else (norms > 0) & valid
    unit = np.divide(matrix, norms[:, None], where=usable[:, None], out=np.zeros(matrix.shape))
    offsets = np.arange(0, unit.size + 1, max(1, unit.shape[1]), dtype=np.int32)[: len(unit) + 1]
    return pa.ListArray.from_arrays(
        offsets, pa.array(unit.ravel().astype(np.float32)), mask=pa.array(~usable)
    )


def unit_bucket(unit: str, dim: int) -> int:
    """Bucket of a word or gram: the first 28 bits of its md5, modulo ``dim``."""
    return int(hashlib.md5(unit.encode()).hexdigest()[:7], 16) % dim


def word_units(word: str, ngram: int) -> list[str]:
    """The word itself, or every ``ngram`` of ``<word>``."""
    if not ngram:
        return [word]
    marked = f"<{word}>"
    return [marked[i:i + ngram] for i in range(len(marked) - ngram + 1)]


def hashed_counts(texts: pa.Array, dim: int, ngram: int, max_words: int | None) -> np.ndarray:
    """Units per text and bucket.

    Arrow splits the texts; only distinct words are hashed, and all occurrences
    are counted by one ``bincount``.  Long batches are done in parts.
    """
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    parts, start = [np.zeros((0, dim))], 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + TEXT_BUFFER, side="right")))
        parts.append(_counts(texts.slice(start, stop - start), dim, ngram, max_words))
        start = stop
    return np.concatenate(parts)


def _counts(texts: pa.Array, dim: int, ngram: int, max_words: int | None) -> np.ndarray:
    split = pc.split_pattern_regex(texts, r"\s+")
    if max_words is not None:
        split = pc.list_slice(split, 0, max_words)
    row = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    words = split.flatten().dictionary_encode()
    buckets = [
        [unit_bucket(u, dim) for u in word_units(w, ngram)] if w else []
        for w in words.dictionary.to_pylist()
    ]
    sizes = np.array([len(b) for b in buckets], dtype=np.int64)
    flat = np.array([b for bs in buckets for b in bs], dtype=np.int64)
    word = words.indices.to_numpy(zero_copy_only=False)
    # every occurrence of a word stands for the run of its buckets in ``flat``
    runs = sizes[word]
    first = (np.cumsum(sizes) - sizes)[word]
    place = np.repeat(first - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
    cell = np.repeat(row, runs) * dim + flat[place]
    return np.bincount(cell, minlength=len(texts) * dim).reshape(len(texts), dim)


def prepared_pixels(images: pa.StructArray, size: int) -> np.ndarray:
    """(n, 3, size, size): RGB, centre crop, scaled to [0, 1], standardised.

    Takes the ``image`` source's structs, whose bytes are rows of B, G, R (, A).
    A smaller image is centred on black.
    """
    out = np.zeros((len(images), 3, size, size), dtype=np.float32)
    for i, image in enumerate(images.to_pylist()):
        h, w, c = image["height"], image["width"], image["nChannels"]
        pixels = np.frombuffer(image["data"], np.uint8).reshape(h, w, c)
        rgb = np.repeat(pixels, 3, axis=2) if c == 1 else pixels[:, :, 2::-1]
        top, left = (max(0, int(round((n - size) / 2))) for n in (h, w))
        crop = rgb[top:top + size, left:left + size]
        y, x = (size - crop.shape[0]) // 2, (size - crop.shape[1]) // 2
        out[i, :, y:y + crop.shape[0], x:x + crop.shape[1]] = crop.transpose(2, 0, 1) / 255.0
    mean, std = (np.array(v, np.float32)[:, None, None] for v in (CHANNEL_MEAN, CHANNEL_STD))
    return (out - mean) / std
