import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from test_knn import BY, brute_force, random_rows, table
from twinshelf.operators import ann, evaluate
from twinshelf.operators.knn import knn_join

VECS = dict(q_vec="q_vec", db_vec="db_vec")


@pytest.fixture(scope="module")
def sides():
    """Four fifths of both sides are copies of one vector, so one bucket holds them."""
    hot = [1.0] + [0.0] * 7
    q, db = random_rows(1, {"a": 12, "b": 6}), random_rows(2, {"a": 15, "b": 8})
    q += [(100 + i, "a", hot) for i in range(60)]
    db += [(100 + i, "a", hot) for i in range(80)]
    return q, db


@pytest.fixture(scope="module")
def index(spark, sides):
    from twinshelf.session import scratch_path

    db = table(spark, "db", sides[1])
    return ann.build_cells(db, scratch_path(spark, "cells"), vec="db_vec", n_cells=5)


def test_every_row_is_in_one_cell(spark, sides, index):
    info = ann.index_info(index, "db_vec").collect()
    assert sum(r["n_rows"] for r in info) == len(sides[1])
    assert {r["dim"] for r in info} == {8}
    assert all(r["n_bytes"] == r["n_rows"] * 32 for r in info)


def test_rows_are_in_their_nearest_cell(index):
    centroids = index.centroids()
    for r in index.rows().collect():
        distances = ((np.array(r["db_vec"]) - centroids) ** 2).sum(axis=1)
        assert distances[r["cell"]] == pytest.approx(distances.min())


@pytest.mark.parametrize("block_rows", [1000, 9])
def test_all_cells_are_exact(spark, sides, index, block_rows):
    q, db = sides
    got = ann.knn_cells(table(spark, "q", q), index, k=4, nprobe=5, by=BY,
                        block_rows=block_rows, **VECS)
    assert rows(got) == brute_force(q, db, 4)


def test_without_categories_and_short_queries_complete(spark, sides, index):
    """One cell rarely holds 30 rows; the missing hits come from an exact pass."""
    q, db = sides
    got = ann.knn_cells(table(spark, "q", q), index, k=30, nprobe=1, **VECS)
    counts = got.groupBy("q_id").count().collect()
    assert len(counts) == len(q)
    assert {r["count"] for r in counts} == {30}
    assert got.select("q_id", "db_id").distinct().count() == got.count()


def test_short_queries_get_their_exact_result(spark, sides, index):
    q, db = sides
    got = ann.knn_cells(table(spark, "q", q), index, k=200, nprobe=1, by=BY, **VECS)
    assert rows(got) == brute_force(q, db, 200)


def test_guard(spark, index):
    one = table(spark, "q", [(1, "a", [1.0] + [0.0] * 7), (2, "x", [1.0] + [0.0] * 7)])
    got = ann.knn_cells(one, index, k=2, nprobe=5, by=BY, min_group_size=2, **VECS)
    assert got.count() == 0


def test_null_vectors_are_left_out(spark, sides, index, fresh):
    q = table(spark, "q", [*sides[0][:3], (999, "a", None)])
    got = ann.knn_cells(q, index, k=2, nprobe=2, by=BY, **VECS)
    assert {r["q_id"] for r in got.collect()} == {0, 1, 2}
    db = table(spark, "db", [*sides[1], (999, "a", None)])
    stored = ann.build_cells(db, fresh(), vec="db_vec", n_cells=3)
    assert stored.rows().count() == len(sides[1])


def test_index_follows_its_database(spark, sides, fresh):
    db, path = table(spark, "db", sides[1]), fresh()
    fewer = table(spark, "db", sides[1][5:])
    first = ann.build_cells(fewer, path, vec="db_vec", n_cells=4)
    before = first.centroids()
    assert first.rows().count() == len(sides[1]) - 5
    ann.build_cells(db, path, vec="db_vec", n_cells=4)
    again = ann.build_cells(db, path, vec="db_vec", n_cells=4)
    assert np.array_equal(before, again.centroids())
    assert rows(again.rows().select("db_id")) == sorted([(i,) for i, _, _ in sides[1]], key=repr)
    # rows that have gone, and a changed one
    changed = [*sides[1][:3], (*sides[1][3][:2], [0.5] * 8)]
    left = ann.build_cells(table(spark, "db", changed), path, vec="db_vec", n_cells=4)
    assert rows(left.rows().select("db_id")) == [(0,), (1,), (2,), (3,)] or left.rows().count() == 4
    with pytest.raises(ValueError, match="4 cells"):
        ann.build_cells(db, path, vec="db_vec", n_cells=2)


def test_unfinished_index_is_completed(spark, sides, fresh):
    db, path, half = table(spark, "db", sides[1]), fresh(), fresh()
    first = ann.build_cells(db, path, vec="db_vec", n_cells=4)
    spark.read.parquet(f"{path}/centroids").write.parquet(f"{half}/centroids")
    finished = ann.build_cells(db, half, vec="db_vec", n_cells=4)
    assert rows(finished.rows().select("db_id", "cell")) == rows(first.rows().select("db_id", "cell"))


def test_cells_beyond_every_task_are_refused_before_any_work(spark, sides, monkeypatch, fresh):
    monkeypatch.setattr(ann, "CENTROID_BYTES", 100)
    with pytest.raises(ValueError, match="at most 1"):
        ann.build_cells(table(spark, "db", sides[1]), fresh(), vec="db_vec", n_cells=10)


def test_nearest_cells_in_small_parts(spark, monkeypatch):
    points = np.random.default_rng(1).normal(size=(50, 4)).astype(np.float32)
    centroids = np.random.default_rng(2).normal(size=(9, 4))
    monkeypatch.setattr(ann, "DISTANCE_BYTES", 200)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "i int, v array<float>")
    got = {r.i: list(r.c) for r in df.select("i", ann.nearest_cells(centroids, 3)(F.col("v")).alias("c")).collect()}
    distance = ((points[:, None].astype(float) - centroids[None]) ** 2).sum(-1)
    assert got == {i: np.argsort(d, kind="stable")[:3].tolist() for i, d in enumerate(distance)}


def clustered(seed, groups, rows_each, width=16):
    """Unit vectors close to a few centres, as (id, category, vector)."""
    pick = np.random.default_rng(seed)
    centres = np.random.default_rng(99).normal(size=(groups, width))
    points = np.repeat(centres, rows_each, axis=0) + 0.05 * pick.normal(size=(groups * rows_each, width))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    return [(i, "a", p.tolist()) for i, p in enumerate(points)]


@pytest.mark.parametrize("by", [BY, []])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_bounds_lose_nothing(spark, sides, index, by, exclude_self):
    """Vectors of any length, ties, a hot cell, one cell to begin with."""
    q = [(i, c, [3.7 * x for x in v]) if i % 3 else (i, c, v) for i, c, v in sides[0]]
    rows_of = table(spark, "q", q)
    for k in (1, 20):
        got = ann.knn_cells(rows_of, index, k=k, nprobe=1, by=by, exact=True, exclude_self=exclude_self, **VECS)
        exact = knn_join(rows_of, table(spark, "db", sides[1]), k=k, by=by, exclude_self=exclude_self, **VECS)
        assert rows(got.select(*exact.columns)) == rows(exact)


def test_cells_beyond_the_bound_are_not_read(spark, fresh, monkeypatch):
    """Far clusters are never joined: a query meets the rows of its own cluster."""
    db, q = clustered(1, 12, 40), clustered(2, 12, 5)
    index = ann.build_cells(table(spark, "db", db), fresh(), vec="db_vec", n_cells=12)
    met = []
    join = ann.knn_join

    def counted(left, right, **args):
        if "cell" in right.columns:
            pairs = left.join(right, left["_cell"] == right["cell"])
            met.append(pairs.count())
        return join(left, right, **args)

    monkeypatch.setattr(ann, "knn_join", counted)
    got = ann.knn_cells(table(spark, "q", q), index, k=5, nprobe=1, exact=True, **VECS)
    assert rows(got) == rows(join(table(spark, "q", q), table(spark, "db", db), k=5, **VECS))
    assert sum(met) < 0.3 * len(db) * len(q)


def test_number_of_probes_is_chosen(spark, fresh):
    db, q = clustered(1, 12, 40), clustered(2, 12, 5)
    index = ann.build_cells(table(spark, "db", db), fresh(), vec="db_vec")
    assert index.centroids().shape == (22, 16)      # the root of 480
    left, right = table(spark, "q", q), table(spark, "db", db)
    got = ann.knn_cells(left, index, k=5, target_recall=0.95, **VECS)
    found = evaluate.recall(got, knn_join(left, right, k=5, **VECS), ["q_id", "db_id"]).first()
    assert found["recall"] >= 0.95


@pytest.mark.parametrize("by", [BY, []])
def test_planes_chosen_from_the_data(spark, monkeypatch, by):
    """On clustered vectors a small share of the pairs is scored."""
    db, q = clustered(1, 12, 60), clustered(2, 12, 8)
    left, right = table(spark, "q", q), table(spark, "db", db)
    chosen, scored = [], []
    choose = ann.choose_planes
    monkeypatch.setattr(ann, "choose_planes", lambda *a: chosen.append(choose(*a)) or chosen[-1])
    got = ann.knn_planes(left, right, k=5, width=16, by=by, **VECS)
    exact = knn_join(left, right, k=5, by=by, **VECS)
    on = ["q_id", "db_id"]
    assert evaluate.recall(got, exact, on).first()["recall"] >= 0.9
    tables, bits, probes = chosen[0]
    points, codes = np.float32([v for _, _, v in db]).astype(float), np.float32([v for _, _, v in q]).astype(float)
    for plane in ann.sign_planes(tables, bits, 16):
        own, margins = ann.squared_margins(codes, plane)
        cost = (margins[:, None] * (own[:, None] != (points @ plane.T > 0)[None])).sum(-1)
        scored.append((cost <= ann.least_sums(margins, probes)[:, -1:]).sum())
    assert sum(scored) < 0.4 * len(db) * len(q)


def test_least_sums():
    values = np.random.default_rng(1).random((7, 6))
    every = np.sort([[sum(v for j, v in enumerate(row) if m >> j & 1) for m in range(64)] for row in values], axis=1)
    for n in (1, 2, 5, 17, 64, 100):
        assert np.allclose(ann.least_sums(values, n), every[:, :n])


@pytest.mark.parametrize("block_rows,probes", [(1000, 3), (4, 3), (7, 8)])
def test_probes_in_order_of_margins(spark, sides, block_rows, probes):
    """Groups of a prefix, and grids of a large one, find what the buckets of least cost hold."""
    q, db = sides
    planes = ann.sign_planes(2, 3, 8)
    vectors = {c: np.float32([v for _, d, v in db if d == c]).astype(float) for c in "ab"}
    want = []
    for i, c, v in q:
        mates = [r for r in db if r[1] == c]
        near = np.zeros(len(mates), bool)
        for plane in planes:
            own, margins = ann.squared_margins(np.float32([v]).astype(float), plane)
            cost = (margins * (own != (vectors[c] @ plane.T > 0))).sum(axis=1)
            near |= cost <= ann.least_sums(margins, probes)[0, -1] * (1 + 1e-9) + 1e-12
        pool = [m for m, n in zip(mates, near) if n]
        want += brute_force([(i, c, v)], pool if len(pool) >= min(5, len(mates)) else mates, 5)
    got = ann.knn_planes(table(spark, "q", q), table(spark, "db", db), k=5, width=8, tables=2, bits=3,
                         probes=probes, by=BY, block_rows=block_rows, **VECS)
    assert rows(got) == sorted(want, key=repr)


def test_coreset_keeps_rare_far_vectors_and_total_weight(spark):
    from twinshelf.operators import centroids

    points = [[float(np.sin(i)), float(np.cos(i)), 0.0] for i in range(4_000)] + [[0.0, 0.0, 300.0 + i] for i in range(3)]
    df = spark.createDataFrame([(p,) for p in points] + [(None,)], "v array<double>").repartition(5)
    n, mean, spread = centroids.moments(df, "v")
    data = np.array(points)
    assert n == len(points) and np.allclose(mean, data.mean(0))
    assert spread == pytest.approx(((data - data.mean(0)) ** 2).sum())
    kept, weights = centroids.coreset(df, "v", 400)
    # the far vectors have nearly all of the spread, so the other half of the chance is theirs
    assert 150 < len(kept) < 550 and weights.sum() == pytest.approx(len(points), rel=0.3)
    assert (kept[:, 2] > 100).sum() == 3
    every, ones = centroids.coreset(df, "v", 10_000)
    assert len(every) == len(points) and set(ones) == {1.0}
    fitted = centroids.fit(df, "v", 3, rows_per_cell=10)
    assert fitted.shape == (3, 3) and (fitted[:, 2] > 100).any()


def test_fit_on_a_sample_is_as_good_as_on_all_rows(spark):
    from twinshelf.operators import centroids

    data = clustered(3, 20, 300)
    df = table(spark, "db", data)
    points = np.float32([v for _, _, v in data]).astype(float)
    costs = [centroids.nearest(points, centroids.fit(df, "db_vec", 20, rows_per_cell=n))[1].sum() for n in (16, 10_000)]
    assert costs[0] < 1.3 * costs[1]


def test_wide_vectors_are_not_sent_whole(spark, monkeypatch):
    from twinshelf.operators import knn

    monkeypatch.setattr(knn, "ROWS_SURELY_HELD", 3)
    monkeypatch.setattr(knn, "HELD_BYTES", 100)
    q, db = random_rows(1, {"a": 9}), random_rows(2, {"a": 8})
    monkeypatch.setattr(knn, "scan_against", None)
    assert rows(knn_join(table(spark, "q", q), table(spark, "db", db), k=3, by=BY, **VECS)) == brute_force(q, db, 3)


@pytest.mark.parametrize("exclude_self", [False, True])
def test_planes_against_brute_force(spark, sides, exclude_self):
    """With one probe, candidates share a bucket in some table; queries short of k are exact."""
    q = sides[0]
    db = [(i, c, v) for i, c, v in q]
    planes = ann.sign_planes(2, 3, 8)

    def buckets(v):
        return [sum(int(np.dot(np.float32(v).astype(float), p) > 0) << b
                    for b, p in enumerate(t)) for t in planes]

    want = []
    for i, c, v in q:
        mates = [(j, d, w) for j, d, w in db if d == c and not (exclude_self and i == j)]
        near = [r for r in mates if any(a == b for a, b in zip(buckets(v), buckets(r[2])))]
        pool = near if len(near) >= min(5, len(mates)) else mates
        want += brute_force([(i, c, v)], pool, 5)
    got = ann.knn_planes(table(spark, "q", q), table(spark, "db", db), k=5, width=8, tables=2,
                         bits=3, probes=1, by=BY, exclude_self=exclude_self, block_rows=11, **VECS)
    assert rows(got) == sorted(want, key=repr)


def test_recall(spark):
    exact = spark.createDataFrame([(1, 2), (1, 3), (2, 4)], "q long, d long")
    found = spark.createDataFrame([(1, 3), (1, 3), (2, 9)], "q long, d long")
    assert rows(evaluate.recall(found, exact, ["q", "d"])) == [(3, 1, pytest.approx(1 / 3))]
    none = exact.where("false")
    assert rows(evaluate.recall(found, none, ["q", "d"])) == [(0, 0, None)]


def test_recall_floor(spark, sf_dir):
    from twinshelf.checks import queries

    assert queries.knn_ivf_recall(spark, sf_dir).first()["recall"] == 1
    assert queries.knn_ivf_tuned(spark, sf_dir).first()["reached"]
    assert queries.knn_lsh_recall(spark, sf_dir).first()["recall"] >= 0.9
    found, exact = queries.knn_lsh_global(spark, sf_dir), queries.knn_global(spark, sf_dir)
    assert evaluate.recall(found, exact, ["q_id", "db_id"]).first()["recall"] >= 0.9


def test_pca_scores_match_a_projection(spark):
    from twinshelf.operators.encode import reduce_dimensions

    data = random_rows(4, {"a": 40})
    q = table(spark, "q", data)
    reduced = reduce_dimensions(q, "q_vec", 3)
    db = reduced.select(F.col("q_id").alias("db_id"), F.col("qc").alias("dc"),
                        F.col("q_vec").alias("db_vec"))
    got = {(r["q_id"], r["db_id"]): r["score"]
           for r in knn_join(reduced, db, k=40, by=BY, **VECS).collect()}
    m = np.float32([v for _, _, v in data]).astype(float)
    _, vectors = np.linalg.eigh(np.cov(m.T))
    projected = m @ vectors[:, -3:]
    projected /= np.linalg.norm(projected, axis=1, keepdims=True)
    want = projected @ projected.T
    assert all(s == pytest.approx(want[i, j], abs=2e-5) for (i, j), s in got.items())
    assert len(got) == 1600


@pytest.mark.parametrize("by", [BY, []])
def test_planes_meet_each_pair_once_where_many_buckets_are_probed(spark, monkeypatch, by):
    """Database rows were sent once for each table; results of both layouts are the same."""
    q, db = (random_rows(seed, {"a": 70, "b": 40}) for seed in (41, 42))
    sides = table(spark, "q", [*q, (900, "a", None)]), table(spark, "db", [*db, (901, "a", None)])
    args = dict(k=3, width=8, tables=4, bits=5, probes=6, by=by, block_rows=16, **VECS)
    seen = []
    monkeypatch.setattr(ann, "knn_join", lambda *a, **kw: seen.append(kw["by"]) or knn_join(*a, **kw))
    once = rows(ann.knn_planes(*sides, **args))
    assert once and all(list(groups) == list(by) for groups in seen)
    monkeypatch.setattr(ann, "DENSE_SHARE", 2.0)
    assert rows(ann.knn_planes(*sides, **args)) == once
    assert any(len(groups) == len(by) + 2 for groups in seen)


@pytest.mark.parametrize("block_rows", [1000, 9])
@pytest.mark.parametrize("by", [BY, []])
def test_pairs_meet_once_where_many_cells_are_probed(spark, fresh, monkeypatch, by, block_rows):
    """A query was sent once to each of its cells; results of both layouts are the same."""
    q, db = (random_rows(seed, {"a": 70, "b": 40}) for seed in (51, 52))
    left = table(spark, "q", [*q, q[0], (900, "a", None), (901, None, q[1][2])])
    right = table(spark, "db", [*db, db[0], (901, "a", None)])
    index = ann.build_cells(right, fresh("cells"), vec="db_vec", n_cells=30)
    monkeypatch.setattr(ann, "FIRST_STEP", 9)       # more than ``MOST_COPIES``
    seen = []
    monkeypatch.setattr(ann, "knn_join", lambda *a, **kw: seen.append((len(kw["by"]), a[0].columns)) or knn_join(*a, **kw))

    def results():
        seen.clear()
        return [rows(ann.knn_cells(left, index, k=3, by=by, block_rows=block_rows, **args, **VECS))
                for args in (dict(nprobe=12), dict(nprobe=1, exact=True), dict(nprobe=12, exclude_self=True))]

    once = results()
    assert all(once) and [n for n, columns in seen if "_probed" in columns] == [len(by)] * 3
    monkeypatch.setattr(ann, "DENSE_SHARE", 2.0)
    assert results() == once
    assert not any("_probed" in columns for _, columns in seen)
