import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from test_ann import VECS, clustered
from test_knn import BY, brute_force, random_rows, table
from twinshelf.operators import ann, cell_tree, evaluate
from twinshelf.operators.knn import knn_join


@pytest.fixture(scope="module")
def sides():
    """Most rows are copies of one vector: one leaf, and one top cell, holds them."""
    hot = [1.0] + [0.0] * 7
    q, db = random_rows(1, {"a": 12, "b": 6}), random_rows(2, {"a": 25, "b": 18})
    q += [(100 + i, "a", hot) for i in range(40)]
    db += [(100 + i, "a", hot) for i in range(60)]
    return q, db


@pytest.mark.parametrize("block_rows", [16_384, 7])
@pytest.mark.parametrize("by", [BY, []])
def test_all_cells_are_exact(spark, sides, fresh, by, block_rows, monkeypatch):
    monkeypatch.setattr(cell_tree, "BLOCK_ROWS", block_rows)
    q, db = sides
    tree = cell_tree.build_tree(table(spark, "db", db), fresh("tree"), vec="db_vec", n_cells=9)
    left, right = table(spark, "q", q), table(spark, "db", db)
    got = cell_tree.knn_tree(left, tree, k=4, beam=3, nprobe=9, by=by, **VECS)
    assert rows(got) == (brute_force(q, db, 4) if by else rows(knn_join(left, right, k=4, **VECS)))


def test_rows_are_in_the_nearest_leaf_of_their_top(spark, sides, fresh):
    tree = cell_tree.build_tree(table(spark, "db", sides[1]), fresh("tree"), vec="db_vec", n_cells=12)
    tops, leaves = tree.tops(), tree.leaves().collect()
    found = tree.rows().collect()
    assert sorted(r["db_id"] for r in found) == sorted(i for i, _, _ in sides[1])
    assert len(tops) == 3 and len({r["_cell"] for r in leaves}) == len(leaves)
    for r in found:
        x = np.array(r["db_vec"])
        top = ((x - tops) ** 2).sum(axis=1).argmin()
        far = {y["_cell"]: ((x - np.array(y["_centroid"])) ** 2).sum() for y in leaves if y["_top"] == top}
        assert far[r["cell"]] == pytest.approx(min(far.values()), abs=1e-9)


def test_beam_and_probes_are_chosen_and_few_pairs_are_scored(spark, fresh):
    db, q = clustered(1, 30, 40), clustered(2, 30, 5)
    left, right = table(spark, "q", q), table(spark, "db", db)
    tree = cell_tree.build_tree(right, fresh("tree"), vec="db_vec", n_cells=36)
    tops = tree.tops()
    common = dict(k=5, q_id="q_id", db_id="db_id", block_rows=1000, exclude_self=False, score="score", **VECS)
    beam, nprobe = cell_tree.choose_probes(left, tree.rows(), tree, tops, [], 0.95, common, None, None)
    assert 1 <= beam < len(tops) and nprobe < 18
    got = cell_tree.knn_tree(left, tree, k=5, beam=beam, nprobe=nprobe, **VECS)
    assert evaluate.recall(got, knn_join(left, right, k=5, **VECS), ["q_id", "db_id"]).first()["recall"] >= 0.94
    sizes = {r["cell"]: r["count"] for r in tree.rows().groupBy("cell").count().collect()}
    near = cell_tree.cells_in_beam(left, tree, tops, ["q_id"], "q_vec", beam, nprobe).collect()
    assert sum(sizes.get(c, 0) for r in near for c in r["_cells"]) < 0.5 * len(q) * len(db)


def test_short_queries_get_their_exact_result(spark, sides, fresh):
    q, db = sides
    tree = cell_tree.build_tree(table(spark, "db", db), fresh("tree"), vec="db_vec", n_cells=25)
    left, right = table(spark, "q", q), table(spark, "db", db)
    got = cell_tree.knn_tree(left, tree, k=90, beam=1, nprobe=1, **VECS)
    assert rows(got) == rows(knn_join(left, right, k=90, **VECS))


def test_empty_and_null(spark, sides, fresh):
    q, db = table(spark, "q", sides[0]), table(spark, "db", sides[1])
    none = cell_tree.build_tree(db.limit(0), fresh("tree"), vec="db_vec", n_cells=4)
    assert cell_tree.knn_tree(q, none, k=3, beam=2, nprobe=2, **VECS).count() == 0
    null = db.withColumn("db_vec", F.when(F.col("db_id") % 2 == 0, F.col("db_vec")))
    tree = cell_tree.build_tree(null, fresh("tree"), vec="db_vec", n_cells=4)
    assert tree.rows().where("db_id % 2 = 1").isEmpty()
    empty_q = q.withColumn("q_vec", F.when(F.col("q_id") < 0, F.col("q_vec")))
    assert cell_tree.knn_tree(empty_q, tree, k=3, beam=2, nprobe=2, **VECS).count() == 0


def test_a_million_wide_cells_are_planned_in_small_levels():
    tops, leaves = cell_tree.tree_shape(1_000_000, 1_024)
    assert tops * leaves >= 1_000_000 and 8 * 1_024 * max(tops, leaves) <= 64 << 20
    with pytest.raises(ValueError, match="use at most"):
        cell_tree.tree_shape(10**9, 1_024)


def test_a_finished_tree_is_used_as_it_is(spark, sides, fresh):
    db, path = table(spark, "db", sides[1]), fresh("tree")
    first = cell_tree.build_tree(db, path, vec="db_vec", n_cells=9).rows().collect()
    again = cell_tree.build_tree(db, path, vec="db_vec", n_cells=9).rows().collect()
    assert sorted(map(repr, first)) == sorted(map(repr, again))


def test_pairs_meet_once_where_many_leaves_are_probed(spark, fresh, monkeypatch):
    """A query was sent once to each leaf of its beam; results of both layouts are the same."""
    q, db = (random_rows(seed, {"a": 70, "b": 40}) for seed in (61, 62))
    # of a query that is there twice, leaves are listed twice
    left, right = table(spark, "q", [*q, q[0]]), table(spark, "db", [*db, db[0]])
    tree = cell_tree.build_tree(right, fresh("tree"), vec="db_vec", n_cells=25)
    seen = []
    monkeypatch.setattr(ann, "knn_join", lambda *a, **kw: seen.append(a[0].columns) or knn_join(*a, **kw))
    args = dict(k=4, beam=4, nprobe=13, by=BY, **VECS)
    once = rows(cell_tree.knn_tree(left, tree, **args))
    assert once and "_probed" in seen[0]
    monkeypatch.setattr(ann, "DENSE_SHARE", 2.0)
    assert rows(cell_tree.knn_tree(left, tree, **args)) == once
    assert "_cell" in seen[-1]
