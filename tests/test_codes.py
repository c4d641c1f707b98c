import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import rows
from test_ann import VECS, clustered
from test_knn import BY, brute_force, random_rows, table
from twinshelf import kernels
from twinshelf.operators import ann, codes, evaluate, knn
from twinshelf.operators.knn import knn_join, with_payload


def coded(spark, db, fresh, n_cells=4, **args):
    index = ann.build_cells(db, fresh("cells"), vec="db_vec", n_cells=n_cells)
    return codes.build_codes(index, fresh("codes"), vec="db_vec", **args)


@pytest.fixture(scope="module")
def sides():
    hot = [1.0] + [0.0] * 7
    q, db = random_rows(1, {"a": 12, "b": 6}), random_rows(2, {"a": 25, "b": 18})
    return q + [(100 + i, "a", hot) for i in range(20)], db + [(100 + i, "a", hot) for i in range(40)]


def test_words_are_the_nearest(spark):
    pick = np.random.default_rng(0)
    words = [pick.normal(size=(256, 3)), pick.normal(size=(7, 2))]
    points = pick.normal(size=(500, 5))
    found = kernels.nearest_words(points, words)
    for part, (some, own) in enumerate(zip(words, (points[:, :3], points[:, 3:]))):
        far = ((own[:, None] - some) ** 2).sum(axis=2)
        assert (far.argmin(axis=1) == found[:, part].astype(int) + 128).all()
    assert np.allclose(kernels.decoded(found.astype(int), words)[:, 3:], words[1][found[:, 1].astype(int) + 128])


def test_few_different_rows_are_coded_without_loss(spark, sides, fresh):
    """At most 256 residuals are their own code words, so the decoded rows are the rows."""
    found = coded(spark, table(spark, "db", sides[1]), fresh, parts=3)
    centroids, words = found.index.centroids(), found.words()
    assert [w.shape[1] for w in words] == [3, 3, 2]
    vectors = {r["db_id"]: r["db_vec"] for r in found.index.rows().select("db_id", "db_vec").collect()}
    got = found.rows().collect()
    assert sorted(r["db_id"] for r in got) == sorted(vectors)
    for r in got:
        point = kernels.decoded(np.array([r["code"]]), words)[0] + centroids[r["cell"]]
        assert np.allclose(point, vectors[r["db_id"]], atol=1e-9)


@pytest.mark.parametrize("block_rows", [1000, 9])
@pytest.mark.parametrize("by", [BY, []])
def test_whole_groups_scored_again_are_exact(spark, sides, fresh, by, block_rows):
    q, db = sides
    left, right = table(spark, "q", q), table(spark, "db", db)
    got = codes.knn_codes(left, coded(spark, right, fresh), k=4, nprobe=4, rerank=200, by=by, block_rows=block_rows, **VECS)
    assert rows(got) == (brute_force(q, db, 4) if by else rows(knn_join(left, right, k=4, **VECS)))


def test_recall_of_few_bytes(spark, fresh):
    db, q = clustered(1, 25, 60), clustered(2, 25, 4)
    left, right = table(spark, "q", q), table(spark, "db", db)
    found = coded(spark, right, fresh, n_cells=25, parts=4)
    info = codes.code_info(found).agg(F.sum("n_bytes")).first()[0]
    assert info == 4 * len(db)
    got = codes.knn_codes(left, found, k=5, target_recall=0.95, **VECS)      # all queries are in the sample
    assert evaluate.recall(got, knn_join(left, right, k=5, **VECS), ["q_id", "db_id"]).first()["recall"] >= 0.95


def test_number_of_rows_scored_again(spark):
    exact = spark.createDataFrame([(1, d) for d in range(10)], "q_id long, db_id long")
    order = [*range(6), *range(100, 130), *range(6, 9)]
    near = spark.createDataFrame([(1, d, i + 1) for i, d in enumerate(order)], "q_id long, db_id long, rank int")
    asked = []

    def candidates(most):
        asked.append(most)
        return near.where(F.col("rank") <= most)

    assert codes.choose_rerank(exact, candidates, ["q_id", "db_id"], 8, 0.6) == 6
    assert codes.choose_rerank(exact, candidates, ["q_id", "db_id"], 8, 0.8) == 38
    assert codes.choose_rerank(exact, candidates, ["q_id", "db_id"], 8, 1.0) == 128     # there are no more
    assert asked == [8, 8, 32, 128, 8, 32, 128]


def test_self_short_null_and_empty(spark, sides, fresh):
    q, db = table(spark, "q", sides[1]), table(spark, "db", sides[1])
    found = coded(spark, db, fresh)
    args = dict(nprobe=1, rerank=8, exclude_self=True, **VECS)
    got = codes.knn_codes(q, found, k=60, **args)
    assert got.where("q_id = db_id").isEmpty()
    assert rows(got) == rows(knn_join(q, db, k=60, exclude_self=True, **VECS).where("true"))
    null = db.withColumn("db_vec", F.when(F.col("db_id") % 2 == 0, F.col("db_vec")))
    assert coded(spark, null, fresh).rows().where("db_id % 2 = 1").isEmpty()
    none = q.withColumn("q_vec", F.when(F.col("q_id") < 0, F.col("q_vec")))
    assert codes.knn_codes(none, found, k=3, **args).count() == 0


def test_whole_groups_leave_a_cell_as_k_rows_a_query(spark, sides, fresh, monkeypatch):
    """They left it as all pairs, which are as many as the square of a group."""
    seen = []
    monkeypatch.setattr(codes, "knn_join", lambda *args, **kw: seen.append(kw["k"]) or knn_join(*args, **kw))
    q, db = (table(spark, m, rows) for m, rows in zip(("q", "db"), sides))
    found = coded(spark, db, fresh)
    for rerank, k in (65, 4), (64, 64):
        seen.clear()
        assert codes.knn_codes(q, found, k=4, nprobe=4, rerank=rerank, by=BY, **VECS).count() == 38 * 4
        assert seen == [k]


def test_codes_in_parts_and_pairs_that_meet_once(spark, fresh, monkeypatch):
    """A task made all hits of 16,384 queries at once, and a query met the codes once a cell."""
    q, db = (random_rows(seed, {"a": 70, "b": 40}) for seed in (71, 72))
    left, right = table(spark, "q", q), table(spark, "db", db)
    found = coded(spark, right, fresh, n_cells=12, parts=2)
    args = dict(k=4, nprobe=9, rerank=9, **VECS)
    seen = []
    for exclude_self in (False, True):
        monkeypatch.undo()
        monkeypatch.setattr(codes, "knn_join", lambda *a, **kw: seen.append(a[0].columns) or knn_join(*a, **kw))
        once = rows(codes.knn_codes(left, found, exclude_self=exclude_self, **args))
        assert once and "_probed" in seen[-1]
        monkeypatch.setattr(ann, "DENSE_SHARE", 2.0)
        assert rows(codes.knn_codes(left, found, exclude_self=exclude_self, **args)) == once
        assert "_cell" in seen[-1]


@pytest.mark.parametrize("own", [False, True])
def test_scores_by_codes_do_not_depend_on_parts(monkeypatch, own):
    pick = np.random.default_rng(3)
    words, centroids = [pick.normal(size=(6, 2)) for _ in range(2)], pick.normal(size=(3, 4))
    db = pa.table({
        "_id": pa.array(pick.permutation(60)), "cell": pa.array(pick.integers(0, 3, 60), pa.int32()),
        "_vec": pa.array((pick.integers(0, 6, (60, 2)) - 128).tolist(), pa.list_(pa.int8())),
    })
    q = pa.table({"_id": pa.array(range(20)), "_vec": pa.array(pick.normal(size=(20, 4)).tolist())})
    schema = pa.schema([("q", pa.int64()), ("db", pa.int64()), ("score", pa.float64()), ("rank", pa.int32())])
    score = kernels.CodeScorer([], 7, own, schema, words=words, centroids=centroids).score
    whole = score(q, db)
    points = kernels.decoded(np.array(db["_vec"].to_pylist()), words) + centroids[db["cell"].to_numpy()]
    for i, vector in enumerate(np.array(q["_vec"].to_pylist())):
        values = [(-kernels.rounded(np.array([s]))[0], j) for s, j in zip(points @ vector, db["_id"].to_pylist()) if not own or i != j]
        want = [(j, -s) for s, j in sorted(values)[:7]]
        got = [(r["db"], r["score"]) for r in whole.to_pylist() if r["q"] == i]
        assert [j for j, _ in got] == [j for j, _ in want] and np.allclose([s for _, s in got], [s for _, s in want])
    monkeypatch.setattr(kernels, "SCAN_ROWS", 9)
    monkeypatch.setattr(kernels, "SCORE_BUFFER", 40)
    assert score(q, db).equals(whole)


def test_a_task_makes_a_bounded_number_of_hits(spark, monkeypatch):
    """A block had as many queries whatever k was, so that its hits grew with both."""
    layout = knn.Layout(16_384, None, 640)
    n = np.array([600_000, 10])
    gq, gd = layout.numbers(n, n)
    assert gq.tolist() == [384, 1] and gd.tolist() == [37, 1]
    sizes = spark.createDataFrame([(600_000, 600_000), (10, 10)], "n_q long, n_db long")
    columns = sizes.select(*layout.columns(F.col("n_q"), F.col("n_db"))).collect()
    assert [tuple(r) for r in columns] == list(zip(gq.tolist(), gd.tolist()))
    q, db = random_rows(1, {"a": 30, "b": 20}), random_rows(2, {"a": 40, "b": 9})
    want = brute_force(q, db, 12)
    for module in (kernels, knn):
        monkeypatch.setattr(module, "HITS_PER_TASK", 60)
    for block_rows in (1000, 5):
        got = knn_join(table(spark, "q", q), table(spark, "db", db), k=12, by=BY, block_rows=block_rows, **VECS)
        assert rows(got) == want


@pytest.mark.parametrize("by", [BY, ()])
@pytest.mark.parametrize("streamed", [False, True])
def test_candidates_bring_no_vectors(spark, fresh, monkeypatch, by, streamed):
    """Each candidate was a row that was joined with two whole vectors."""
    q, db = (random_rows(seed, {"a": 70, "b": 40}) for seed in (81, 82))
    left, right = table(spark, "q", q), table(spark, "db", db)
    found = coded(spark, right, fresh, n_cells=12, parts=2)
    if streamed:
        monkeypatch.setattr(knn, "HELD_ROWS", 5)
        monkeypatch.setattr(knn, "HITS_PER_TASK", 200)
        monkeypatch.setattr(knn, "ROWS_PER_STREAM", 8)
    joined = []
    monkeypatch.setattr(codes, "with_payload", lambda *a: joined.append(a[3]) or with_payload(*a))
    got = rows(codes.knn_codes(left, found, k=4, nprobe=9, rerank=12, by=by, block_rows=5, **VECS))
    assert joined == [["_listed"]]
    # candidates by plain means: the 12 best decoded rows of the nine nearest cells
    centroids, words = found.index.centroids(), found.words()
    coded_rows = {r["db_id"]: r for r in found.rows().collect()}
    vectors = {i: np.float32(v).astype(float) for i, _, v in db}
    want = []
    for i, c, v in q:
        v = np.float32(v).astype(float)
        cells = set(ann.nearest_places(v[None], centroids, 9)[0].tolist())
        near = []
        for j, d, _ in db:
            r = coded_rows[j]
            if r["cell"] in cells and (not by or c == d):
                point = kernels.decoded(np.array([r["code"]]), words)[0] + centroids[r["cell"]]
                near.append((-kernels.rounded(np.array([v @ point]))[0], j))
        near = [(-kernels.rounded(np.array([v @ vectors[j]]))[0], j) for _, j in sorted(near)[:12]]
        want += [(*((c,) if by else ()), i, j, -s, rank) for rank, (s, j) in enumerate(sorted(near)[:4], 1)]
    assert [r[:-2] + r[-1:] for r in got] == [r[:-2] + r[-1:] for r in sorted(want, key=repr)]
    assert np.allclose([r[-2] for r in got], [r[-2] for r in sorted(want, key=repr)])


def test_listed_rows_are_scored_as_often_as_they_are_listed():
    schema = pa.schema([("q", pa.string()), ("db", pa.string()), ("score", pa.float64()), ("rank", pa.int32())])
    numbers, names = pa.list_(pa.float64()), pa.list_(pa.string())
    q = pa.table({"_id": ["x", "y", "z"], "_vec": pa.array([[1.0, 0.0], [0.0, 1.0], None], numbers),
                  "_listed": pa.array([["b", "a", "a", "lost"], [], ["a"]], names)})
    db = pa.table({"_id": ["b", "a", "c", "a"], "_vec": pa.array([[0.5, 0.0], [0.25, 0.0], [9.0, 9.0], [0.125, 0.0]], numbers)})
    got = kernels.ListedScorer([], 4, False, schema).score(q, db).to_pylist()
    assert [tuple(r.values()) for r in got] == [("x", "b", 0.5, 1), ("x", "a", 0.25, 2), ("x", "a", 0.25, 3), ("x", "a", 0.125, 4)]
