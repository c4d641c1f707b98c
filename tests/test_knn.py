import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from twinshelf.operators import knn, small
from twinshelf.operators.encode import word_hash
from twinshelf.operators.knn import knn_join, with_payload
from twinshelf.operators.nest import explode_hits, nest_hits

BY = [("qc", "dc", "category")]


def table(spark, side, data):
    """Rows of (id, category, vector)."""
    id_type = "string" if isinstance(data[0][0], str) else "long"
    prefix = {"q": "q", "db": "d"}[side]
    return spark.createDataFrame(
        data, f"{side}_id {id_type}, {prefix}c string, {side}_vec array<float>")


def join(q, db, k=2, by=BY, **kw):
    return knn_join(q, db, k=k, q_vec="q_vec", db_vec="db_vec", by=by, **kw)


def brute_force(q, db, k, min_rows=1):
    out = []
    for category in {c for _, c, _ in q} - {None}:
        mine = [(i, v) for i, c, v in q if c == category]
        theirs = [(i, v) for i, c, v in db if c == category]
        if min(len(mine), len(theirs)) < min_rows:
            continue
        for i, v in mine:
            scored = []
            for j, w in theirs:
                s = float(np.dot(np.float32(v).astype(float), np.float32(w).astype(float)))
                scored.append((-(np.round(s, 5) if s <= 1 else np.round(s, 1)), j))
            for rank, (s, j) in enumerate(sorted(scored)[:k], 1):
                out.append((category, i, j, -s, rank))
    return sorted(out, key=repr)


def random_rows(seed, sizes, width=8):
    rng = np.random.default_rng(seed)
    data, i = [], 0
    for category, n in sizes.items():
        for _ in range(n):
            v = np.round(rng.normal(size=width), 1)
            data.append((i, category, [float(x) for x in v / np.linalg.norm(v)]))
            i += 1
    return data


@pytest.fixture(scope="module")
def skewed():
    """One category holds most rows; one has a single row; one is on one side only."""
    q = random_rows(1, {"big": 60, "small": 3, "one": 1, "q only": 2})
    db = random_rows(2, {"big": 90, "small": 2, "one": 5, "db only": 4})
    return q, db


# the database is held, the query side is held, grids of one and of several blocks
@pytest.mark.parametrize("block_rows", [1000, 80, 20, 7, 1])
def test_same_for_every_block_size(spark, skewed, block_rows):
    q, db = skewed
    got = join(table(spark, "q", q), table(spark, "db", db), k=4, block_rows=block_rows)
    assert rows(got) == brute_force(q, db, 4)


def test_scanned_side_is_spread_when_the_work_is_large(spark, skewed, monkeypatch):
    monkeypatch.setattr(knn, "PAIRS_TO_SPREAD", 100)
    monkeypatch.setattr(knn, "ROWS_WORTH_A_SHUFFLE", 1)
    q, db = skewed
    got = join(table(spark, "q", q).coalesce(1), table(spark, "db", db), k=4)
    assert "RoundRobinPartitioning(8)" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == brute_force(q, db, 4)


def test_same_for_every_partitioning(spark, skewed):
    q, db = skewed
    got = join(table(spark, "q", q).repartition(5), table(spark, "db", db).repartition(3), k=4)
    assert rows(got) == brute_force(q, db, 4)


@pytest.mark.parametrize("block_rows", [1000, 10])
@pytest.mark.parametrize("fetched, broadcast_bytes", [(0, 1 << 20), (0, 0)])
def test_too_many_groups_for_the_driver_or_a_broadcast(
    spark, skewed, monkeypatch, fetched, broadcast_bytes, block_rows
):
    monkeypatch.setattr(small, "ROWS_FETCHED", fetched)
    monkeypatch.setattr(small, "BROADCAST_BYTES", broadcast_bytes)
    q, db = skewed
    got = join(table(spark, "q", q), table(spark, "db", db), k=4, block_rows=block_rows)
    assert rows(got) == brute_force(q, db, 4)


def test_guard_needs_two_rows_on_both_sides(spark, skewed):
    q, db = skewed
    got = join(table(spark, "q", q), table(spark, "db", db), k=4, min_group_size=2)
    assert rows(got) == brute_force(q, db, 4, min_rows=2)
    assert {r["category"] for r in got.collect()} == {"big", "small"}


def test_null_category_vector_and_id_never_match(spark):
    v = [1.0, 0.0]
    q = table(spark, "q", [(1, None, v), (2, "a", None), (3, "a", v), (None, "a", v)])
    db = table(spark, "db", [(1, None, v), (2, "a", v), (3, "a", None)])
    assert rows(join(q, db)) == [("a", 3, 2, 1.0, 1)]


def test_ties_go_to_the_lower_id(spark):
    same = [(i, "a", [1.0, 0.0]) for i in (9, 4, 7, 1)]
    got = join(table(spark, "q", same), table(spark, "db", same), k=2, block_rows=1)
    assert {r["db_id"] for r in got.collect()} == {1, 4}
    assert got.count() == 8


def test_fewer_rows_than_k(spark):
    two = [(1, "a", [1.0, 0.0]), (2, "a", [0.0, 1.0])]
    got = join(table(spark, "q", two), table(spark, "db", two), k=10)
    assert got.count() == 4


def test_text_ids(spark):
    q = [("x", "a", [1.0, 0.0]), ("y", "a", [0.0, 1.0])]
    got = join(table(spark, "q", q), table(spark, "db", q), exclude_self=True)
    assert rows(got) == [("a", "x", "y", 0.0, 1), ("a", "y", "x", 0.0, 1)]


@pytest.mark.parametrize("block_rows", [1000, 80, 3])
def test_without_categories(spark, skewed, block_rows):
    q, db = ([(i, "all", v) for i, _, v in side] for side in skewed)
    got = join(table(spark, "q", q), table(spark, "db", db), k=3, by=(), block_rows=block_rows)
    assert rows(got) == sorted((r[1:] for r in brute_force(q, db, 3)), key=repr)
    one = table(spark, "q", q[:1])
    assert join(one, table(spark, "db", db), by=(), min_group_size=2).count() == 0


def test_empty_side(spark, skewed):
    q, db = skewed
    none = table(spark, "q", q).where("false")
    assert join(none, table(spark, "db", db)).count() == 0
    assert join(none, table(spark, "db", db), by=()).count() == 0


def test_scores_fall_with_rank(spark, skewed):
    got = join(*(table(spark, s, d) for s, d in zip(("q", "db"), skewed)), k=5).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by_query.setdefault(r["q_id"], []).append(r["score"])
    assert all(s == sorted(s, reverse=True) for s in by_query.values())


def test_a_missing_column_is_named(spark, skewed):
    q, db = skewed
    with pytest.raises(ValueError, match="nope"):
        join(table(spark, "q", q), table(spark, "db", db), by=[("nope", "dc", "category")])


def test_different_vector_lengths_stop_the_job(spark):
    q = table(spark, "q", [(1, "a", [1.0]), (2, "a", [1.0, 2.0])])
    with pytest.raises(Exception, match="different lengths"):
        join(q, table(spark, "db", [(1, "a", [1.0])])).collect()


def test_only_needed_columns_are_scanned_and_no_cross_join(spark, sf_dir, fresh):
    wide = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("payload", F.lit("x" * 9))
    path = fresh()
    wide.write.parquet(path)
    q = spark.read.parquet(path).withColumnsRenamed({"vec_id": "q_id", "embedding": "q_vec"})
    db = spark.read.parquet(path).withColumnsRenamed({"vec_id": "db_id", "embedding": "db_vec"})
    for by, block_rows in ([("label", "label", "category")], 1000), ((), 1000), ((), 20):
        plan = join(q, db, by=by, block_rows=block_rows)._jdf.queryExecution().executedPlan().toString()
        assert "payload" not in plan
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_payload_keeps_hits_without_one(spark):
    hits = spark.createDataFrame([(1, 5), (1, 6)], "q_id long, db_id long")
    side = spark.createDataFrame([(5, "five", 0)], "item long, name string, other int")
    got = with_payload(hits, side, {"db_id": "item"}, ["name"])
    assert got.columns == ["q_id", "db_id", "name"]
    assert rows(got) == [(1, 5, "five"), (1, 6, None)]


def test_nest_then_explode_is_the_same(spark, skewed):
    hits = join(*(table(spark, s, d) for s, d in zip(("q", "db"), skewed)), k=3)
    nested = nest_hits(hits, ["category", "q_id"], ["db_id", "score"])
    assert nested.count() == hits.select("category", "q_id").distinct().count()
    assert rows(explode_hits(nested)) == rows(hits.drop("rank"))


def test_explode_nulls_and_uneven_lists(spark):
    schema = "q_id long, db_id array<long>, score array<double>"
    df = spark.createDataFrame([(1, [5, 6], [0.2, 0.1]), (2, None, None)], schema)
    assert rows(explode_hits(df)) == [(1, 5, 0.2), (1, 6, 0.1), (2, None, None)]
    uneven = spark.createDataFrame([(1, [5, 6], [0.2])], schema)
    with pytest.raises(Exception, match="different lengths"):
        explode_hits(uneven).collect()


@pytest.mark.parametrize("fetched", [5_000, 0])
def test_a_row_is_sent_to_few_blocks(spark, monkeypatch, fetched):
    """Cells grow with the square of a group's blocks; these were its rows over ``block_rows`` without bound."""
    monkeypatch.setattr(small, "ROWS_FETCHED", fetched)
    sizes = spark.createDataFrame([("a", 1_000, 3_000), ("b", 20, 33), ("c", 400_000, 17)], "category string, n_q long, n_db long")
    _, total = knn.group_totals(sizes, 16)
    assert (total.gd, total.cells) == (8, 8 * 8 + 2 * 3 + 25 * 2)
    got = sizes.select(knn.blocks(F.col("n_q"), 16).alias("n")).toArrow()["n"].to_pylist()
    assert sorted(got) == [2, 8, 25]


@pytest.mark.parametrize("by", [BY, ()])
def test_equal_values_are_scored_once(spark, monkeypatch, by):
    """Cells had all pairs of the rows; now of different values, with k rows of each on the database side."""
    words = [f"{a} {b}" for a in ("red", "blue", "green") for b in ("cup", "cap", "cub")]
    q = [(i, "ab"[i % 9 % 2], words[i % 9]) for i in range(180)] + [(500, "a", None), (501, None, "red cup"), (3, "a", "")]
    db = [(1_000 - i, "ab"[i % 9 % 2], words[i % 9]) for i in range(270)] + [(2_000, "a", None), (7, "b", ""), (8, "c", "x")]
    sides = [spark.createDataFrame(rows, f"{p}_id long, {c} string, {p}_text string")
             for rows, p, c in ((q, "q", "qc"), (db, "db", "dc"))]
    seen = []
    grid = knn.score_grid
    monkeypatch.setattr(knn, "score_grid", lambda *args: seen.append(args[3]) or grid(*args))
    args = dict(k=4, by=by, block_rows=2, min_group_size=2)
    got = knn.knn_join_values(*sides, q_value="q_text", db_value="db_text", vectors=word_hash(16), **args)
    plain = [side.withColumn(f"{p}_vec", word_hash(16)(F.col(f"{p}_text"))) for side, p in zip(sides, ("q", "db"))]
    expected = join(*plain, **args)
    assert rows(got) == rows(expected) and got.columns == expected.columns
    assert seen[0].n_q == 10 and seen[0].n_db <= 9 * 4 + 2 and seen[1].n_q > 180


@pytest.mark.parametrize("by", [BY, []])
@pytest.mark.parametrize("kind", ["cells", "slices", "self"])
def test_large_groups_are_streamed(spark, skewed, monkeypatch, by, kind):
    """A group's rows were copied once for each block of the other side, however many these were."""
    q, db = skewed
    monkeypatch.setattr(knn, "HELD_ROWS", 4)
    monkeypatch.setattr(knn, "ROWS_PER_STREAM", 8)
    if kind == "slices":
        monkeypatch.setattr(knn, "BLOCKS_PER_SLICE", 3)
    # ties between blocks, a row without vector, one without id, and rows without a group
    db = db + [(1000 + i, "big", q[i][2]) for i in range(6)] + [(2000 + i, "big", q[0][2]) for i in range(6)]
    q = q + [(5000 + i, "big", q[i][2]) for i in range(6)]
    if not by:
        q, db = ([(i, "", v) for i, _, v in side] for side in (q, db))
    else:
        q, db = q + [(300, None, q[0][2])], db + [(301, None, q[0][2])]
    odd = [(None, q[0][1], q[0][2]), (4000, q[0][1], None)]
    if kind == "self":
        db = [(i, c, v) for i, c, v in q]
        want = brute_force(q, db, 5)
        want = [r for r in want if r[1] != r[2]]
    got = join(table(spark, "q", q + odd), table(spark, "db", db + odd), k=4, by=by, block_rows=1,
               exclude_self=kind == "self")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and ("Generate" in plan) == bool(by)
    if by:
        got = got.select("category", "q_id", "db_id", "score", "rank")
    else:
        got = got.selectExpr("'' AS category", "q_id", "db_id", "score", "rank")
    if kind == "self":
        pairs = {(c, a, b) for c, a, b, _, _ in rows(got)}
        left = {}
        for c, a, b, s, _ in sorted(want, key=lambda r: (r[1], -r[3], r[2])):
            left.setdefault((c, a), []).append(b)
        assert pairs == {(c, a, b) for (c, a), found in left.items() for b in found[:4]}
    else:
        assert rows(got) == brute_force(q, db, 4)


def test_streamed_rows_are_made_once(spark, skewed, monkeypatch, tmp_path):
    """Rows of large and small groups come from one run of an encoder."""
    q, db = skewed
    monkeypatch.setattr(knn, "HELD_ROWS", 4)
    monkeypatch.setattr(knn, "ROWS_PER_STREAM", 8)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<float>")
    def encode(v):
        seen.add(1)
        return v

    made = table(spark, "q", q).withColumn("q_vec", encode.asNondeterministic()("q_vec"))
    got = join(made, table(spark, "db", db), k=4, block_rows=1)
    assert rows(got) == brute_force(q, db, 4)
    assert seen.value == len(q)
