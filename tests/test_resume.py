"""Runs that know what is finished, and database rows that arrive."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from test_knn import BY, brute_force, random_rows, table
from twinshelf import MatchConfig, run_match
from twinshelf.operators.knn import knn_join
from twinshelf.plans import match as match_plan
from twinshelf.plans.ledger import Ledger, config_key, read_matched
from twinshelf.streaming.database_stream import match_database_stream, read_state, versions


@pytest.fixture
def inputs(spark, fresh):
    """Two sides; queries 90 and 91 can have no hits: no vector, and no row of their category."""
    data = random_rows(3, {"a/b": 9, "c": 6})
    more = [(90, "c", None), (91, "d", [1.0] * 8), (None, "c", [1.0] * 8), (92, None, [1.0] * 8)]
    paths = {"q": fresh(), "db": fresh(), "some": fresh()}
    for side, part in (("q", data + more), ("db", data), ("some", data[::2])):
        mode = "db" if side == "db" else "q"
        spark.createDataFrame(
            part, f"{mode}_item_id long, {mode}_category string, text_embed array<float>"
        ).write.parquet(paths[side])
    return paths


def read(spark, out, **args):
    hits = read_matched(spark, out, **args)
    return rows(hits.select("category", "q_item_id", "db_item_id", "score_text_embed", "rank"))


def test_finished_queries_are_not_matched_again(spark, inputs, fresh, monkeypatch):
    config, out, whole, asked = MatchConfig(top_k=3), fresh(), fresh(), []
    match = match_plan.match

    def counted(q, *args, **kwargs):
        asked.append(q.count())
        return match(q, *args, **kwargs)

    monkeypatch.setattr(match_plan, "match", counted)
    for path in ("some", "q", "q"):
        run_match(spark, inputs[path], inputs["db"], out, config, resume="query")
    n = spark.read.parquet(inputs["some"]).count()
    # a query without hits is finished too; rows without id or category never count,
    # nor do those of a category that is too small on one side
    assert asked == [n, 15 + 1 - n]
    run_match(spark, inputs["q"], inputs["db"], whole, config, resume="query")
    assert read(spark, out) == read(spark, whole)
    # another k: nothing is finished, and the new hits are read
    run_match(spark, inputs["q"], inputs["db"], out, MatchConfig(top_k=2), resume="query")
    assert asked[-1] == 16
    assert {r[-1] for r in read(spark, out)} == {1, 2}
    first = config_key(config, inputs["db"])
    assert read(spark, out, key=first) == read(spark, whole)
    # block size changes nothing
    run_match(spark, inputs["q"], inputs["db"], out, MatchConfig(top_k=2, block_rows=5), resume="query")
    assert len(asked) == 4


def test_a_run_that_broke_off_leaves_nothing(spark, inputs, fresh, monkeypatch):
    out, config = fresh(), MatchConfig(top_k=3)
    commit = Ledger.commit
    monkeypatch.setattr(Ledger, "commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        run_match(spark, inputs["q"], inputs["db"], out, config, resume="query")
    assert read_matched(spark, out) is None
    monkeypatch.setattr(Ledger, "commit", commit)
    run_match(spark, inputs["q"], inputs["db"], out, config, resume="query")
    whole = fresh()
    run_match(spark, inputs["q"], inputs["db"], whole, config, resume="query")
    assert read(spark, out) == read(spark, whole)


def test_keys_tell_settings_apart():
    base = config_key(MatchConfig(), "db")
    assert base == config_key(MatchConfig(block_rows=9, index_path="x"), "db")
    assert base == config_key(MatchConfig(encoder="word_hash"), "db")
    others = [config_key(MatchConfig(top_k=9), "db"), config_key(MatchConfig(encoder="x"), "db"),
              config_key(MatchConfig(exclude_self=True), "db"), config_key(MatchConfig(), "other")]
    assert len({base, *others}) == 5


def test_database_rows_that_arrive(spark, fresh):
    """Three arrivals, one of them empty for most queries, and one batch that is run twice."""
    q, db = random_rows(1, {"a": 12, "b": 5}), random_rows(2, {"a": 40, "b": 3})
    folder, state, progress = fresh(), fresh(), fresh()
    queries = table(spark, "q", q)
    schema = table(spark, "db", db[:1]).schema

    def step():
        arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        match_database_stream(arriving, lambda new: knn_join(queries, new, k=4, by=BY, q_vec="q_vec", db_vec="db_vec"),
                              state, progress, k=4, query=["category", "q_id"]).awaitTermination()

    assert read_state(spark, state) is None
    for n in (10, 11, 30, len(db)):
        start = {10: 0, 11: 10, 30: 11}.get(n, 30)
        table(spark, "db", db[start:n]).coalesce(1).write.mode("append").parquet(folder)
        step()
        got = read_state(spark, state).select("category", "q_id", "db_id", "score", "rank")
        assert rows(got) == brute_force(q, db[:n], 4)
    assert len(versions(spark, state)) == 2
    # a row that comes again under its id replaces itself
    again = [(db[0][0], db[0][1], (-np.array(db[0][2])).tolist())]
    table(spark, "db", again).coalesce(1).write.mode("append").parquet(folder)
    step()
    pairs = read_state(spark, state)
    assert pairs.groupBy("category", "q_id", "db_id").count().where(F.col("count") > 1).isEmpty()
