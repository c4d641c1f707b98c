"""Sources, sinks, encoders, resumed runs and the stream."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import rows
from test_knn import BY, brute_force, random_rows, table
from twinshelf import MatchConfig, match, prepare_image_side, run_match
from twinshelf.checks import standins
from twinshelf.operators import encode
from twinshelf.operators.encode import batch_encoder, embed, embed_once, register_encoder, word_hash
from twinshelf.operators.knn import knn_join
from twinshelf.plans import match as match_plan
from twinshelf.plans import resume
from twinshelf.session import scratch_path, scratch_root
from twinshelf.sources import images, tables
from twinshelf.sources import vectors as vector_tables
from twinshelf.streaming.match_stream import arriving_rows, match_stream

# ---- tables -------------------------------------------------------------------


def test_scratch_is_the_configured_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None) is None
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_shards_in_numeric_order(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for i in range(12):
        pq.write_table(pa.table({"v": [i * 10]}), tmp_path / f"result_{i}.parquet")
    shards = tables.read_shards(spark, str(tmp_path), part=1)
    assert [r["v"] for r in shards.orderBy("shard").collect()] == [i * 10 for i in range(12)]


def test_group_filter_and_columns_reach_the_scan(spark, sf_dir):
    group = tables.read_group(spark, f"{sf_dir}/part.parquet", "p_type", "PROMO").select("p_name")
    plan = group._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_type,PROMO)" in plan
    assert "ReadSchema: struct<p_name:string,p_type:string>" in plan


def test_write_if_absent_and_recreate(spark, fresh):
    path = fresh()
    assert not tables.exists(spark, path)
    a, b = spark.range(2), spark.range(5)
    assert tables.write_if_absent(a, path).count() == 2
    assert tables.write_if_absent(b, path).count() == 2
    assert tables.exists(spark, path)
    assert tables.recreate(b, path).count() == 5


def test_nothing_is_written_for_no_rows(spark, fresh):
    path = fresh()
    assert not tables.write_if_any(spark.range(0), path)
    assert not tables.exists(spark, path)
    assert tables.write_if_any(spark.range(1), path)


def test_one_folder_per_category(spark, fresh):
    """Names that differ only by a slash stay apart; others are left alone."""
    path = fresh()
    schema = "category string, n int"
    tables.write_by_category(spark.createDataFrame([("a/b", 1), ("ab", 2), ("c", 3)], schema), path)
    tables.write_by_category(spark.createDataFrame([("ab", 9)], schema), path)
    assert rows(spark.read.parquet(path).select("category", "n")) == [("a/b", 1), ("ab", 9), ("c", 3)]


def test_sql_over_frames(spark):
    got = tables.sql_over(spark, "SELECT count(*) AS n FROM {a} JOIN {b} USING (id)",
                          a=spark.range(5), b=spark.range(3))
    assert rows(got) == [(3,)]


def test_vector_length_is_checked_on_read(spark, fresh):
    path = fresh()
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id long, v array<double>")
    vector_tables.write_vectors(df, path, "id", "v")
    assert vector_tables.read_vectors(spark, path, "v", 2).count() == 2
    assert spark.read.parquet(path).schema["v"].dataType.simpleString() == "array<float>"
    with pytest.raises(Exception, match="length is not 3"):
        vector_tables.read_vectors(spark, path, "v", 3).collect()


# ---- encoders -----------------------------------------------------------------


def test_word_hash_is_a_normalised_count(spark):
    import hashlib

    def bucket(w):
        return int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % 32

    df = spark.createDataFrame([("a b a",), ("",), (None,)], "t string")
    got = [r["v"] for r in embed(df, "t", "v", word_hash(32)).collect()]
    want = np.zeros(32)
    for w in "aba":
        want[bucket(w)] += 1
    assert got == [pytest.approx(want / np.linalg.norm(want)), None, None]


def test_registered_encoder_is_built_once_per_task(spark, fresh):
    def factory():
        state = {"built": True}

        def lengths(values):
            assert state.pop("built", None) or state == {}
            return np.array([[len(v.as_py()), 1.0] for v in values])

        return lengths

    register_encoder("length", lambda: batch_encoder(factory))
    df = spark.createDataFrame([("abc",), (None,)], "t string")
    got = [r["v"] for r in embed(df, "t", "v", "length").collect()]
    assert got == [pytest.approx([3 / 10**0.5, 1 / 10**0.5]), None]
    with pytest.raises(ValueError, match="unknown encoder"):
        embed(df, "t", "v", "nope")


def test_only_missing_vectors_are_computed(spark, fresh):
    path = fresh()
    args = dict(key="id", input_col="t", out_col="v", encoder=word_hash(16))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id long, t string")
    assert embed_once(first, path, **args).count() == 2
    assert spark.read.parquet(path).count() == 2
    changed = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c")], "id long, t string")
    got = embed_once(changed, path, **args)
    assert spark.read.parquet(path).count() == 4      # the changed and the new row
    assert rows(got) == rows(embed(changed, "t", "v", word_hash(16)))
    embed_once(changed, path, **args)
    assert spark.read.parquet(path).count() == 4


def test_repeated_rows_and_other_encoders(spark, fresh):
    path = fresh()
    args = dict(key="id", input_col="t", out_col="v")
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (2, None, "x"), (None, "b", "x")],
                               "id long, t string, c string")
    embed_once(df, path, encoder=word_hash(4), **args)
    got = embed_once(df, path, encoder=word_hash(16), **args)
    assert rows(got) == rows(embed(df, "t", "v", word_hash(16)))
    # two runs that both appended the same rows
    stored = spark.read.parquet(path)
    again = fresh()
    stored.union(stored).write.parquet(again)
    assert rows(embed_once(df, again, encoder=word_hash(16), **args)) == rows(got)
    with pytest.raises(ValueError, match="encoder_key"):
        embed_once(df, path, encoder=batch_encoder(lambda: None), **args)


@pytest.mark.parametrize("method", ["exact", "cells", "planes"])
def test_encoder_sees_each_row_once(spark, method):
    seen = spark.sparkContext.accumulator(0)

    def factory():
        def lengths(values):
            seen.add(len(values))
            return np.array([[len(v.as_py()), i % 3 + 1.0] for i, v in enumerate(values)])

        return lengths

    register_encoder("counted", lambda: batch_encoder(factory))
    q, db = (spark.createDataFrame([(i, "n" * (i % 17 + 1), "x") for i in range(400)],
                                   f"{m}_item_id long, {m}_item_name_clean string, {m}_category string")
             for m in ("q", "db"))
    config = MatchConfig(encoder="counted", method=method, vector_width=2, n_cells=4, nprobe=2)
    match(q, db, config).collect()
    assert seen.value == 800


def test_encoder_runs_once_per_row_in_a_match(spark):
    """The vector is neither recomputed for a filter nor for the payload."""
    q, db = (spark.createDataFrame([(1, "a", "x"), (2, "b", "x")],
                                   f"{m}_item_id long, {m}_item_name_clean string, {m}_category string")
             for m in ("q", "db"))
    # in the grid once per side; of two sides of one block, one is encoded beforehand
    for block_rows, calls in ((1, 2), (1000, 1)):
        hits = match(q, db, MatchConfig(block_rows=block_rows))
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == calls


# ---- images -------------------------------------------------------------------


@pytest.fixture(scope="module")
def pictures(spark, sf_dir):
    folder = scratch_path(spark, "pictures")
    drawn = standins.pictures(spark, sf_dir)
    assert images.write_files(drawn, folder, "path", "content") == 500
    return folder


def test_manifest_lists_files_in_order(spark, pictures):
    manifest = images.in_file_order(images.image_manifest(spark, pictures)).collect()
    assert [r["path_idx"] for r in manifest] == [f"{i}_picture" for i in range(500)]
    assert all(r["file_exists"] and r["file_path"].startswith("/") for r in manifest)


def test_pictures_are_decoded(spark, sf_dir, pictures):
    row = images.read_images(spark, pictures).where("file_path LIKE '%/0_picture.jpg'").first()
    image = row["image"]
    assert (image["height"], image["width"], image["nChannels"]) == (8, 8, 3)
    pixels = np.frombuffer(image["data"], np.uint8).reshape(8, 8, 3)
    vector = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id = 0").first()
    want = np.floor((np.array(vector["embedding"]) + 1) * 127.5).reshape(8, 8)
    assert pixels[..., 2].tolist() == want.tolist()
    assert pixels[..., 1].tolist() == (255 - want).tolist()


def test_a_file_that_is_no_image_keeps_its_row(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "0_x.jpg").write_bytes(b"no image")
    read = images.read_images(spark, str(tmp_path))
    assert [(r.file_path, r.image) for r in read.collect()] == [(f"{tmp_path}/a/0_x.jpg", None)]
    assert images.unreadable(read).count() == 1
    side = spark.createDataFrame([(1, "c", f"{tmp_path}/a/0_x.jpg")], "q_item_id long, q_category string, q_file_path string")
    with_vectors = match_plan.with_vectors(side, "q", MatchConfig(match_by="image"), read)
    assert [r.image_embed for r in with_vectors.collect()] == [None]
    assert images.image_manifest(spark, str(tmp_path)).count() == 1


def test_match_by_image_against_brute_force(spark, sf_dir):
    from twinshelf.checks import queries
    from twinshelf.kernels import CHANNEL_MEAN, CHANNEL_STD

    source = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    vectors = {}
    for r in source:
        b = np.floor((np.array(r["embedding"]) + 1) * 127.5)
        v = np.stack([(c / 255 - m) / s for c, m, s in
                      zip((b, 255 - b, np.full(64, 64.0)), CHANNEL_MEAN, CHANNEL_STD)]).ravel()
        vectors[r["vec_id"]] = (str(r["label"]), v / np.linalg.norm(v))
    got = queries.match_by_image(spark, sf_dir).collect()
    assert len(got) == 5 * len(source)
    for r in got:
        assert r["category"] == vectors[r["q_item_id"]][0] == vectors[r["db_item_id"]][0]
        want = vectors[r["q_item_id"]][1] @ vectors[r["db_item_id"]][1]
        assert r["score_image_embed"] == pytest.approx(want, abs=2e-5)
    for i, (label, v) in list(vectors.items())[::50]:
        best = sorted((-(v @ w), j) for j, (other, w) in vectors.items() if other == label)[:5]
        mine = sorted(r["score_image_embed"] for r in got if r["q_item_id"] == i)
        assert mine == pytest.approx(sorted(-s for s, _ in best), abs=2e-5)


def test_images_are_read_once_for_both_sides(spark, pictures, monkeypatch):
    """The files were read and embedded once for each side."""
    listed = images.image_manifest(spark, pictures).select(F.col("path_idx").alias("item_id"), F.lit("a").alias("category"), "file_path")
    q, db = (listed.withColumnsRenamed({c: f"{m}_{c}" for c in listed.columns}) for m in ("q", "db"))
    q = q.unionByName(q.limit(1).selectExpr("'none' q_item_id", "q_category", "'/none.jpg' q_file_path"))
    register_encoder("once", lambda: encode.grid_mean(grid=8, size=8))
    made = []
    embed = match_plan.embed
    monkeypatch.setattr(match_plan, "embed", lambda *a: made.append(a[1]) or embed(*a))
    got = match_plan.match(q, db, MatchConfig(match_by="image", encoder="once", top_k=2), images=images.read_images(spark, pictures))
    n = listed.count()
    assert made == ["image"] and got.count() == 2 * n
    assert got.where("q_item_id = db_item_id").count() == n


def test_image_files_to_matches(spark, sf_dir, pictures, fresh):
    """Raw rows, image files by row index, both sides prepared, matched and written."""
    raw = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("item_id"), F.lit("Some NAME").alias("item_name"),
        F.lit("http://host/picture").alias("image_url"), F.col("label").cast("string").alias("kind"))
    manifest = images.image_manifest(spark, pictures)
    paths = {}
    for side in ("q", "db"):
        paths[side] = fresh()
        prepare_image_side(raw, manifest, side).write.parquet(paths[side])
    out = fresh()
    register_encoder("raster", lambda: encode.grid_mean(grid=8, size=8))
    config = MatchConfig(match_by="image", category="kind", top_k=1, encoder="raster")
    took = run_match(spark, paths["q"], paths["db"], out, config, image_folder=pictures)
    assert set(took) == {"time_perf_image"}
    got = spark.read.parquet(out)
    # the nearest picture is the picture itself
    assert got.where("q_item_id = db_item_id AND score_image_embed = 1.0").count() == 500
    assert got.where("q_item_name_clean <> 'some name'").count() == 0
    with pytest.raises(ValueError, match="images"):
        run_match(spark, paths["q"], paths["db"], fresh(), config)


# ---- resume and stream --------------------------------------------------------


def _inputs(spark, fresh):
    paths = {}
    for side, seed in (("q", 1), ("db", 2)):
        data = [(i, f"n{i}", c, v) for i, c, v in random_rows(seed, {"a/b": 6, "ab": 4, "one": 1})]
        schema = (f"{side}_item_id long, {side}_item_name string, {side}_category string, "
                  "text_embed array<float>")
        paths[side] = fresh()
        spark.createDataFrame(data, schema).write.parquet(paths[side])
    return paths


def _result(spark, out):
    return rows(spark.read.parquet(out).select(
        "category", "q_item_id", "db_item_id", "score_text_embed", "rank"))


@pytest.mark.parametrize("mode", ["category", "query"])
def test_resumed_run_equals_a_fresh_one(spark, fresh, mode):
    paths, out, whole, part = _inputs(spark, fresh), fresh(), fresh(), fresh()
    config = MatchConfig(top_k=3)
    run_match(spark, paths["q"], paths["db"], whole, config)
    spark.read.parquet(paths["q"]).where("q_category = 'ab'").write.parquet(part)
    if mode == "query":
        part = fresh()
        spark.read.parquet(paths["q"]).where("q_item_id <> 6").write.parquet(part)
    run_match(spark, part, paths["db"], out, config, resume=mode)
    before = spark.read.parquet(out).count()
    took = run_match(spark, paths["q"], paths["db"], out, config, resume=mode)
    assert set(took) == {"time_perf_text"}
    assert _result(spark, out) == _result(spark, whole)
    assert before < spark.read.parquet(out).count()
    assert {r[0] for r in _result(spark, out)} == {"a/b", "ab"}     # 'one' is too small
    with pytest.raises(ValueError, match="resume"):
        run_match(spark, paths["q"], paths["db"], out, config, resume="never")


@pytest.mark.parametrize("mode", ["category", "query"])
def test_odd_categories_survive_a_resumed_run(spark, fresh, mode):
    odd = ["01", "1.0", "", "a/b", "2021-01-01", "1e3", "c_1", " x", "%41"]
    paths, out = {}, fresh()
    for side in ("q", "db"):
        paths[side] = fresh()
        data = [(10 * k + i, c, [1.0, float(i)]) for k, c in enumerate(odd) for i in range(3)]
        spark.createDataFrame(
            data, f"{side}_item_id long, {side}_category string, text_embed array<float>"
        ).write.parquet(paths[side])
    counts = []
    for _ in range(3):
        run_match(spark, paths["q"], paths["db"], out, MatchConfig(top_k=2), resume=mode)
        counts.append(tables.read_by_category(spark, out).count())
    assert counts == [2 * 3 * len(odd)] * 3
    assert {r.category for r in tables.read_by_category(spark, out).collect()} == set(odd)


def test_finished_categories_are_not_matched_again(spark, fresh):
    paths, out = _inputs(spark, fresh), fresh()
    run_match(spark, paths["q"], paths["db"], out)
    q = spark.read.parquet(paths["q"])
    left = resume.pending_categories(q, "q_category", out)
    assert {r["q_category"] for r in left.collect()} == {"one"}
    assert resume.pending_queries(q, "q_item_id", "q_category", out).count() == 1
    assert resume.pending_categories(q, "q_category", fresh()).count() == q.count()


def test_match_with_vector_tables(spark, fresh):
    q, db = (spark.createDataFrame([(1, "a b", "x"), (2, "c", "x")],
                                   f"{m}_item_id long, {m}_item_name_clean string, {m}_category string")
             for m in ("q", "db"))
    stored = (fresh(), fresh())
    got = rows(match(q, db, vector_tables=stored))
    assert got == rows(match(q, db)) == rows(match(q, db, vector_tables=stored))


def test_stream_matches_each_arrival_once(spark, fresh, tmp_path):
    data, db = random_rows(1, {"a": 8, "b": 5}), random_rows(2, {"a": 9, "b": 4})
    source, out, progress = str(tmp_path / "in"), fresh(), fresh()
    db_table = table(spark, "db", db)

    def batch(new):
        return knn_join(new, db_table, k=3, q_vec="q_vec", db_vec="db_vec", by=BY)

    def run():
        arriving = spark.readStream.schema(table(spark, "q", data).schema).parquet(source)
        match_stream(arriving, batch, out, progress).awaitTermination()
        return rows(spark.read.parquet(out).drop("batch_id"))

    table(spark, "q", data[:5]).write.mode("append").parquet(source)
    assert run() == brute_force(data[:5], db, 3)
    table(spark, "q", data[5:]).write.mode("append").parquet(source)
    assert run() == brute_force(data, db, 3)
    assert run() == brute_force(data, db, 3)


@pytest.mark.parametrize("files", [1, 3])
def test_stream_of_a_folder_or_one_file(spark, fresh, tmp_path, files):
    """A table of several files is a folder; read by the name of its files alone, it gave no rows and no result."""
    data, db = random_rows(1, {"a": 8, "b": 5}), random_rows(2, {"a": 9, "b": 4})
    path, out, db_table = str(tmp_path / "vectors.parquet"), fresh(), table(spark, "db", db)
    written = table(spark, "q", data)
    if files == 1:
        pq.write_table(written.toArrow(), path)
    else:
        written.repartition(files).write.parquet(path)
    arriving = arriving_rows(spark, path, written.schema)
    match_stream(
        arriving, lambda new: knn_join(new, db_table, k=3, q_vec="q_vec", db_vec="db_vec", by=BY), out, fresh()
    ).awaitTermination()
    assert rows(spark.read.parquet(out).drop("batch_id")) == brute_force(data, db, 3)
