from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import rows
from test_knn import random_rows
from twinshelf import MatchConfig, export_review, match, prepare_image_side, prepare_text_side
from twinshelf.operators import evaluate
from twinshelf.operators.rows import (
    batch_number, categories, duplicate_keys, first_rows, keep_first, last_rows, latest_snapshot,
    row_index,
)
from twinshelf.plans import coverage, extract
from twinshelf.plans.export import save_csv
from twinshelf.plans.rerank import all_categories, in_rank_order, rerank, run_rerank
from twinshelf.sources.tables import read_csv

# ---- rerank -------------------------------------------------------------------

HIT = ("category string, q_item_id long, q_item_name string, db_item_id long, "
       "db_item_name string, score_{}_embed double")


def hits(spark, kind, data):
    named = [(c, q, f"q{q}", d, n or f"d{d}", s) for c, q, d, n, s in data]
    return spark.createDataFrame(named, HIT.format(kind))


def fused(df):
    return {(r["category"], r["q_item_id"], r["db_item_id"], r["db_item_name"]):
            (r["score_text"], r["score_image"], r["score_mean"], r["rank"]) for r in df.collect()}


def test_categories_of_either_kind(spark):
    text = hits(spark, "text", [("both", 1, 5, None, 0.8), ("text", 1, 5, None, 0.7)])
    image = hits(spark, "image", [("both", 1, 5, None, 0.4), ("both", 1, 6, None, 0.9),
                                  ("image", 1, 5, None, 0.2)])
    assert fused(rerank(text, image)) == {
        ("both", 1, 5, "d5"): (0.8, 0.4, pytest.approx(0.6), 2),
        ("both", 1, 6, "d6"): (None, 0.9, 0.9, 1),
        ("text", 1, 5, "d5"): (0.7, None, 0.7, 1),
        ("image", 1, 5, "d5"): (None, 0.2, 0.2, 1),
    }
    assert rows(all_categories(text, image)) == [("both",), ("image",), ("text",)]


def test_both_columns_exist_when_one_kind_is_empty(spark):
    text = hits(spark, "text", [("a", 1, 5, None, 0.8)])
    none = hits(spark, "image", [("a", 1, 5, None, 0.8)]).where("false")
    assert fused(rerank(text, none)) == {("a", 1, 5, "d5"): (0.8, None, 0.8, 1)}
    assert rerank(text.where("false"), none).count() == 0


def test_repeated_pairs_add_up_and_names_keep_pairs_apart(spark):
    text = hits(spark, "text", [("a", 1, 5, None, 0.25), ("a", 1, 5, None, 0.5),
                                ("a", 1, 5, "other", 0.5)])
    none = text.withColumnRenamed("score_text_embed", "score_image_embed").where("false")
    assert fused(rerank(text, none)) == {
        ("a", 1, 5, "d5"): (0.75, None, 0.75, 1), ("a", 1, 5, "other"): (0.5, None, 0.5, 2)}


def test_fused_score_lies_between_its_parts(spark, sf_dir):
    from twinshelf.checks import queries

    both = queries.rerank_fusion(spark, sf_dir).where(
        "score_text IS NOT NULL AND score_image IS NOT NULL")
    outside = both.where("score_mean < least(score_text, score_image) "
                         "OR score_mean > greatest(score_text, score_image)")
    assert both.count() > 0 and outside.count() == 0


def test_one_shuffle(spark, fresh):
    path = fresh()
    hits(spark, "text", [("a", 1, 5, None, 0.5)]).write.parquet(path)
    text = spark.read.parquet(path)
    plan = rerank(text, text.withColumnRenamed("score_text_embed", "score_image_embed"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_written_rerank_skips_finished_categories(spark, fresh):
    text_path, image_path, out = fresh(), fresh(), fresh()
    hits(spark, "text", [("a", 1, 5, None, 0.5)]).write.partitionBy("category").parquet(text_path)
    run_rerank(spark, text_path, image_path, out)   # no image matches yet
    assert fused(spark.read.parquet(out)) == {("a", 1, 5, "d5"): (0.5, None, 0.5, 1)}
    image = hits(spark, "image", [("a", 1, 5, None, 0.1), ("b", 2, 5, None, 0.3)])
    image.write.partitionBy("category").parquet(image_path)
    run_rerank(spark, text_path, image_path, out)
    assert fused(spark.read.parquet(out)) == {
        ("a", 1, 5, "d5"): (0.5, None, 0.5, 1), ("b", 2, 5, "d5"): (None, 0.3, 0.3, 1)}
    with pytest.raises(ValueError, match="no matches"):
        run_rerank(spark, fresh(), fresh(), out)


def test_rank_order_puts_missing_scores_last(spark):
    df = spark.createDataFrame([(2, 0.1, 1), (1, None, 2), (1, 0.3, 1)],
                               "q_item_id long, score_mean double, rank int")
    assert [tuple(r) for r in in_rank_order(df).collect()] == [(1, 0.3, 1), (1, None, 2), (2, 0.1, 1)]


def test_encoder_comparison(spark):
    schema = "q long, d long, score double, rank int"
    a = spark.createDataFrame([(1, 5, 0.9, 1), (1, 6, 0.8, 2)], schema)
    b = spark.createDataFrame([(1, 6, 0.7, 1), (2, 9, 0.6, 1)], schema)
    both = evaluate.side_by_side(a, b, ["q", "d"], "a", "b")
    assert rows(both) == [(1, 5, 0.9, 1, None, None), (1, 6, 0.8, 2, 0.7, 1),
                          (2, 9, None, None, 0.6, 1)]
    assert rows(evaluate.overlap(both, ["q"], "a", "b")) == [(1, 2, 1, 1, 0.5), (2, 0, 1, 0, 0.0)]


def test_ratio_to_min(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 3.0), ("c", None)], "name string, t double")
    assert rows(evaluate.ratio_to_min(df, ["t"])) == [
        ("a", 2.0, 1.0), ("b", 3.0, 1.5), ("c", None, None)]


# ---- preparation --------------------------------------------------------------


def test_text_side(spark):
    df = spark.createDataFrame([(1, "A!  B", None), (2, None, "x"), (3, "c", "y")],
                               "item_id long, item_name string, other string")
    base, cleaned = Observation(), Observation()
    keyed = prepare_text_side(df, "q", ["item_name"], base=base, cleaned=cleaned)
    assert rows(keyed) == [(1, "A!  B", None, "a b"), (3, "c", "y", "c")]
    assert keyed.columns == ["q_item_id", "q_item_name", "q_other", "q_item_name_clean"]
    assert (base.get["n_rows"], cleaned.get["n_rows"]) == (3, 2)
    assert rows(prepare_text_side(df)) == [(3, "c", "y", "c")]
    with pytest.raises(ValueError, match="nope"):
        prepare_text_side(df, col_text="nope")


def test_image_side(spark):
    df = spark.createDataFrame(
        [(30, "C", "http://h/c"), (10, "A", "http://h/a"), (20, "B", "b"), (40, "D", None)],
        "item_id long, item_name string, image_url string")
    manifest = spark.createDataFrame(
        [("0_a", "/p/0_a.jpg", True), ("1_b", "/p/1_b.jpg", False), ("2_c", "/p/2_c.jpg", None),
         ("9_z", "/p/9_z.jpg", True)], "path_idx string, file_path string, file_exists boolean")
    side = prepare_image_side(df, manifest, "db")
    assert side.columns == ["db_item_id", "db_item_name", "db_image_url", "db_file_path",
                            "db_item_name_clean"]
    assert rows(side) == [(10, "A", "http://h/a", "/p/0_a.jpg", "a")]


@pytest.mark.parametrize("n", [1, 2, 100, 101])
def test_row_index_and_batches(spark, n):
    df = spark.range(n).select((F.col("id") * 7 % 1009).alias("key"))
    indexed = row_index(df, ["key"]).withColumn("batch", batch_number(F.col("row_index"), 50))
    got = sorted((r["row_index"], r["key"], r["batch"]) for r in indexed.collect())
    keys = sorted(i * 7 % 1009 for i in range(n))
    assert got == [(i, k, i // 50) for i, k in enumerate(keys)]
    assert len({g[2] for g in got}) == -(-n // 50)


def test_row_index_spreads_a_value_with_many_rows(spark):
    df = spark.range(4000).select(F.lit("hot").alias("key"), F.col("id").alias("other"))
    indexed = row_index(df, ["key"]).collect()
    assert sorted(r["row_index"] for r in indexed) == list(range(4000))
    assert {r["other"] for r in indexed} == set(range(4000))
    tied = df.withColumn("_tie", F.xxhash64("key", "other")).repartitionByRange(4, "key", "_tie")
    assert tied.groupBy(F.spark_partition_id()).count().count() == 4


def test_first_and_last_rows(spark):
    df = spark.range(3000).select((F.lit(2999) - F.col("id")).alias("k"))
    for n in (5, 2000):     # merged in one task, and numbered in place
        assert [r[0] for r in rows(first_rows(df, ["k"], n))] == sorted(range(n), key=lambda x: repr((x,)))
        assert {r[0] for r in rows(last_rows(df, ["k"], n))} == set(range(3000 - n, 3000))
    assert first_rows(df, ["k"], 5000).count() == 3000


def test_categories(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "c string")
    assert [r[0] for r in categories(df, "c").collect()] == ["a", "b"]


def test_keep_first_and_duplicates(spark):
    df = spark.createDataFrame(
        [(1, "b", "n", 5), (1, "a", "z", 9), (1, "a", "n", 7), (2, None, "m", 1), (2, "a", "a", 1)],
        "item_id long, images string, item_name string, shop_id long")
    assert rows(extract.unique_items(df)) == [(1, "a", "n", 7), (2, None, "m", 1)]
    assert rows(duplicate_keys(df, ["item_id"])) == [(1, 3), (2, 2)]
    assert keep_first(df, ["item_id"], ["shop_id"]).columns == df.columns


# ---- warehouse ----------------------------------------------------------------


def test_latest_snapshot_keeps_all_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 7), (4, None)], "id long, v int")
    assert rows(latest_snapshot(df, "v")) == [(2, 7), (3, 7)]


DAY = date(2024, 3, 10)


def _orders(spark, data):
    return spark.createDataFrame(
        [(i, f"n{i}", s, "shop", lvl, DAY.replace(day=d), *flags) for i, s, lvl, d, flags in data],
        "item_id long, item_name string, shop_id long, shop_name string, "
        "level1_global_be_category string, grass_date date, is_bi_excluded int, is_net_order int, "
        "is_official_shop int")


def _map(spark, data):
    return spark.createDataFrame(
        data, "level1_global string, cluster string, ingestion_timestamp long")


def test_extract_keeps_items_without_images(spark):
    good = (0, 1, 1)
    orders = _orders(spark, [
        (1, 9, "food", 9, good), (1, 9, "food", 9, good),   # repeated
        (2, 9, "food", 9, good), (3, 9, "food", 8, good),   # another day
        (4, 9, "food", 9, (1, 1, 1)), (5, 9, "food", 9, (0, 0, 1)), (6, 9, "food", 9, (0, 1, 0)),
        (7, 9, "toys", 9, good), (8, 9, "old", 9, good), (9, 9, None, 9, good)])
    cat = _map(spark, [("food", "X", 2), ("food", "X", 2), ("toys", "Y", 2), ("old", "X", 1)])
    ext = spark.createDataFrame(
        [(1, DAY.replace(day=8), "a,b"), (1, DAY.replace(day=8), "a,b"),
         (2, DAY.replace(day=9), "late")], "item_id long, grass_date date, images string")
    got = extract.catalogue_extract(orders, cat, ext, DAY, ["X"])
    assert rows(got.select("item_id", "cluster", "images")) == [(1, "X", "a,b"), (2, "X", None)]
    both = extract.catalogue_extract(orders, cat, ext, DAY, ["X", "Y"], limit=2)
    assert {r["item_id"] for r in both.collect()} == {1, 2}


@pytest.mark.parametrize("images, first", [(None, None), ("", "u/"), ("a", "u/a"), ("a,b", "u/a")])
def test_first_image(spark, images, first):
    df = spark.createDataFrame([(1, images)], "item_id long, images string")
    want = [] if first is None else [(1, images, first)]
    assert rows(extract.with_image_url(df, "u/")) == want


def _facts(spark, data):
    names = ", ".join(f"level{i}_global_be_category string" for i in range(1, 6))
    return spark.createDataFrame(data, f"item_id long, grass_date date, {names}")


def test_coverage(spark):
    def fact(item, month, day, l1, l5="e"):
        return (item, date(2024, month, day), l1, "b", "c", "d", l5)

    as_of = date(2024, 3, 31)
    facts = _facts(spark, [
        fact(1, 3, 1, "food"),                       # exactly 30 days before: counted
        fact(1, 1, 15, "food"), fact(2, 2, 29, "food"),   # 31 days before
        fact(2, 2, 29, "food", "f"),
        fact(3, 1, 1, "food"),                       # exactly 90 days before
        fact(4, 3, 30, "toys"), fact(None, 3, 30, "toys"),
        fact(5, 1, 2, "late"),                       # nothing within 30 days
        fact(6, 3, 30, "unmapped"), fact(7, 12, 1, "food"),
    ][:-1] + [(7, date(2023, 12, 31), "food", "b", "c", "d", "e")])
    cat = _map(spark, [("food", "X", 1), ("toys", "Y", 1), ("late", "Y", 1), ("unmapped", "Z", 0)])
    got = {r["level1_global_be_category"]: r for r in
           coverage.coverage_stats(facts, cat, coverage.LEVELS_3, as_of).collect()}
    assert set(got) == {"food", "toys", "late"}
    counts = {k: tuple(r[f"total_items_{n}d"] for n in (30, 60, 90)) for k, r in got.items()}
    assert counts == {"food": (1, 2, 3), "toys": (1, 1, 1), "late": (0, 0, 1)}
    # the category without a cluster is part of the total
    assert got["food"]["pct_90d"] == pytest.approx(3 / 6)
    assert got["food"]["dif_60"] == 2.0 and got["food"]["dif_90"] == 3.0
    assert got["late"]["dif_60"] is None and got["late"]["dif_90"] is None

    grains = coverage.coverage_both_grains(facts, cat, as_of)
    for grain, levels in ((3, coverage.LEVELS_3), (5, coverage.LEVELS_5)):
        columns = ["cluster", *levels, "total_items_30d", "total_items_60d", "total_items_90d"]
        one = coverage.with_cluster(coverage.category_counts(facts, levels, as_of), cat)
        assert rows(grains.where(F.col("grain") == grain).select(columns)) == rows(one.select(columns))


def test_estimated_coverage(spark, fresh):
    as_of, path = date(2024, 3, 31), fresh("sketches")
    # 3,000 items, each on two days; those of category "few" only long ago, one category is null
    data = [(i, date(2024, 3 - d, 1 + i % 28), "many", "b", "c", "d", "e") for i in range(3000) for d in (0, 1)]
    data += [(i % 5, date(2024, 1, 5), "few", "b", "c", "d", "e") for i in range(20)]
    data += [(None, date(2024, 3, 30), "none", "b", "c", "d", "e"), (1, date(2024, 3, 30), None, "b", "c", "d", "e"),
             (1, date(2023, 3, 30), "old", "b", "c", "d", "e")]
    facts = _facts(spark, data)
    for month in (1, 2, 3):
        days = facts.where(F.month("grass_date") == month)
        coverage.daily_sketches(days, coverage.LEVELS_3).write.mode("append").parquet(path)
    daily = spark.read.parquet(path)
    got = {r[0]: tuple(r)[3:] for r in coverage.estimated_counts(daily, coverage.LEVELS_3, as_of).collect()}
    assert got["few"] == (0, 0, 5) and got["none"] == (0, 0, 0) and got[None] == (1, 1, 1) and "old" not in got
    assert got["many"][1] == pytest.approx(3000, rel=coverage.relative_error())
    both = coverage.estimates_beside_counts(facts, daily, coverage.LEVELS_3, as_of, coverage.relative_error()).collect()
    assert len(both) == 4 and all(all(tuple(r)[6:]) for r in both)
    wrong = coverage.estimates_beside_counts(facts.where("item_id < 1000"), daily, coverage.LEVELS_3, as_of, 0.065)
    assert not all(r["within_60d"] for r in wrong.collect())


def test_brands(spark):
    yesterday = DAY.replace(day=9)
    df = spark.createDataFrame(
        [("c", "A", "A", yesterday, 1), ("c", "A", "A", yesterday, 1), ("c", "B", "NoBrand", yesterday, 1),
         ("c", "C", None, yesterday, 1), ("c", "D", "D", DAY, 1), ("c", "E", "E", yesterday, 0)],
        "level1_global_be_category string, final_brand string, global_brand string, "
        "grass_date date, status int")
    assert rows(extract.brand_list(df, DAY)) == [("c", "A")]


# ---- export -------------------------------------------------------------------


def test_export_without_images_and_with_odd_names(spark, capsys):
    df = spark.createDataFrame(
        [(1, 2, 3, 7, "x", 0.5)],
        "q_item_id long, db_item_id long, db_shop_id long, db_quantity long, unique string, "
        "score_mean double")
    out = export_review(df, "http://s/", verbose=True)
    assert out.columns == ["q_item_id", "db_item_id", "db_quantity", "db_shop_id", "db_url",
                           "score_mean"]
    assert rows(out) == [(1, 2, 7, 3, "http://s/3/2", 0.5)]
    assert "Physical Plan" in capsys.readouterr().out


def test_export_formulas_replace_links(spark):
    df = spark.createDataFrame([(1, "a", 2, "b", 0.5)],
                               "q_item_id long, q_image_url string, db_item_id long, "
                               "db_image_url string, score double")
    assert rows(export_review(df, "")) == [(1, 2, '=IMAGE("a", 1)', '=IMAGE("b", 1)', 0.5)]


def test_csv_keeps_quotes_commas_and_lines(spark, fresh):
    df = spark.createDataFrame([(1, 'say "hi", ok'), (2, "two\nlines"), (3, None), (4, "é")],
                               "id long, t string")
    path = fresh()
    save_csv(df, path)
    assert rows(read_csv(spark, path, "id long, t string")) == rows(df)
    by_category = fresh()
    save_csv(df.withColumn("category", F.lit("a/b")), by_category, "category")
    assert spark.read.option("header", True).csv(by_category).columns == ["id", "t", "category"]


# ---- match --------------------------------------------------------------------


def test_match_by_text_end_to_end(spark):
    raw = "item_id long, item_name string, category string, price double"
    q = spark.createDataFrame(
        [(1, "Red SHOE!", "s", 1.0), (2, "blue hat", "s", 2.0), (3, "😀", "s", 3.0)], raw)
    db = spark.createDataFrame(
        [(7, "shoe red", "s", 4.0), (8, "Blue coat", "s", 5.0), (9, "red shoe", "t", 6.0)], raw)
    got = match(prepare_text_side(q, "q"), prepare_text_side(db, "db"), MatchConfig(top_k=1))
    assert got.columns == [
        "category", "q_item_id", "q_item_name", "q_category", "q_price", "q_item_name_clean",
        "db_item_id", "db_item_name", "db_category", "db_price", "db_item_name_clean",
        "score_text_embed", "rank"]
    picked = rows(got.select("q_item_id", "db_item_id", "db_price", "score_text_embed"))
    # the emoji leaves no words, so item 3 has no vector and no hits
    assert picked == [(1, 7, 4.0, 1.0), (2, 8, 5.0, 0.5)]


@pytest.mark.parametrize("approximate", [
    dict(method="cells", n_cells=4, nprobe=4),
    dict(method="cells", n_cells=4, nprobe=1),
    dict(method="cells"),
    dict(method="bounded", nprobe=4),
    dict(method="tree", n_cells=4, beam=2, nprobe=4),
    dict(method="tree"),
    dict(method="planes", vector_width=8, plane_tables=2, plane_bits=2),
    dict(method="planes", vector_width=8),
])
def test_match_by_approximate_methods(spark, fresh, approximate):
    data = random_rows(5, {"a": 30, "b": 9, "one": 1})
    q, db = (spark.createDataFrame(
        data, f"{m}_item_id long, {m}_category string, text_embed array<float>")
        for m in ("q", "db"))
    exact = match(q, db, MatchConfig(top_k=5))
    config = MatchConfig(top_k=5, index_path=fresh(), **approximate)
    got = match(q, db, config)
    assert got.columns == exact.columns
    assert got.count() == exact.count()      # no query comes back short
    if approximate.get("nprobe") == 4:
        assert rows(got) == rows(exact)
        assert rows(match(q, db, config)) == rows(exact)    # the index is reused
    found = evaluate.recall(got, exact, ["category", "q_item_id", "db_item_id"]).first()
    assert found["recall"] > 0.4


def test_config_is_checked():
    with pytest.raises(ValueError):
        MatchConfig(method="guess")
    with pytest.raises(ValueError, match="vector_width"):
        MatchConfig(method="planes")
    with pytest.raises(ValueError, match="target_recall"):
        MatchConfig(target_recall=0.0)
    with pytest.raises(ValueError):
        MatchConfig(match_by="sound")
    with pytest.raises(ValueError):
        MatchConfig(top_k=0)
    config = MatchConfig(match_by="image")
    assert (config.input_col, config.score_col) == ("file_path", "score_image_embed")
