"""One registered query per operator, over whole stand-in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinshelf.checks import standins as s
from twinshelf.config import MatchConfig
from twinshelf.functions import scores, text
from twinshelf.functions.vectors import dot, l2_normalize, to_float32
from twinshelf.operators import ann, cell_tree, codes, evaluate, rows
from twinshelf.operators.columns import replace_columns
from twinshelf.operators.encode import (
    embed, embed_once, grid_mean, histogram, reduce_dimensions, register_encoder, word_hash,
)
from twinshelf.operators.knn import knn_join, top_k, with_payload
from twinshelf.operators.nest import explode_hits, nest_hits
from twinshelf.plans import coverage, export, extract, ledger, match, prepare, rerank
from twinshelf.session import cut, scratch_path
from twinshelf.sources import images, tables
from twinshelf.sources import vectors as vector_tables
from twinshelf.streaming.database_stream import match_database_stream, read_state
from twinshelf.streaming.match_stream import arriving_rows, match_stream

LABEL = [("q_label", "db_label", "category")]
VECS = dict(q_vec="q_vec", db_vec="db_vec")
SHOP_URL = "https://shop.example/product/"
IMAGE_URL = "http://images.example/file/"


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    vectors = s.table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    q, db = (vectors.toDF(f"{m}_id", f"{m}_label", f"{m}_vec") for m in ("q", "db"))
    return q, db


def points(score: str) -> Column:
    """A rounded score as a whole number of 0.00001."""
    return F.rint(F.col(score) * 100000).cast("long")


# ---- nearest neighbours -------------------------------------------------------


def knn_exact_by_category(spark: SparkSession, d: str) -> DataFrame:
    q, db = sides(spark, d)
    return knn_join(q, db, k=s.K, by=LABEL, min_group_size=2, **VECS)


def knn_small_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The same result from many cells per category."""
    q, db = sides(spark, d)
    return knn_join(q, db, k=s.K, by=LABEL, min_group_size=2, block_rows=16, **VECS)


def knn_global(spark: SparkSession, d: str) -> DataFrame:
    q, db = sides(spark, d)
    return knn_join(q, db, k=s.K, **VECS)


def knn_self(spark: SparkSession, d: str) -> DataFrame:
    q, db = sides(spark, d)
    return knn_join(q, db, k=5, **VECS)


def knn_exclude_self(spark: SparkSession, d: str) -> DataFrame:
    q, db = sides(spark, d)
    return knn_join(q, db, k=5, by=LABEL, exclude_self=True, **VECS)


def knn_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of different lengths, compared by direction."""
    def stretched(df: DataFrame, side: str) -> DataFrame:
        factor = F.array_repeat((F.col(f"{side}_label") + 2).cast("double"), 64)
        longer = F.zip_with(f"{side}_vec", factor, lambda x, f: x * f)
        return df.withColumn(f"{side}_vec", l2_normalize(longer))

    q, db = sides(spark, d)
    return knn_join(stretched(q, "q"), stretched(db, "db"), k=5, **VECS)


def knn_payload(spark: SparkSession, d: str) -> DataFrame:
    part = s.table(spark, d, "part")
    hits = knn_exact_by_category(spark, d)
    return with_payload(hits, part, {"db_id": "p_partkey"}, ["p_name", "p_brand"])


def _as_text(column: str) -> Column:
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",").alias(column)


def knn_nested(spark: SparkSession, d: str) -> DataFrame:
    hits = knn_exact_by_category(spark, d).withColumn("points", points("score"))
    nested = nest_hits(hits, ["category", "q_id"], ["db_id", "points"])
    return nested.select("category", "q_id", _as_text("db_id"), _as_text("points"))


def exploded_hits(spark: SparkSession, d: str) -> DataFrame:
    hits = knn_exact_by_category(spark, d).withColumn("score_rank", F.col("rank"))
    nested = nest_hits(hits, ["category", "q_id"], ["db_id", "score", "score_rank"])
    return explode_hits(nested)


def _cells(spark: SparkSession, d: str) -> ann.CellIndex:
    db = s.vectors(spark, d, "db")
    return ann.build_cells(db, scratch_path(spark, "cells"), vec="db_vec", n_cells=16, max_iter=5)


def ivf_cells(spark: SparkSession, d: str) -> DataFrame:
    return ann.index_info(_cells(spark, d), "db_vec")


def ivf_totals(spark: SparkSession, d: str) -> DataFrame:
    """What does not depend on where the centroids came to lie."""
    return ann.index_info(_cells(spark, d), "db_vec").agg(
        F.sum("n_rows").alias("n_rows"), F.max("dim").alias("dim"),
        F.sum("n_bytes").alias("n_bytes"),
    )


def ivf_reused(spark: SparkSession, d: str) -> DataFrame:
    """An index built on fewer rows is completed, and then left as it is."""
    db, path = s.vectors(spark, d, "db"), scratch_path(spark, "cells")
    args = dict(vec="db_vec", n_cells=16, max_iter=5)
    ann.build_cells(db.where("db_label < 4"), path, **args)
    ann.build_cells(db, path, **args)
    index = ann.build_cells(db, path, **args)
    return index.rows().agg(F.count(F.lit(1)).alias("n_rows"))


def knn_ivf(spark: SparkSession, d: str) -> DataFrame:
    """Eight cells first, then all whose bound reaches the k-th score: nothing is missed."""
    q = s.vectors(spark, d, "q")
    return ann.knn_cells(q, _cells(spark, d), k=s.K, nprobe=8, exact=True, **VECS)


def knn_ivf_bounded(spark: SparkSession, d: str) -> DataFrame:
    """The same inside categories, one cell first; the index chooses its number of cells."""
    q, db = sides(spark, d)
    index = ann.build_cells(db, scratch_path(spark, "cells"), vec="db_vec")
    return ann.knn_cells(q, index, k=s.K, nprobe=1, exact=True, by=LABEL, min_group_size=2, **VECS)


def knn_ivf_tuned(spark: SparkSession, d: str) -> DataFrame:
    """Whether a number of probes chosen from sampled queries finds nine of ten hits of all queries."""
    found = ann.knn_cells(s.vectors(spark, d, "q"), _cells(spark, d), k=s.K, target_recall=0.95, **VECS)
    recall = evaluate.recall(found, knn_global(spark, d), ["q_id", "db_id"])
    return recall.select("n_exact", (F.col("recall") >= 0.9).alias("reached"))


def knn_ivf_all_cells(spark: SparkSession, d: str) -> DataFrame:
    """Probing every cell is exact."""
    q = s.vectors(spark, d, "q")
    index = _cells(spark, d)
    return ann.knn_cells(q, index, k=s.K, nprobe=16, by=LABEL, min_group_size=2, **VECS)


def knn_ivf_recall(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.recall(knn_ivf(spark, d), knn_global(spark, d), ["q_id", "db_id"])


def _codes(spark: SparkSession, d: str) -> codes.CodedIndex:
    db = s.table(spark, d, "embeddings").selectExpr("vec_id AS db_id", "label AS db_label", "embedding AS db_vec")
    index = ann.build_cells(db, scratch_path(spark, "cells"), vec="db_vec", n_cells=16, max_iter=5)
    return codes.build_codes(index, scratch_path(spark, "codes"), vec="db_vec", parts=16)


def code_totals(spark: SparkSession, d: str) -> DataFrame:
    """A quarter of a byte for each dimension."""
    return codes.code_info(_codes(spark, d)).agg(
        F.sum("n_rows").alias("n_rows"), F.max("parts").alias("parts"), F.sum("n_bytes").alias("n_bytes"),
    )


def knn_codes_by_category(spark: SparkSession, d: str) -> DataFrame:
    """Exact where all cells are probed and whole categories are scored again."""
    q, _ = sides(spark, d)
    whole = spark.read.parquet(f"{d}/embeddings.parquet").count()
    return codes.knn_codes(q, _codes(spark, d), k=s.K, nprobe=16, rerank=whole, by=LABEL, min_group_size=2, **VECS)


def knn_codes_reached(spark: SparkSession, d: str) -> DataFrame:
    """Whether as many rows by codes as sampled queries need hold nine of ten hits of all queries."""
    found = codes.knn_codes(s.vectors(spark, d, "q"), _codes(spark, d), k=s.K, **VECS)
    recall = evaluate.recall(found, knn_global(spark, d), ["q_id", "db_id"])
    return recall.select("n_exact", (F.col("recall") >= 0.9).alias("reached"))


def _tree(spark: SparkSession, db: DataFrame) -> cell_tree.CellTree:
    return cell_tree.build_tree(db, scratch_path(spark, "tree"), vec="db_vec", n_cells=64)


def knn_tree_all_cells(spark: SparkSession, d: str) -> DataFrame:
    """A beam of all top cells and all their leaves is exact."""
    q, db = sides(spark, d)
    return cell_tree.knn_tree(q, _tree(spark, db), k=s.K, beam=8, nprobe=64, by=LABEL, min_group_size=2, **VECS)


def knn_tree_tuned(spark: SparkSession, d: str) -> DataFrame:
    """Whether a beam chosen from sampled queries finds nine of ten hits of all queries."""
    q = s.vectors(spark, d, "q")
    found = cell_tree.knn_tree(q, _tree(spark, s.vectors(spark, d, "db")), k=s.K, **VECS)
    recall = evaluate.recall(found, knn_global(spark, d), ["q_id", "db_id"])
    return recall.select("n_exact", (F.col("recall") >= 0.9).alias("reached"))


def tree_facts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a tree, and rows that are not in the nearest leaf of their nearest top cell.

    Distances are computed by SQL functions here.
    """
    tree = _tree(spark, s.vectors(spark, d, "db"))
    far = F.aggregate(F.zip_with("x", "c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, y: t + y)
    tops = F.explode(F.array(*(F.struct(F.lit(i).alias("top"), F.lit(c.tolist()).alias("c")) for i, c in enumerate(tree.tops()))))
    rows = tree.rows().select("db_id", "cell", F.col("db_vec").cast("array<double>").alias("x"))
    by_top = rows.withColumn("t", tops).select("*", "t.top", "t.c").withColumn("far", far)
    top = by_top.groupBy("db_id").agg(
        F.min(F.struct("far", "top"))["top"].alias("_top"), F.first("cell").alias("cell"), F.first("x").alias("x")
    )
    leaves = tree.leaves().withColumnRenamed("_centroid", "c")
    leaf = top.join(leaves, "_top").withColumn("far", far)
    nearest = leaf.groupBy("db_id").agg(F.min("far").alias("least"), F.min(F.when(F.col("_cell") == F.col("cell"), F.col("far"))).alias("own"))
    near = F.coalesce(F.col("own") <= F.col("least") + 1e-9, F.lit(False))
    return nearest.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~near).alias("misplaced"))


def knn_lsh(spark: SparkSession, d: str) -> DataFrame:
    q, db = sides(spark, d)
    return ann.knn_planes(q, db, k=s.K, width=64, tables=6, bits=8, probes=60, by=LABEL, **VECS)


def knn_lsh_global(spark: SparkSession, d: str) -> DataFrame:
    """Without categories."""
    q, db = s.vectors(spark, d, "q"), s.vectors(spark, d, "db")
    return ann.knn_planes(q, db, k=s.K, width=64, tables=6, bits=10, probes=130, **VECS)


def knn_lsh_recall(spark: SparkSession, d: str) -> DataFrame:
    found, exact = knn_lsh(spark, d), knn_exact_by_category(spark, d)
    return evaluate.recall(found, exact, ["category", "q_id", "db_id"])


# ---- fusion -------------------------------------------------------------------


def _half_match(spark: SparkSession, d: str, half: str) -> DataFrame:
    q, db = s.half_vectors(spark, d, "q", half), s.half_vectors(spark, d, "db", half)
    return match.match(q, db, MatchConfig(match_by=half))


def match_by_text(spark: SparkSession, d: str) -> DataFrame:
    q, db = (s.named_vectors(spark, d, side, "text") for side in ("q", "db"))
    return match.match(q, db, MatchConfig())


def match_by_cells(spark: SparkSession, d: str) -> DataFrame:
    """The same through a stored index, all of whose cells are probed."""
    q, db = (s.named_vectors(spark, d, side, "text") for side in ("q", "db"))
    config = MatchConfig(
        method="cells", n_cells=8, nprobe=8, index_path=scratch_path(spark, "index")
    )
    return match.match(q, db, config)


def rerank_fusion(spark: SparkSession, d: str) -> DataFrame:
    return rerank.rerank(_half_match(spark, d, "text"), _half_match(spark, d, "image"))


def _one_kind(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Category 0 has no text matches and category 1 no image matches: they are
    filed under names of their own."""

    def renamed(hits: DataFrame, label: str, name: str) -> DataFrame:
        category = F.col("category")
        return hits.withColumn("category", F.when(category == label, name).otherwise(category))

    return (renamed(_half_match(spark, d, "text"), "0", "text only"),
            renamed(_half_match(spark, d, "image"), "1", "image only"))


def rerank_one_modality(spark: SparkSession, d: str) -> DataFrame:
    return rerank.rerank(*_one_kind(spark, d))


def rerank_written(spark: SparkSession, d: str) -> DataFrame:
    """Matches and fusion through their result tables, one partition per category."""
    text_out, image_out, out = (scratch_path(spark, n) for n in ("text", "image", "fused"))
    tables.write_by_category(_half_match(spark, d, "text"), text_out)
    tables.write_by_category(_half_match(spark, d, "image"), image_out)
    rerank.run_rerank(spark, text_out, image_out, out)
    return rerank.in_rank_order(tables.read_by_category(spark, out))


def category_union(spark: SparkSession, d: str) -> DataFrame:
    return rerank.all_categories(*_one_kind(spark, d))


def encoder_hits(spark: SparkSession, d: str) -> DataFrame:
    a, b = _encoders(spark, d)
    return evaluate.side_by_side(a, b, ["category", "q_item_id", "db_item_id"], "a", "b")


def encoder_overlap(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.overlap(encoder_hits(spark, d), ["category", "q_item_id"], "a", "b")


def _encoders(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return (
        _half_match(spark, d, "text").withColumnRenamed("score_text_embed", "score"),
        _half_match(spark, d, "image").withColumnRenamed("score_image_embed", "score"),
    )


# ---- preparation --------------------------------------------------------------


def category_list(spark: SparkSession, d: str) -> DataFrame:
    column = tables.read_column(spark, f"{d}/part.parquet", "p_type")
    return rows.categories(column, "p_type")


def category_guard(spark: SparkSession, d: str) -> DataFrame:
    """Nations with at least two customers and two suppliers."""
    customer = spark.read.parquet(f"{d}/customer.parquet")
    supplier = s.table(spark, d, "supplier")
    return rows.group_sizes(customer, supplier, ["c_nationkey"], ["s_nationkey"], ["category"], 2)


def one_category(spark: SparkSession, d: str) -> DataFrame:
    path = f"{d}/part.parquet"
    return tables.read_group(spark, path, "p_type", "ECONOMY").select("p_partkey", "p_name")


def clean_text(spark: SparkSession, d: str) -> DataFrame:
    docs = s.documents(spark, d).transform(prepare.add_clean_text, "text")
    return docs.select("doc_id", "text_clean")


def truncate_tokens(spark: SparkSession, d: str) -> DataFrame:
    cut = text.first_words(F.col("text"), 50).alias("first_words")
    return s.table(spark, d, "documents").select("doc_id", cut)


def prepare_side(spark: SparkSession, d: str) -> DataFrame:
    """Items without an image list are dropped by the key column."""
    return prepare.prepare_text_side(s.catalogue(spark, d), "q", ["images"])


def row_index(spark: SparkSession, d: str) -> DataFrame:
    docs = s.table(spark, d, "documents").select("doc_id", "lang")
    return rows.row_index(docs, ["lang", "doc_id"], "id")


def asset_manifest_join(spark: SparkSession, d: str) -> DataFrame:
    """Files exist for pages served over https; other keys are known or missing."""
    pages = s.table(spark, d, "pages").select("page_id", F.col("url").alias("image_url"))
    pages = pages.withColumn("item_name", F.col("image_url"))
    numbered = rows.row_index(pages, ["page_id"], "n")
    key = F.concat(F.col("n").cast("string"), F.lit("_"), text.last_url_segment(F.col("image_url")))
    manifest = numbered.select(
        key.alias("path_idx"),
        F.concat(F.lit("/img/"), key, F.lit(".jpg")).alias("file_path"),
        F.when(~F.col("image_url").contains("example.net"), F.col("image_url").startswith("https"))
        .alias("file_exists"),
    )
    return prepare.prepare_image_side(pages, manifest, "q", order=["page_id"])


def _picture_folder(spark: SparkSession, d: str) -> str:
    folder = scratch_path(spark, "pictures")
    images.write_files(s.pictures(spark, d), folder, "path", "content")
    return folder


def image_scan(spark: SparkSession, d: str) -> DataFrame:
    folder = _picture_folder(spark, d)
    manifest = images.in_file_order(images.image_manifest(spark, folder))
    short = F.substring_index("file_path", "/", -2)
    return manifest.select(
        "path_idx", short.alias("file_path"), "file_exists",
        text.file_number(F.col("file_path")).alias("number"),
    )


def image_embed(spark: SparkSession, d: str) -> DataFrame:
    pictures = images.read_images(spark, _picture_folder(spark, d))
    vectors = embed(pictures, "image", "image_embed", histogram(bins=8, size=8))
    number = text.file_number(F.col("file_path")).alias("vec_id")
    return vectors.select(number, F.posexplode("image_embed").alias("dim", "weight")).select(
        "vec_id", "dim", scores.round_half_even(F.col("weight").cast("double"), 5).alias("weight")
    )


def match_by_image(spark: SparkSession, d: str) -> DataFrame:
    """Pictures scanned, prepared, embedded and matched inside their label."""
    folder = _picture_folder(spark, d)
    # one listing for both sides
    listed = cut(images.image_manifest(spark, folder).select(
        text.file_number(F.col("file_path")).alias("item_id"),
        F.element_at(F.split("file_path", "/"), -2).alias("category"),
        "file_path",
    ).hint("rebalance"))
    q, db = (listed.withColumnsRenamed({c: f"{m}_{c}" for c in listed.columns}) for m in ("q", "db"))
    register_encoder("pixels", lambda: grid_mean(grid=8, size=8))
    config = MatchConfig(match_by="image", encoder="pixels", top_k=5)
    hits = match.match(q, db, config, images=images.read_images(spark, folder))
    return hits.drop("q_file_path", "db_file_path")


def first_image_url(spark: SparkSession, d: str) -> DataFrame:
    """Items keyed by shop, so that keys repeat; one is kept."""
    items = s.catalogue(spark, d).withColumns(
        {"item_id": F.col("shop_id").cast("long"), "shop_id": F.col("item_id")}
    )
    linked = extract.with_image_url(items, IMAGE_URL)
    return extract.unique_items(linked).orderBy("item_id", "images")


def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return rows.duplicate_keys(s.table(spark, d, "part"), ["p_name"])


def distinct_columns(spark: SparkSession, d: str) -> DataFrame:
    """Deduplicated on all chosen columns, then numbered."""
    chosen = s.table(spark, d, "part").select("p_type", "p_brand", "p_name").dropDuplicates()
    return rows.row_index(chosen, ["p_type", "p_brand", "p_name"], "id")


def category_leaf(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat_ws("__", "p_type", "p_brand", F.replace("p_name", F.lit(" "), F.lit("/")))
    leaf = text.category_leaf(path)
    return s.table(spark, d, "part").select(
        "p_partkey", leaf.alias("leaf"), text.without_slashes(leaf).alias("file_name")
    )


def path_rewrite(spark: SparkSession, d: str) -> DataFrame:
    pages = s.table(spark, d, "pages").select("page_id", text.rewrite_path(
        F.col("url"), "example.", "mirror.").alias("file_path"),
        text.last_url_segment(F.col("url")).alias("segment"))
    return replace_columns(pages, {"segment": F.upper("segment")})


# ---- export -------------------------------------------------------------------


def _review_table(spark: SparkSession, d: str) -> DataFrame:
    fused = rerank_fusion(spark, d).drop("category", "rank")
    shop = F.col("q_item_id") + 7
    return fused.withColumns({
        "q_shop_id": shop,
        "q_image_url": F.concat(F.lit(IMAGE_URL), F.col("q_item_id").cast("string")),
        "db_image_url": F.concat(F.lit(IMAGE_URL), F.col("db_item_id").cast("string")),
    })


def export_columns(spark: SparkSession, d: str) -> DataFrame:
    return export.export_review(_review_table(spark, d), SHOP_URL)


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    review = export_columns(spark, d)
    path = scratch_path(spark, "csv")
    export.save_csv(review, path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in review.schema)
    return tables.read_csv(spark, path, schema)


# ---- warehouse ----------------------------------------------------------------


def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Events of the last day on record."""
    events = s.table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return rows.latest_snapshot(events, "day").select("event_id", "event_type", "user_id", "day")


def catalogue_extract(spark: SparkSession, d: str) -> DataFrame:
    return extract.catalogue_extract(
        s.order_snapshots(spark, d), s.map_snapshots(spark, d), s.item_ext(spark, d),
        s.EXTRACT_AS_OF, ["FMCG"],
    )


def sample_limit(spark: SparkSession, d: str) -> DataFrame:
    """The extract cut to a sample larger than one task merges."""
    everything = extract.catalogue_extract(
        s.order_snapshots(spark, d), s.map_snapshots(spark, d), s.item_ext(spark, d),
        s.EXTRACT_AS_OF, ["FMCG", "ELHA"],
    )
    return rows.first_rows(everything, ["item_id", "shop_id", "cluster"], 1_500)


def extract_materialised(spark: SparkSession, d: str) -> DataFrame:
    """Brands per cluster through SQL over a frame; a second extract changes nothing."""
    path = scratch_path(spark, "brands")
    mapped = tables.sql_over(
        spark,
        "SELECT b.*, m.cluster FROM {brands} b JOIN {cat} m "
        "ON m.level1_global = b.level1_global_be_category",
        brands=s.brands(spark, d), cat=extract.category_map(s.map_snapshots(spark, d)),
    )
    tables.write_if_absent(tables.extract_clusters(mapped, ["FMCG"]), path)
    stored = tables.write_if_absent(tables.extract_clusters(mapped, ["ELHA"]), path)
    return stored.groupBy("cluster", "final_brand").agg(F.count(F.lit(1)).alias("n_items"))


def coverage_stats_l3(spark: SparkSession, d: str) -> DataFrame:
    return coverage.coverage_stats(
        s.orders(spark, d), s.map_snapshots(spark, d), coverage.LEVELS_3, s.AS_OF
    )


def coverage_stats_l5(spark: SparkSession, d: str) -> DataFrame:
    return coverage.coverage_stats(
        s.orders(spark, d), s.map_snapshots(spark, d), coverage.LEVELS_5, s.AS_OF
    )


def coverage_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    return coverage.coverage_both_grains(s.orders(spark, d), s.map_snapshots(spark, d), s.AS_OF)


def coverage_estimated(spark: SparkSession, d: str) -> DataFrame:
    """Counts, and whether those from stored daily sketches are within their bound."""
    orders, path = s.orders(spark, d), scratch_path(spark, "sketches")
    days = coverage.daily_sketches(orders, coverage.LEVELS_3)
    # the table is written in two goes, as days arrive
    for part in (F.col("grass_date") < "2001-10-01", F.col("grass_date") >= "2001-10-01"):
        days.where(part).write.mode("append").parquet(path)
    return coverage.estimates_beside_counts(
        orders, spark.read.parquet(path), coverage.LEVELS_3, s.AS_OF, coverage.relative_error()
    )


def brand_list(spark: SparkSession, d: str) -> DataFrame:
    return extract.brand_list(s.brands(spark, d), s.AS_OF)


def ratio_to_min_report(spark: SparkSession, d: str) -> DataFrame:
    """Event types as engines: their mean and largest value as two durations."""
    events = s.table(spark, d, "events")
    total = F.sum(F.rint(F.col("value") * 100).cast("long"))
    name = F.col("event_type").alias("name")
    index = events.groupBy(name).agg(
        (total / F.count(F.lit(1)) / 100).alias("time_index"),
        F.max("value").alias("time_query"),
        F.count(F.lit(1)).cast("string").alias("data_size"),
    )
    # a report that lacks one of the durations
    other = events.groupBy(F.concat(F.lit("no index, "), F.col("event_type")).alias("name")).agg(
        F.min("value").alias("time_query"), F.count(F.lit(1)).cast("string").alias("data_size")
    )
    path = scratch_path(spark, "report")
    tables.write_csv(evaluate.timing_report([index, other]), path)
    stored = tables.read_csv(
        spark, path, "name string, time_index double, time_query double, data_size string"
    )
    return evaluate.ratio_to_min(stored, ["time_index", "time_query"])


# ---- embedding ----------------------------------------------------------------

HASH_DIM = 64


def _documents(spark: SparkSession, d: str) -> DataFrame:
    clean = s.documents(spark, d).transform(prepare.add_clean_text, "text")
    return embed(clean, "text_clean", "vec", word_hash(HASH_DIM)).drop("text", "text_clean")


def text_hash_vectors(spark: SparkSession, d: str) -> DataFrame:
    entries = _documents(spark, d).select("doc_id", F.posexplode("vec").alias("dim", "weight"))
    weight = scores.round_half_even(F.col("weight").cast("double"), 5)
    return entries.where("weight <> 0").select("doc_id", "dim", weight.alias("weight"))


def text_knn(spark: SparkSession, d: str) -> DataFrame:
    # one set of vectors for both sides
    docs = cut(_documents(spark, d))
    q, db = (docs.toDF(f"{m}_id", f"{m}_lang", f"{m}_vec") for m in ("q", "db"))
    return knn_join(q, db, k=s.K, by=[("q_lang", "db_lang", "category")], min_group_size=2, **VECS)


def match_names(spark: SparkSession, d: str) -> DataFrame:
    """Item names cleaned, embedded by character grams and matched per category."""
    items = s.catalogue(spark, d).select(
        "item_id", "item_name", F.col("level1_global_be_category").alias("category")
    )
    config = MatchConfig(encoder="gram_hash")
    return match.match(*(prepare.prepare_text_side(items, m) for m in ("q", "db")), config)


def pca_knn(spark: SparkSession, d: str) -> DataFrame:
    reduced = reduce_dimensions(s.vectors(spark, d, "q"), "q_vec", 16)
    db = reduced.toDF("db_id", "db_label", "db_vec")
    return knn_join(reduced, db, k=s.K, by=LABEL, **VECS)


def pca_rotation(spark: SparkSession, d: str) -> DataFrame:
    """All components are a rotation, which leaves every score as it was."""
    rotated = reduce_dimensions(s.vectors(spark, d, "q"), "q_vec", 64, double=True)
    db = rotated.toDF("db_id", "db_label", "db_vec")
    return knn_join(rotated, db, k=s.K, by=LABEL, min_group_size=2, **VECS)


def ivf_facts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the index, rows not in their nearest cell, and hits of a probe that are missing.

    Distances to the centroids are computed by SQL functions here; a query's hits must be the
    best rows of the cells that it probes.
    """
    index = _cells(spark, d)
    centroids = F.array(*(F.lit(c.tolist()) for c in index.centroids()))
    squares = lambda x, c: F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, y: t + y)
    distances = F.transform(centroids, lambda c, i: F.struct(squares(F.col("x"), c).alias("d"), i.alias("cell")))
    queries = s.vectors(spark, d, "q").withColumn("x", F.col("q_vec").cast("array<double>"))
    near = queries.select("q_id", "q_vec", F.slice(F.sort_array(distances), 1, 8).alias("near"))
    placed = index.rows().select(F.col("db_id").alias("q_id"), "cell").join(near, "q_id")
    probes = near.select("q_id", "q_vec", F.explode("near.cell").alias("probe"))
    by_cell = knn_join(probes, index.rows(), k=s.K, by=[("probe", "cell", "cell")], **VECS).drop("rank", "cell")
    best = top_k(by_cell, ["q_id"], s.K, "score", "db_id")
    found = ann.knn_cells(s.vectors(spark, d, "q"), index, k=s.K, nprobe=8, **VECS)
    lost = best.join(found, ["q_id", "db_id", "score", "rank"], "left_anti")
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    facts = index.rows().select(one.alias("n_rows"), none.alias("misplaced"), none.alias("lost"))
    facts = facts.union(placed.where(F.col("near")[0]["cell"] != F.col("cell")).select(none, one, none))
    facts = facts.union(lost.select(none, none, one))
    return facts.agg(*(F.sum(c).alias(c) for c in ("n_rows", "misplaced", "lost")))


def embed_once_documents(spark: SparkSession, d: str) -> DataFrame:
    """Other texts and another encoder first, then rows twice over, then the documents."""
    clean = s.documents(spark, d).transform(prepare.add_clean_text, "text").drop("text")
    path = scratch_path(spark, "vectors")
    args = dict(key="doc_id", input_col="text_clean", out_col="vec")
    changed = clean.withColumn("text_clean", F.concat("text_clean", F.lit(" changed")))
    embed_once(changed, path, encoder=word_hash(HASH_DIM), **args)
    embed_once(clean, path, encoder=word_hash(8), **args)
    english = clean.where("lang = 'en'")
    embed_once(english.union(english), path, encoder=word_hash(HASH_DIM), **args)
    vectors = embed_once(clean, path, encoder=word_hash(HASH_DIM), **args)
    entries = vectors.select("doc_id", F.posexplode("vec").alias("dim", "weight")).where("weight <> 0")
    weight = scores.round_half_even(F.col("weight").cast("double"), 5)
    return entries.select("doc_id", "dim", weight.alias("weight"))


# ---- tables, batches, resume --------------------------------------------------


def match_resume(spark: SparkSession, d: str) -> DataFrame:
    """A run over some categories, one over all, which skips those, and one that finds nothing to do."""
    return _resumed(spark, d, "category")


def match_resume_queries(spark: SparkSession, d: str) -> DataFrame:
    """The same by query row: rows that were matched, with or without hits, are not matched again."""
    return _resumed(spark, d, "query")


def _resumed(spark: SparkSession, d: str, resume: str) -> DataFrame:
    config = MatchConfig(match_by="text")
    out, paths = scratch_path(spark, "result"), {}
    for side in ("q", "db"):
        paths[side] = scratch_path(spark, side)
        s.odd_vectors(spark, d, side).write.parquet(paths[side])
    some = scratch_path(spark, "some")
    spark.read.parquet(paths["q"]).where("q_category < '1.5'").write.parquet(some)
    for path in (some, paths["q"], paths["q"]):
        match.run_match(spark, path, paths["db"], out, config, resume=resume)
    read = ledger.read_matched if resume == "query" else tables.read_by_category
    return read(spark, out).select("category", "q_item_id", "db_item_id", "score_text_embed", "rank")


def batch_assign(spark: SparkSession, d: str) -> DataFrame:
    indexed = rows.row_index(s.table(spark, d, "embeddings").select("vec_id"), ["vec_id"], "id")
    return indexed.withColumn("batch", rows.batch_number(F.col("id"), 50))


def _elements(df: DataFrame, *ids: str) -> DataFrame:
    """One row per vector element."""
    exploded = df.select(*ids, F.posexplode("embedding").alias("dim", "value"))
    return exploded.withColumn("value", F.col("value").cast("double"))


def shard_concat(spark: SparkSession, d: str) -> DataFrame:
    """Vectors written as numbered shards and read as one table."""
    path = scratch_path(spark, "shards")
    indexed = rows.row_index(s.table(spark, d, "embeddings").select("vec_id", "embedding"), ["vec_id"], "id")
    batch = rows.batch_number(F.col("id"), 40)
    name = F.concat(F.lit("result_"), batch.cast("string")).alias("part")
    indexed.select("vec_id", "embedding", name).write.partitionBy("part").parquet(path)
    return _elements(tables.read_shards(spark, path, part=1, in_folder=True), "vec_id", "shard")


def overwrite_target(spark: SparkSession, d: str) -> DataFrame:
    """A target filled, dropped, and filled again with vectors of one length."""
    path = scratch_path(spark, "target")
    tables.recreate(s.table(spark, d, "part").select("p_partkey"), path)
    vector_tables.write_vectors(s.table(spark, d, "embeddings"), path, "vec_id", "embedding")
    stored = vector_tables.read_vectors(spark, path, "embedding", 64)
    return _elements(stored.withColumn("embedding", to_float32(F.col("embedding"))), "vec_id")


def stream_match(spark: SparkSession, d: str) -> DataFrame:
    """Query vectors read as a stream, matched per micro-batch."""
    schema = T.StructType.fromDDL("vec_id long, embedding array<float>, label int")
    arriving = arriving_rows(spark, f"{d}/embeddings.parquet", schema).toDF("q_id", "q_vec", "q_label")
    # prepared once, not by every micro-batch
    db = cut(s.vectors(spark, d, "db"))
    out = scratch_path(spark, "stream")

    def batch(new: DataFrame) -> DataFrame:
        return knn_join(new, db, k=s.K, by=LABEL, **VECS)

    match_stream(arriving, batch, out, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


def stream_match_db(spark: SparkSession, d: str) -> DataFrame:
    """Stored queries, and database vectors that arrive in several batches."""
    folder, state = scratch_path(spark, "arrivals"), scratch_path(spark, "state")
    db = s.vectors(spark, d, "db")
    db.repartition(6, "db_id").write.parquet(folder)
    q = cut(s.vectors(spark, d, "q"))
    arriving = spark.readStream.schema(db.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    match_database_stream(
        arriving, lambda new: knn_join(q, new, k=s.K, by=LABEL, **VECS), state, scratch_path(spark, "progress"),
        k=s.K, query=["category", "q_id"],
    ).awaitTermination()
    return read_state(spark, state).select("category", "q_id", "db_id", "score", "rank")


def peek_head(spark: SparkSession, d: str) -> DataFrame:
    return rows.first_rows(s.table(spark, d, "embeddings").select("vec_id", "label"), ["vec_id"], 5)


def peek_tail(spark: SparkSession, d: str) -> DataFrame:
    return rows.last_rows(s.table(spark, d, "embeddings").select("vec_id", "label"), ["vec_id"], 5)


def format_score(spark: SparkSession, d: str) -> DataFrame:
    shown = scores.display_score(F.col("value") * 100)
    return s.table(spark, d, "events").select("event_id", shown.alias("shown"))


def round_scores(spark: SparkSession, d: str) -> DataFrame:
    """Values on both sides of 1, at six, five and one decimals."""
    value = F.col("value") / 37
    return s.table(spark, d, "events").select(
        "event_id",
        scores.round_half_even(value, 6).alias("six"),
        scores.round_score(value).alias("score"),
    )


def stage_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows before and after preparation, counted while the result is written."""
    base, cleaned = Observation("base"), Observation("cleaned")
    side = prepare.prepare_text_side(
        s.catalogue(spark, d), "q", ["images"], base=base, cleaned=cleaned
    )
    path = scratch_path(spark, "side")
    side.write.parquet(path)
    written = tables.write_if_any(spark.read.parquet(path), scratch_path(spark, "again"))
    counts = [(name, seen.get["n_rows"]) for name, seen in (("base", base), ("cleaned", cleaned))]
    return spark.createDataFrame(counts, "stage string, n_rows long").withColumn(
        "written", F.lit(written)
    )


QUERIES = [
    knn_exact_by_category, knn_small_blocks, knn_global, knn_self, knn_exclude_self, knn_cosine,
    knn_payload, knn_nested, exploded_hits, ivf_cells, ivf_totals, ivf_reused, knn_ivf,
    code_totals, knn_codes_by_category, knn_codes_reached, knn_tree_all_cells, knn_tree_tuned, tree_facts,
    knn_ivf_all_cells, knn_ivf_bounded, knn_ivf_recall, knn_ivf_tuned, knn_lsh, knn_lsh_global,
    knn_lsh_recall, match_by_text, match_by_cells, rerank_fusion,
    rerank_one_modality, rerank_written, category_union, encoder_hits, encoder_overlap,
    category_list, category_guard, one_category, clean_text, truncate_tokens, prepare_side,
    row_index, asset_manifest_join, image_scan, image_embed, match_by_image, first_image_url,
    duplicate_keys, distinct_columns, category_leaf, path_rewrite, export_columns,
    csv_round_trip, latest_snapshot, catalogue_extract, sample_limit, extract_materialised,
    coverage_estimated, coverage_stats_l3, coverage_stats_l5, coverage_grouping_sets, brand_list,
    ratio_to_min_report, text_hash_vectors, text_knn, match_names, pca_knn, pca_rotation, ivf_facts,
    embed_once_documents, match_resume, match_resume_queries, batch_assign, shard_concat,
    overwrite_target, stream_match, stream_match_db, peek_head, peek_tail, format_score, round_scores,
    stage_counts,
]
