"""The given tables seen as catalogue, order, snapshot and vector tables.

There is no product table among them, so columns are renamed and derived.  Every
row of a table is used; nothing is cut to make a check cheaper.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.checks.oracles import ODD_CATEGORIES
from twinshelf.functions.vectors import l2_normalize
from twinshelf.sources.tables import read_spread

# Dates of the stand-in warehouse.  Sales dates are those of the line items;
# catalogue snapshots are yearly, so that one snapshot day holds many rows.
AS_OF = date(2001, 11, 4)
EXTRACT_AS_OF = date(2001, 1, 2)
K = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_spread(spark, f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")


def vectors(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """``<side>_id``, ``<side>_label``, ``<side>_vec``; every vector is on both sides."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias(f"{side}_id"),
        F.col("label").alias(f"{side}_label"),
        F.col("embedding").alias(f"{side}_vec"),
    )


def half_vectors(spark: SparkSession, sf_dir: str, side: str, half: str) -> DataFrame:
    """A match input whose vector is one half of the embedding, unit length again.

    Elements 1–32 stand for text, 33–64 for an image.
    """
    return named_vectors(spark, sf_dir, side, half, {"text": 1, "image": 33}[half], 32)


def named_vectors(
    spark: SparkSession, sf_dir: str, side: str, kind: str, start: int = 1, length: int = 64,
) -> DataFrame:
    """A match input whose vector of ``kind`` is a part of the embedding, unit length again."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias(f"{side}_item_id"),
        F.concat(F.lit("item "), F.col("vec_id").cast("string")).alias(f"{side}_item_name"),
        F.col("label").cast("string").alias(f"{side}_category"),
        l2_normalize(F.slice("embedding", start, length)).alias(f"{kind}_embed"),
    )


def odd_vectors(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """A match input with whole vectors, in categories that are hard to keep in folder names."""
    names = F.array(*(F.lit(c) for c in ODD_CATEGORIES))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias(f"{side}_item_id"),
        F.concat(F.lit("item "), F.col("vec_id").cast("string")).alias(f"{side}_item_name"),
        F.element_at(names, (F.col("label") % 10 + 1).cast("int")).alias(f"{side}_category"),
        F.col("embedding").alias("text_embed"),
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a comma-separated image list made of their name."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_size").alias("shop_id"),
        F.col("p_type").alias("level1_global_be_category"),
        F.when(F.col("p_brand") != "Brand#3", F.replace("p_name", F.lit(" "), F.lit(",")))
        .alias("images"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with five category levels and the sales date."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    word = F.split("p_name", " ")
    levels = part.select(
        F.col("p_partkey"),
        F.col("p_type").alias("level1_global_be_category"),
        F.col("p_brand").alias("level2_global_be_category"),
        F.col("p_size").alias("level3_global_be_category"),
        F.get(word, F.lit(0)).alias("level4_global_be_category"),
        F.get(word, F.lit(1)).alias("level5_global_be_category"),
    )
    return line.join(levels, line["l_partkey"] == levels["p_partkey"]).select(
        F.col("l_partkey").alias("item_id"),
        F.to_date("l_shipdate").alias("grass_date"),
        *levels.columns[1:],
    )


def order_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items with shop and flags, dated by the year of their sale."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    return (
        line.join(part, line["l_partkey"] == part["p_partkey"])
        .join(supplier, line["l_suppkey"] == supplier["s_suppkey"])
        .select(
            F.col("l_partkey").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("l_suppkey").alias("shop_id"),
            F.col("s_name").alias("shop_name"),
            F.col("p_type").alias("level1_global_be_category"),
            F.to_date(F.date_trunc("year", "l_shipdate")).alias("grass_date"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_bi_excluded"),
            F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("is_net_order"),
            F.when(F.col("s_acctbal") > 0, 1).otherwise(0).alias("is_official_shop"),
        )
    )


def map_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category map whose versions are part sizes; one category has no cluster."""
    kind = F.col("p_type")
    return table(spark, sf_dir, "part").select(
        kind.alias("level1_global"),
        F.when(kind.isin("ECONOMY", "SMALL", "STANDARD"), "FMCG")
        .when(kind != "PROMO", "ELHA").alias("cluster"),
        F.col("p_size").alias("ingestion_timestamp"),
    )


def item_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image lists, for some items under an older date than the extract asks for."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("images"),
        F.date_sub(F.lit(EXTRACT_AS_OF), F.when(F.col("p_size") <= 40, 2).otherwise(3))
        .alias("grass_date"),
    )


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand map with unnamed brands, an older date and inactive rows."""
    brand = F.col("p_brand")
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("level1_global_be_category"),
        brand.alias("final_brand"),
        F.when(brand == "Brand#1", "NoBrand").when(brand != "Brand#2", brand)
        .alias("global_brand"),
        F.date_sub(F.lit(AS_OF), F.when(F.col("p_size") <= 40, 1).otherwise(2))
        .alias("grass_date"),
        F.when(F.col("p_name").startswith("small"), 0).otherwise(1).alias("status"),
    )


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector drawn as an 8 × 8 picture: ``path`` and the bytes of a bitmap.

    Red is the element, green its mirror image, blue is constant.  Bitmap rows run
    bottom up and pixels are blue, green, red.
    """
    byte = F.transform(
        "embedding", lambda x: F.floor((x.cast("double") + 1) * 127.5).cast("int")
    )
    hexed = F.transform(byte, lambda b: F.concat(
        F.lit("40"), F.lpad(F.hex(255 - b), 2, "0"), F.lpad(F.hex(b), 2, "0")
    ))
    rows = F.transform(
        F.sequence(F.lit(7), F.lit(0), F.lit(-1)),
        lambda r: F.array_join(F.slice(hexed, r * 8 + 1, F.lit(8)), ""),
    )
    # size 246, pixel data at 54; header 40, 8 × 8, 1 plane, 24 bits, 192 bytes of pixels
    header = ("424DF6000000000000003600000028000000080000000800000001001800"
              "00000000C0000000130B0000130B00000000000000000000")
    name = F.concat(
        F.col("label").cast("string"), F.lit("/"), F.col("vec_id").cast("string"),
        F.lit("_picture.jpg"),
    )
    return table(spark, sf_dir, "embeddings").select(
        name.alias("path"),
        F.unhex(F.concat(F.lit(header), F.array_join(rows, ""))).alias("content"),
    )
