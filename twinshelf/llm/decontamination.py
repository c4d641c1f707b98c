"""Benchmark decontamination on templates.

A text's words become template tokens: numbers, names and units turn into typed
placeholders, punctuation around words goes, letters are lower-cased. Every window of
``size`` template tokens of the benchmark items that has at least ``MIN_LITERALS`` plain
words is hashed, and the windows of all documents meet them in one hash join. Hits of
one document and item at one alignment are then held against the item's slots under the
windows that hit: a slot value of the item must stand for one value of the document
throughout, in at least half of these slot values. Where that fails, windows with the item's own slot
values still count. Verbatim copies satisfy that as they are, re-parameterised
questions by one consistent substitution; look-alikes by chance don't.

Everything is a DataFrame or SQL operation; no Python runs on the executors. A document's
windows are hashed where it is read; only ids and hashes that hit go further.

Cases: null and empty texts and items never match; an item shorter than a window is one
window, matched by its own length anywhere in a document; repeated rows of a document count once; rows with one
id are one document; null ids are kept by ``drop_contaminated`` and never reported; empty tables
give an empty result or the documents as they are; other columns are ignored or kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.llm.common import stored, table

SIZE = 8
MIN_LITERALS = 4
MIN_WINDOWS = 3
SPACES = "[\\x20\\x09-\\x0D]+"
#: Units that follow a number.
UNITS = (
    "mm|cm|m|km|in|ft|mi|mg|g|kg|t|oz|lb|ml|l|s|ms|min|h|hz|khz|mhz|ghz|w|kw|v|a|k|c|f|pa|bar|j|kj|cal|"
    "kcal|mph|kmh|usd|eur|gbp|percent|hours?|minutes?|seconds?|days?|weeks?|months?|years?|meters?|metres?|"
    "miles?|feet|inches|pounds?|dollars?|euros?|grams?|liters?|litres?"
)
SLOT = "^<(num|name|unit)>$"


def template(text: Column) -> Column:
    """The text with typed placeholders; as many words as before, in the same places."""
    out = F.regexp_replace(text, "(?<=[\\p{Ll},;] )\\p{Lu}[\\p{L}'’-]*", "<name>")
    out = F.regexp_replace(out, "\\p{Nd}+(?:[.,:]\\p{Nd}+)*", "<num>")
    out = F.regexp_replace(out, f"(?<=<num> ?)(?i:{UNITS})(?![\\p{{L}}\\p{{N}}])", "<unit>")
    edge = "(?<=[\\p{L}\\p{N}>])[^\\p{L}\\p{N}\\s<>]+|[^\\p{L}\\p{N}\\s<>]+(?=[\\p{L}\\p{N}<])"
    return F.lower(F.regexp_replace(out, edge, ""))


def words(text: Column) -> Column:
    """Words of a text; white space around it makes none."""
    return F.split(F.regexp_replace(text, f"^{SPACES}|{SPACES}$", ""), SPACES)


def windows(tokens: Column, size: int) -> Column:
    """The hash of each window, by place; one for a text shorter than a window."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(tokens) - size + 1, F.lit(1))),
        lambda at: F.xxhash64(F.slice(tokens, at, size)),
    )


def benchmark_windows(items: DataFrame, size: int, item_col: str, text_col: str) -> DataFrame:
    """(h, item, item_at, n): hashed windows with enough plain words, and how many there are."""
    tokens = items.filter(F.trim(F.regexp_replace(F.col(text_col), SPACES, " ")) != "").select(
        F.col(item_col).alias("item"), words(template(F.col(text_col))).alias("tokens")
    )
    placed = tokens.select("item", "tokens", F.posexplode(windows(F.col("tokens"), size)).alias("item_at", "h"))
    plain = F.size(F.filter(
        F.slice("tokens", F.col("item_at") + 1, size), lambda t: ~t.rlike(SLOT)
    ))
    enough = placed.filter(plain >= F.least(F.lit(MIN_LITERALS), F.size("tokens"))).select("h", "item", "item_at").distinct()
    return enough.join(enough.groupBy("item").agg(F.count("*").alias("n")), "item")


def contaminated(
    docs: DataFrame, items: DataFrame, *, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(id, item, windows, item_windows, slots_kept): documents with passages of items."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        "id is not null and text is not null"
    )
    known = stored(benchmark_windows(items, size, item_col, item_text_col), "benchmark-windows")
    tokens = texts.select("id", words(template(F.col("text"))).alias("tokens"))
    own = tokens.select("id", F.posexplode(windows(F.col("tokens"), size)).alias("at", "h"))
    item_words = F.size(words(template(F.col(item_text_col))))
    for short, in items.select(item_words).filter(item_words.between(1, size - 1)).distinct().collect():
        longer = tokens.filter(F.size("tokens") > short)  # a document of that length has its one window already
        own = own.union(longer.select("id", F.posexplode(windows(F.col("tokens"), short)).alias("at", "h")))
    hits = own.join(known, "h").select("id", "item", "item_at", "n", (F.col("at") - F.col("item_at")).alias("shift"))
    # a document that repeats a passage has it at more than one alignment
    found = stored(
        hits.groupBy("id", "item", "shift").agg(F.collect_set("item_at").alias("places"), F.first("n").alias("n")),
        "template-hits",
    )
    slots = items.select(
        F.col(item_col).alias("item"),
        words(F.col(item_text_col)).alias("raw"),
        words(template(F.col(item_text_col))).alias("tokens"),
    ).select("item", F.filter(
        F.transform(F.arrays_zip("raw", "tokens"), lambda x, i: F.struct(i.alias("at"), x["raw"].alias("value"), x["tokens"].alias("token"))),
        lambda x: x["token"].rlike(SLOT),
    ).alias("slots"))
    raw = texts.join(found.select("id").distinct(), "id", "left_semi").select("id", words(F.col("text")).alias("words"))
    within = lambda s, p: (s["at"] >= p) & (s["at"] < p + size)
    doc_word = lambda s: F.try_element_at("words", (s["at"] + F.col("shift") + 1).cast("int"))
    aligned = found.join(slots, "item").join(raw, "id").withColumn(
        "pairs",
        F.array_distinct(F.transform(
            F.filter("slots", lambda s: F.exists("places", lambda p: within(s, p))),
            lambda s: F.struct(s["value"].alias("item"), doc_word(s).alias("doc")),
        )),
    )
    values = F.array_distinct(F.transform("pairs", lambda p: p["item"]))
    single = F.size(F.filter(values, lambda v: F.size(F.filter("pairs", lambda p: p["item"] == v)) == 1))
    verbatim = F.filter("places", lambda p: F.forall(
        "slots", lambda s: ~within(s, p) | s["value"].eqNullSafe(doc_word(s))
    ))
    judged = aligned.withColumns({"values": F.size(values), "single": single}).withColumn(
        "hit", F.size(F.when(F.expr("2 * single >= values"), F.col("places")).otherwise(verbatim))
    ).filter("hit > 0")
    # repeated rows of a document align alike: they count once
    per_shift = judged.groupBy("id", "item", "shift").agg(
        F.max("hit").alias("hit"), F.max("n").alias("n"), F.max("single").alias("single")
    )
    return (
        per_shift.groupBy("id", "item")
        .agg(F.sum("hit").alias("windows"), F.max("n").alias("item_windows"), F.max("single").alias("slots_kept"))
        .filter(F.col("windows") >= F.least(F.lit(MIN_WINDOWS), F.col("item_windows")))
        .withColumnsRenamed({"id": id_col, "item": item_col})
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """``docs`` without the documents that have a passage of an item."""
    found = contaminated(docs, items, id_col=id_col, **columns).select(F.col(id_col).alias("__id")).distinct()
    return docs.join(found, docs[id_col] == F.col("__id"), "left_anti")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a passage of the benchmark, and the items it is of."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: list[Callable] = [op4_decontamination]
