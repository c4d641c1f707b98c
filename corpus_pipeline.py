"""A corpus pipeline of five operators: each stage works on all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but the last return the
columns of ``documents`` as they came, extra ones included; the last returns the packed pieces.

* ``toxicity``: documents with a toxicity of 0.5 or more go. Labels are learned as in
  the operator, from the documents of the stage.
* ``exact_dedup``: of documents equal but for white space, one stays.
* ``near_dedup``: of documents similar by five-word shingles (0.8 or more), one stays.
* ``decontamination``: documents with a passage of ``benchmark`` go.
* ``packing``: what is left becomes sequences of at most 2048 tokens.

Cases: nulls, empty and very long texts, ties, repeated rows and empty tables are as each
operator defines them; a row is never lost but by a stage's decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twinshelf.llm import decontamination, exact_dedup, packing, simhash, toxicity
from twinshelf.llm.common import stored, table
from twinshelf.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity score rejects."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), toxicity.learnable_ids())
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    ship_package(spark)
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    ship_package(spark)
    return simhash.drop_near_duplicates(docs, shingle=5, similarity=0.8)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences, ids included."""
    import public_tokenizers

    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: Classifiers, fingerprints and packing are not expressible in SQL; tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
