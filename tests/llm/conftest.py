import random

import pytest
from pyspark.sql import types as T

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("id", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("fp", T.IntegerType()), T.StructField("words", T.StringType()), T.StructField("n", T.IntegerType()),
])


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + pick.choice(["", "", ".", ","]) for _ in range(n))


def texts() -> list:
    """Nulls, empty texts, white space, copies, near copies, shared passages, one long text."""
    shared = prose(1, 60)
    out = [prose(k, 20 + 7 * k) for k in range(12)]
    out += [None, None, "", " \t\n", "one", "two words", out[3], out[3], "  " + out[3].replace(" ", "\n "), out[5]]
    out += [prose(50, 30) + " " + shared + " " + prose(51, 20), shared, prose(52, 9) + "\n" + shared]
    out += [out[7].replace("alpha", "omega", 1), out[8] + " end", "a" * 900, "ab" * 300 + "é" * 250]
    out += ["Ünïcode ñandú – «¿qué?» 12.5 km", "日本語のテキスト 漢字", "🙂 emoji\x00zero", "<|endoftext|> x", prose(99, 30_000)]
    return out


@pytest.fixture(scope="session")
def odd_rows():
    """Rows of documents, with repeated rows and nulls in every column."""
    rows = [(k, t, "en" if k % 2 else None, "s", None, "x", None, k, None, None) for k, t in enumerate(texts())]
    return [*rows, rows[4], rows[4]]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
