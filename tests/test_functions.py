import math

import pytest
from pyspark.sql import functions as F

from twinshelf.functions import scores, text, urls, vectors


def values(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


@pytest.mark.parametrize("raw, clean", [
    (None, None),
    ("", ""),
    ("🎉🎉", ""),
    ("  MiXed   Case\tText ", "mixed case text"),
    ("see https://a.b/c?d=e now!", "see now"),
    ("Crème brûlée №5", "crème brûlée 5"),
    ("a-b/c_d", "a b c d"),
    ("xhttps://y.z?q=1 https://w http", "x http"),
    ("a\u00a0b\u3000c", "a b c"),
    ("?" * 50_000 + "a" + "https://b " * 20_000, "a"),
])
def test_clean_text(spark, raw, clean):
    assert values(spark, [(raw,)], "t string", text.clean_text(F.col("t"))) == [(clean,)]


def test_word_limit(spark):
    got = values(spark, [("a b  c d",), ("",), (None,)], "t string",
                 text.first_words(F.col("t"), 2))
    assert got == [("a b",), ("",), (None,)]


def test_paths(spark):
    path = "file:/x/y/12_ab.cd_3.jpg"
    got = values(spark, [(path,), ("plain",), ("x/n_7",)], "p string",
                 text.file_stem(F.col("p")), text.file_number(F.col("p")),
                 text.file_number(F.col("p"), 1), text.last_url_segment(F.col("p")))
    assert got == [("12_ab.cd_3", 12, None, "12_ab.cd_3.jpg"), ("plain", None, None, "plain"),
                   ("n_7", None, 7, "n_7")]


def test_category_names(spark):
    got = values(spark, [("A__B__C/D",), ("A",)], "c string",
                 text.category_leaf(F.col("c")),
                 text.without_slashes(text.category_leaf(F.col("c"))),
                 text.rewrite_path(F.col("c"), "A__", "."))
    assert got == [("C/D", "CD", ".B__C/D"), ("A", "A", "A")]


def test_round_score(spark):
    data = [(v,) for v in (0.123456, 0.999996, 1.0, 1.04, 12.35, 0.259995, -0.123455)]
    got = [r[0] for r in values(spark, data, "s double", scores.round_score(F.col("s")))]
    assert got == [0.12346, 1.0, 1.0, 1.0, 12.4, 0.25999, -0.12346]
    special = values(spark, [(None,), (math.nan,)], "s double", scores.round_score(F.col("s")))
    assert special[0] == (None,) and math.isnan(special[1][0])


def test_exact_half_goes_to_even(spark):
    got = values(spark, [(0.5,), (1.5,), (2.5,)], "s double",
                 scores.round_half_even(F.col("s"), 0))
    assert got == [(0.0,), (2.0,), (2.0,)]


def test_fused_score(spark):
    data = [(0.2, 0.4), (0.2, None), (None, 0.4), (None, None)]
    got = values(spark, data, "t double, i double", scores.fused_score(F.col("t"), F.col("i")))
    assert [r[0] for r in got] == [pytest.approx(0.3), 0.2, 0.4, None]


def test_display(spark):
    assert values(spark, [(1234.5678,)], "s double", scores.display_score(F.col("s"))) == [
        ("1,234.568",)]


def test_normalize(spark):
    data = [([3.0, 4.0],), ([0.0, 0.0],), (None,)]
    got = values(spark, data, "v array<float>", vectors.l2_normalize(F.col("v")))
    assert got == [(pytest.approx([0.6, 0.8]),), (None,), (None,)]


def test_dot_and_cosine(spark):
    data = [([1.0, 2.0], [2.0, 4.0]), ([0.0, 0.0], [1.0, 1.0])]
    got = values(spark, data, "a array<float>, b array<float>",
                 vectors.dot(F.col("a"), F.col("b")), vectors.cosine(F.col("a"), F.col("b")))
    assert got == [(10.0, pytest.approx(1.0)), (0.0, None)]


def test_links(spark):
    got = values(spark, [(1, 2, "u"), (None, 2, None)], "s long, i long, u string",
                 urls.product_url("http://x/", F.col("s"), F.col("i")),
                 urls.image_formula(F.col("u")))
    assert got == [("http://x/1/2", '=IMAGE("u", 1)'), (None, None)]
