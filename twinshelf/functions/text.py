"""Text and path expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(text: Column) -> Column:
    """Drop links, punctuation and emoji, keep letters with their marks; one space between words; lower case."""
    # a link starts with a letter, so both alternatives can be found in one pass
    text = F.regexp_replace(text, r"https?://\S+|[^\p{L}\p{M}\p{N}]+", " ")
    return F.trim(F.lower(F.regexp_replace(text, " +", " ")))


def first_words(text: Column, n: int) -> Column:
    """The text cut to its first ``n`` words, the encoders' length limit."""
    return F.array_join(F.slice(F.split(text, r"\s+"), 1, n), " ")


def last_url_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def category_leaf(category: Column) -> Column:
    """``Beauty__Skincare__Serum`` → ``Serum``."""
    return F.element_at(F.split(category, "__"), -1)


def rewrite_path(path: Column, old: str, new: str) -> Column:
    """Literal (not regex) replacement, e.g. of a mount point."""
    return F.replace(path, F.lit(old), F.lit(new))


def without_slashes(name: Column) -> Column:
    return F.replace(name, F.lit("/"), F.lit(""))


def file_stem(path: Column) -> Column:
    """File name without folders and without its last extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def file_number(path: Column, part: int = 0) -> Column:
    """Number in the ``part``-th ``_`` field of the file stem, else null."""
    return F.get(F.split(file_stem(path), "_"), F.lit(part)).try_cast("bigint")
