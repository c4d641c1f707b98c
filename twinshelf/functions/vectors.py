"""Vector expressions on ``array<float>`` columns, summed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def to_float32(v: Column) -> Column:
    return v.cast("array<float>")


def l2_normalize(v: Column) -> Column:
    """Unit-length float32 vector; null for a zero vector, which has no direction.

    ``array_repeat`` evaluates the norm once per row.  Dividing by it inside a
    ``transform`` lambda would evaluate it again for every element.
    """
    length = norm(v)
    scaled = F.zip_with(v, F.array_repeat(length, F.size(v)), lambda x, n: x / n)
    return F.when(length > 0, to_float32(scaled))
