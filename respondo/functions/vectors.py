"""Vector columns: products, cosine, normalisation, and an encoder of hashed character sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector divided by its length; an all-zero vector has none and becomes null."""
    length = norm(a)
    return F.when(length > 0, F.transform(a, lambda x: x.cast("double") / length))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def parse_vector(c: Column) -> Column:
    """An array literal as a vector; anything else as null."""
    return F.from_json(c, "array<float>")
