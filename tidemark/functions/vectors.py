"""Column expressions over ``ARRAY<FLOAT>`` vectors, computed in double."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(values: Sequence[float]) -> Column:
    return F.lit([float(v) for v in values])


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(vector: Column) -> Column:
    squares = F.aggregate(
        vector, F.lit(0.0), lambda total, v: total + v.cast("double") * v.cast("double")
    )
    return F.sqrt(squares)


def cosine(left: Column, right: Column, left_norm: Column, right_norm: Column) -> Column:
    """Cosine similarity; NULL when either vector has length zero."""
    return F.try_divide(dot(left, right), left_norm * right_norm)
