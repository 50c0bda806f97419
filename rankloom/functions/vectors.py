"""Vector expressions on array<float> columns, accumulated in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import NORM_FLOOR


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + x)


def _double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(left: Column, right: Column) -> Column:
    return _sum(F.zip_with(_double(left), _double(right), lambda a, b: a * b))


def squared_l2(left: Column, right: Column) -> Column:
    return _sum(F.zip_with(_double(left), _double(right), lambda a, b: (a - b) * (a - b)))


def norm(vector: Column) -> Column:
    return F.sqrt(_sum(F.transform(_double(vector), lambda x: x * x)))


def unit(vector: Column) -> Column:
    """Vector divided by its length; a zero vector stays zero."""
    return F.get(
        F.transform(
            F.array(F.greatest(norm(vector), F.lit(NORM_FLOOR))),
            lambda length: F.transform(_double(vector), lambda x: x / length),
        ),
        F.lit(0),
    )


def size_mb(count: Column, dim: Column) -> Column:
    """Storage of count x dim float32 values."""
    return count * dim * F.lit(4) / F.lit(1024.0 * 1024.0)
