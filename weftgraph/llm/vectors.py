"""Vectors of finite numbers, all of one length, as the vector operators take them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its numbers are there and finite."""
    numbers = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & numbers, F.lit(False))


def longest(vectors: DataFrame, column: str) -> int:
    """The greatest length of a vector, 0 if there is none."""
    return vectors.agg(F.max(F.size(column))).first()[0] or 0


def padded(vector: Column, length: int) -> Column:
    """A vector with zeros up to ``length``."""
    missing = F.lit(length) - F.size(vector)
    return F.when(missing > 0, F.concat(vector, F.array_repeat(F.lit(0.0), missing))).otherwise(vector)
