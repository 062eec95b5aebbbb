"""Vectors as arrays of doubles, inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def unit(v: Column) -> Column:
    """Scaled to length 1; a zero vector stays as it is."""
    return F.element_at(F.transform(F.array(norm(v)), lambda n: F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))), 1)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 for empty vectors, zero vectors and vectors of different lengths."""
    n = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0) & (n > 0), dot(a, b) / n).otherwise(0.0)


def rounded(v: Column, digits: int) -> Column:
    """Rounded as in DuckDB: a zero keeps the sign of its value, which Spark's round drops."""
    return F.transform(v, lambda x: F.when(F.round(x, digits) == 0, x * F.lit(0.0)).otherwise(F.round(x, digits)))


def _scaled(v: Column, by: float) -> Column:
    return F.transform(v, lambda x: x * F.lit(by))


def weighted_fields(fields: list[tuple[Column, float]]) -> Column:
    """Field vectors scaled to length 1 and the root of their weight, one after the other: its dot product is the weighted sum of the fields' cosines."""
    return F.concat(*[_scaled(unit(v), float(w) ** 0.5) for v, w in fields])


def weighted_sum(fields: list[tuple[Column, float]]) -> Column:
    """The weighted sum of field vectors scaled to length 1, scaled again."""
    total = None
    for v, w in fields:
        part = _scaled(unit(v), float(w))
        total = part if total is None else F.zip_with(total, part, lambda x, y: x + y)
    return unit(total)
