"""Vector column expressions (C7, C8, C9, cosine) built from Spark higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v: Column | str) -> Column:
    return _c(v).cast("array<double>")


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda s, x: s + x)


def l2_distance(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance of two equal-length vectors."""
    sq = F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(_sum(sq))


def dot(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def norm(v: Column | str) -> Column:
    return F.sqrt(_sum(F.transform(as_double(v), lambda x: x * x)))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """1 - cos(a, b); NULL when either vector has zero length."""
    den = norm(a) * norm(b)
    return F.when(den > 0, F.lit(1.0) - dot(a, b) / den)


def normalize(v: Column | str) -> Column:
    """Unit-length copy (C8); a zero vector is returned unchanged."""
    n = norm(v)
    return F.when(n > 0, F.transform(as_double(v), lambda x: x / n)).otherwise(as_double(v)).cast("array<float>")


def to_text(v: Column | str) -> Column:
    """Vector -> '[a,b,...]' text."""
    return F.to_json(_c(v))


def from_text(s: Column | str) -> Column:
    """'[a,b,...]' text -> ARRAY<FLOAT>."""
    return F.from_json(_c(s), "array<float>")
