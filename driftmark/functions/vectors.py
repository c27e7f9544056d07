"""Vector expressions over arrays of numbers, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x))


def cosine_similarity(a: Column, b: Column) -> Column:
    """1 minus the cosine distance; null where a vector is null, empty of length or of another width."""
    n = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (n > 0), dot(a, b) / n)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - cosine_similarity(a, b)


def literal(values: list[float]) -> Column:
    """A constant vector, folded once per plan."""
    return F.lit([float(v) for v in values]).cast("array<double>")


def close(a: Column, b: Column, relative: float = 1e-5, absolute: float = 1e-6) -> Column:
    """Whether two vectors have one width and agree element by element within tolerance."""
    near = F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y) <= F.greatest(relative * F.greatest(F.abs(x), F.abs(y)).cast("double"), F.lit(absolute)))
    return (F.size(a) == F.size(b)) & F.forall(near, lambda x: F.coalesce(x, F.lit(False)))
