"""Vector column functions built from higher-order array expressions (JVM side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Dot product in double precision, summed left to right."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def l2_norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalize(a: Column) -> Column:
    """Unit-length copy (double elements); a zero vector stays zero.

    The norm is evaluated once per row and zipped in as an array, not referenced
    inside the element lambda (which would recompute it for every element).
    """
    norms = F.array_repeat(l2_norm(a), F.size(a))
    return F.zip_with(a, norms, lambda x, n: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (l2_norm(a) * l2_norm(b))
