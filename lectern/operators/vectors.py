"""Exact nearest vectors by cosine distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector(values: Sequence[float]) -> Column:
    """A literal array<double>."""
    return F.split(F.lit(",".join(repr(float(x)) for x in values)), ",").cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cos; null where a length is zero, which sorts last."""
    return F.lit(1.0) - F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(rows: DataFrame, key: str, embedding: str, query: Column, top_k: int = 5, only: DataFrame | None = None, only_key: str | None = None) -> DataFrame:
    """The top_k rows by (distance, key); rows without a vector are left out, and with `only` rows whose only_key is not in it. Each task keeps top_k rows."""
    found = rows.where(F.col(embedding).isNotNull())
    if only is not None:
        found = found.join(only, only_key, "left_semi")
    return found.withColumn("distance", F.round(cosine_distance(F.col(embedding), query), 6)).orderBy(F.asc_nulls_last("distance"), key).limit(top_k)
