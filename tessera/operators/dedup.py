"""Exact duplicates: the first of equal rows stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_of(rows: DataFrame, signature: Column, order: list[str]) -> DataFrame:
    """Rows that come first, by order, among those of equal signature.

    The first is found by an aggregate that combines before its shuffle, so a signature that many rows share is no burden.
    """
    keyed = rows.withColumn("signature", signature)
    first = keyed.groupBy(F.col("signature").alias("of_signature")).agg(F.min(F.struct(*order)).alias("least"))
    same = F.col("signature").eqNullSafe(F.col("of_signature")) & (F.struct(*order) == F.col("least"))
    return keyed.join(first, same, "left_semi").drop("signature")


def ring_signature(kind: Column, coordinates: Column) -> Column:
    """type and the exterior ring of a Polygon's, or of a MultiPolygon's first part, rounded to 7 decimals.

    The start vertex and the direction matter. Other types go by their coordinates as text.
    """
    point = "array<double>"
    one = F.get(F.from_json(coordinates, f"array<array<{point}>>"), F.lit(0))
    many = F.get(F.get(F.from_json(coordinates, f"array<array<array<{point}>>>"), F.lit(0)), F.lit(0))
    ring = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many)
    text = F.to_json(F.transform(ring, lambda p: F.transform(p, lambda v: F.bround(v.cast("decimal(38, 15)"), 7).cast("double"))))
    return F.concat_ws("|", kind, F.coalesce(text, coordinates))


def geojson(features: DataFrame) -> DataFrame:
    """Features (file, idx, type, coordinates text, ...) without repeats within their file."""
    return first_of(features, F.concat_ws("|", F.col("file"), ring_signature(F.col("type"), F.col("coordinates"))), ["file", "idx"])
