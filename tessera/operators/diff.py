"""Differences of two snapshots of item lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _missing(of: Column, other: Column) -> Column:
    """How many items of ``of`` are not in ``other``; the set of missing ones is made by hashing, once, and is small."""
    count = lambda gone: F.when(F.size(gone) == 0, 0).otherwise(F.size(F.filter(of, lambda x: F.array_contains(gone, x))))
    return F.get(F.transform(F.array(F.array_except(of, other)), count), 0).cast("long")


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, items: str) -> DataFrame:
    """``(key, before, after, added, removed, status)`` of the keys whose lists differ; a null list is an empty one.

    Status: new (only in ``after``), gone (only in ``before``), emptied or changed. Keys are unique in each snapshot; one
    full outer join, whatever the size of the sides.
    """
    side = lambda df, name: df.select(key, F.coalesce(items, F.array().cast("array<string>")).alias(name), F.lit(True).alias(f"in_{name}"))
    none = F.array().cast("array<string>")
    j = side(before, "a").join(side(after, "b"), key, "full_outer").select(key, F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b"), "in_a", "in_b")
    status = F.when(F.col("in_a").isNull(), "new").when(F.col("in_b").isNull(), "gone").when(F.size("b") == 0, "emptied").otherwise("changed")
    size = lambda c: F.size(c).cast("long")
    out = j.where(F.col("in_a").isNull() | F.col("in_b").isNull() | (F.col("a") != F.col("b")))
    return out.select(key, size("a").alias("before"), size("b").alias("after"), _missing(F.col("b"), F.col("a")).alias("added"), _missing(F.col("a"), F.col("b")).alias("removed"), status.alias("status"))
