"""Numbers inside groups and over whole tables, without one task a group or one for all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.storage import materialize


def _free(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has: each is longer than all of them."""
    longest = max(df.columns, key=len)
    return [f"{longest}_{n}" for n in names]


def _ranged(df: DataFrame, keys: list, part: str) -> DataFrame:
    """``df`` in ranges of ``keys``, written once so that the number ``part`` of a range cannot change when a task is run again."""
    return materialize(df.repartitionByRange(*keys).withColumn(part, F.spark_partition_id()), "ranges")


def number_all(df: DataFrame, order: list, number: str = "number") -> DataFrame:
    """``df`` with 1, 2, ... over all rows by ``order``: a rank in each range plus the rows of the ranges before it.

    Rows that ``order`` ties are numbered among themselves in any way; nulls come first. The table of ranges has one row a
    partition.
    """
    part, n, off, r = _free(df, "part", "n", "off", "r")
    parts = _ranged(df, order, part)
    counts = parts.groupBy(part).agg(F.count("*").alias(n))
    before = counts.select(part, (F.sum(n).over(Window.orderBy(part)) - F.col(n)).alias(off))
    ranked = parts.withColumn(r, F.row_number().over(Window.partitionBy(part).orderBy(*order)))
    return ranked.join(F.broadcast(before), part).withColumn(number, F.col(r) + F.col(off)).drop(r, off, part)


def number_within(df: DataFrame, groups: list[str], order: list, number: str = "number") -> DataFrame:
    """``df`` with 1, 2, ... by ``order`` in each group; a null is a group of its own.

    Ranges are of groups and order together, so a group that holds a third of all rows is spread over a third of them. Only the
    first group of a range can have rows in an earlier one: what is broadcast has at most one row a partition.
    """
    part, n, off, r, p, g = _free(df, "part", "n", "off", "r", "p", "g")
    parts = _ranged(df, [*groups, *order], part)
    counts = parts.groupBy(part, *groups).agg(F.count("*").alias(n))
    before = F.sum(n).over(Window.partitionBy(*groups).orderBy(part)) - F.col(n)
    late = counts.withColumn(off, before).where(F.col(off) > 0).select(F.col(part).alias(p), F.struct(*groups).alias(g), off)
    ranked = parts.withColumn(r, F.row_number().over(Window.partitionBy(part, *groups).orderBy(*order)))
    same = (F.col(part) == F.col(p)) & F.struct(*groups).eqNullSafe(F.col(g))
    j = ranked.join(F.broadcast(late), same, "left")
    return j.withColumn(number, F.col(r) + F.coalesce(off, F.lit(0))).drop(r, off, p, g, part)


def total_before(df: DataFrame, groups: list[str], order: list, value: Column) -> tuple[DataFrame, str]:
    """``df`` with the sum of ``value`` over the rows before each in its group, and the name of that column.

    ``value`` is a whole number, ``order`` tells the rows of a group apart. Ranges are as in ``number_within``.
    """
    part, v, n, off, w, p, g = _free(df, "part", "v", "n", "off", "w", "p", "g")
    parts = _ranged(df.withColumn(v, value), [*groups, *order], part)
    sums = parts.groupBy(part, *groups).agg(F.sum(v).alias(n))
    before = F.sum(n).over(Window.partitionBy(*groups).orderBy(part)) - F.col(n)
    late = sums.withColumn(off, before).where(F.col(off) != 0).select(F.col(part).alias(p), F.struct(*groups).alias(g), off)
    within = Window.partitionBy(part, *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = parts.withColumn(w, F.coalesce(F.sum(v).over(within), F.lit(0)))
    same = (F.col(part) == F.col(p)) & F.struct(*groups).eqNullSafe(F.col(g))
    j = ranked.join(F.broadcast(late), same, "left")
    return j.withColumn(w, F.col(w) + F.coalesce(off, F.lit(0))).drop(v, off, p, g, part), w


def distinct_names(df: DataFrame, name: str, order: list, suffix, out: str | None = None) -> DataFrame:
    """``df`` with names that occur once: ``suffix(name, i)`` for the i-th holder of a name, from the second on.

    ``suffix`` makes a column of a name and its number. A null name stays null.
    """
    (i,) = _free(df, "i")
    n = number_within(df, [name], order, i)
    named = F.when(F.col(i) > 1, suffix(F.col(name), F.col(i).cast("string"))).otherwise(F.col(name))
    return n.withColumn(out or name, F.when(F.col(name).isNotNull(), named)).drop(i)


def bucket_ranks(df: DataFrame, bucket: str, rank: str = "rank") -> DataFrame:
    """``df`` with the place of its bucket among all buckets in name order; rows without a bucket get none."""
    ranks = number_all(df.select(bucket).where(F.col(bucket).isNotNull()).distinct(), [bucket], rank)
    return df.join(ranks, bucket, "left")


def serial(name: Column, i: Column, before: str, after: str = "") -> Column:
    """``name`` followed by a number between two signs."""
    return F.concat(name, F.lit(before), i, F.lit(after))
