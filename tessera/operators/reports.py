"""Counts and reports by bucket, weights and plans. All are partial aggregations; nulls are a bucket of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _digest(text: str) -> Column:
    return F.md5(F.col(text).cast("binary")).alias("h")


def exact_groups(rows: DataFrame, ident: str, text: str) -> DataFrame:
    """``(h, first, n)`` of the texts that more than one row has; null texts are no copies of each other."""
    g = rows.where(F.col(text).isNotNull()).groupBy(_digest(text)).agg(F.min(ident).alias("first"), F.count("*").alias("n"))
    return g.where("n > 1")


def later_copies(rows: DataFrame, ident: str, text: str) -> DataFrame:
    """``(ident, first)`` of each row whose text a row of a lesser ident has."""
    d = rows.select(ident, _digest(text))
    return d.join(exact_groups(rows, ident, text).select("h", "first"), "h").where(F.col(ident) != F.col("first")).select(ident, "first")


def unique_by_bucket(rows: DataFrame, bucket: str, ident: str, key: list) -> DataFrame:
    """``(bucket, uniq, dup)``: a key counts in the first bucket, and there at the least ident, that has it.

    Buckets without any first holder are left out.
    """
    d = rows.select(bucket, ident, F.struct(*key).alias("__k"))
    first = d.groupBy("__k").agg(F.min(F.struct(bucket, ident)).alias("at"))
    uniq = first.groupBy(F.col(f"at.{bucket}").alias("__b")).agg(F.count("*").alias("uniq"))
    n = d.groupBy(bucket).agg(F.count("*").alias("n"))
    return n.join(uniq, F.col(bucket).eqNullSafe(F.col("__b"))).select(bucket, "uniq", (F.col("n") - F.col("uniq")).alias("dup"))


def bucket_counts(rows: DataFrame, by: list[str], without: Column | None = None, **conditions: Column) -> DataFrame:
    """Rows by bucket and how many of them meet each condition; ``without`` names buckets to leave out."""
    d = rows if without is None else rows.where(~F.coalesce(without, F.lit(False)))
    return d.groupBy(*by).agg(F.count("*").alias("n"), *[F.count(F.when(c, 1)).alias(k) for k, c in conditions.items()])


def caption_health(rows: DataFrame, by: str, length: str, captioned: Column, least: int) -> DataFrame:
    """By bucket: rows, those without a caption, and the least, greatest and mean length and how many are under ``least``."""
    n = lambda c: F.count(F.when(c, 1))
    return rows.groupBy(by).agg(F.count("*").alias("n"), n(~F.coalesce(captioned, F.lit(False))).alias("missing"), F.min(length).alias("low"), F.max(length).alias("high"), F.round(F.avg(length), 1).alias("mean"), n(F.col(length) < least).alias("under"))


def hit_rates(log: DataFrame, source: str, ident: str, hit: Column, sources: list[str]) -> DataFrame:
    """``(source, queried, rate)`` of every listed source, also of those that were never asked."""
    e = log.groupBy(source).agg(F.count(ident).alias("queried"), F.count(F.when(hit & F.col(ident).isNotNull(), 1)).alias("hit"))
    listed = log.sparkSession.createDataFrame([(x,) for x in sources], f"{source} string")
    j = F.broadcast(listed).join(e, source, "left")  # the caller's list of sources
    return j.select(source, F.coalesce("queried", F.lit(0).cast("long")).alias("queried"), F.coalesce(F.try_divide("hit", "queried"), F.lit(0.0)).alias("rate"))


def repeat_weight(size: Column, scale: float) -> Column:
    """How often the rows of a group of a size are repeated: scale / sqrt(size), half to even, at least once."""
    return F.greatest(F.lit(1), F.bround(F.lit(scale) / F.sqrt(size), 0)).cast("long")


def group_weights(rows: DataFrame, group: str, prefix: str, scale: float) -> DataFrame:
    """``(bucket, families, repeats)``: groups by size, with the weight of that size."""
    sizes = rows.groupBy(group).agg(F.count("*").alias("k")).groupBy("k").agg(F.count("*").alias("families"))
    return sizes.select(F.concat(F.lit(prefix), F.col("k").cast("string")).alias("bucket"), "families", repeat_weight(F.col("k"), scale).alias("repeats"))


def balance_plan(rows: DataFrame, by: str, balanced: Column, steps: list[tuple[int, int]], most: int) -> DataFrame:
    """``(by, n, repeats)``: buckets to balance are repeated by a step of their size, or up to the largest other one, ``most`` at most.

    ``steps`` are ``(size below, repeats)`` in rising order. The largest size comes to the driver as one number.
    """
    b = rows.groupBy(by).agg(F.count("*").alias("n")).withColumn("__b", F.coalesce(balanced, F.lit(False)))
    big = b.where("NOT __b").agg(F.max("n")).first()[0]
    base = F.lit(1)
    for below, k in reversed(steps):
        base = F.when(F.col("n") < below, k).otherwise(base)
    up = F.least(F.lit(most), F.greatest(base, F.ceil(F.lit(big) / F.col("n"))))
    return b.select(by, "n", F.when(F.col("__b"), up).otherwise(1).cast("long").alias("repeats"))


def majority_gap(rows: DataFrame, by: str, marked: Column, share: float) -> DataFrame:
    """The unmarked rows of the buckets of which at least ``share`` of the rows are marked; null is unmarked."""
    m = rows.withColumn("__m", F.coalesce(marked, F.lit(False)))
    well = m.groupBy(by).agg(F.avg(F.col("__m").cast("int")).alias("__s")).where(F.col("__s") >= share).select(by)
    return m.where("NOT __m").join(well, by, "left_semi").drop("__m")


def bytes_report(rows: DataFrame, by: str, size: str) -> DataFrame:
    """``(by, bytes, unit)``: summed sizes and the unit to show them in."""
    from tessera.functions.text import human_bytes

    b = rows.groupBy(by).agg(F.sum(size).alias("bytes"))
    return b.withColumn("unit", F.element_at(F.split(human_bytes(F.col("bytes")), " "), 2))


def overview(rows: DataFrame, dataset: str, member: str, stage: Column) -> DataFrame:
    """``(dataset, members, stages)``: distinct members and the stages reached; a null stage counts for none."""
    return rows.groupBy(dataset).agg(F.count_distinct(member).alias("members"), F.array_join(F.array_sort(F.collect_set(stage)), "|").alias("stages"))


def pool_tags(rows: DataFrame, ident: str, text: str, tag: str) -> DataFrame:
    """``(h, keeper, pooled)``: of copies with different tags, the least ident and all their tags in name order."""
    g = rows.where(F.col(text).isNotNull()).groupBy(_digest(text)).agg(F.min(ident).alias("keeper"), F.array_sort(F.collect_set(tag)).alias("p"))
    return g.where(F.size("p") > 1).select("h", "keeper", F.array_join("p", ",").alias("pooled"))


def top_of_head(rows: DataFrame, head: str, name: str, suits, top: int) -> DataFrame:
    """``(head, name, posts)``: the ``top`` names of each head (the bound is the report's): suitable ones, then by count and name."""
    from pyspark.sql.window import Window

    g = rows.groupBy(F.col(head).alias("head"), F.col(name).alias("name")).agg(F.count("*").alias("posts"))
    r = F.row_number().over(Window.partitionBy("head").orderBy(suits(F.col("head"), F.col("name")).desc(), F.desc("posts"), "name"))
    return g.withColumn("__r", r).where(F.col("__r") <= top).drop("__r")
