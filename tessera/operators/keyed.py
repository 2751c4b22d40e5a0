"""Keyed tables: last row wins, insert-only and replacing merges, ledgers, folds, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_by_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key by ``order``. A row of many columns is folded as one struct, so copies combine before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return top.select(*keys, "row.*").select(*df.columns)


def first_by_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by ``order``."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return top.select(*keys, "row.*").select(*df.columns)


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def insert_unseen(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` and the rows of ``new`` whose key it lacks; null keys compare as equal."""
    return old.unionByName(new.join(old, _same(new, old, keys), "left_anti"), allowMissingColumns=True)


def replace_keyed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``new`` and the rows of ``old`` whose key it lacks."""
    return old.join(new, _same(old, new, keys), "left_anti").unionByName(new, allowMissingColumns=True)


def append_ledger(ledger: DataFrame, entries: DataFrame, keys: list[str], order: list) -> DataFrame:
    """An audit ledger after ``entries``: the first entry of a key stays, later ones are not recorded."""
    return insert_unseen(ledger, first_by_key(entries, keys, order), keys)


def merge_mapping(old: DataFrame, batch: DataFrame, bucket: str, name: str) -> DataFrame:
    """An append-only mapping: ``batch`` replaces rows of the same bucket and name, or of the name where the old row has no bucket."""
    with_bucket = old.where(F.col(bucket).isNotNull()).join(batch.select(bucket, name), [bucket, name], "left_anti")
    without = old.where(F.col(bucket).isNull()).join(batch.select(name), name, "left_anti")
    return with_bucket.unionByName(without).unionByName(batch)


def keep_generations(df: DataFrame, generation: str, n: int) -> DataFrame:
    """The rows of the newest ``n`` generations; the list of generations is small and has one row each."""
    newest = df.select(generation).distinct().orderBy(F.col(generation).desc()).limit(n) if n > 0 else df.select(generation).limit(0)
    return df.join(F.broadcast(newest), generation, "left_semi").select(*df.columns)


def last_event(events: DataFrame, key: str, order: list) -> DataFrame:
    """The current state of each key: its last event."""
    return latest_by_key(events, [key], order)


def fold_entity(changes: DataFrame, key: str, seq: str, scalars: list[str], unions: list[str]) -> DataFrame:
    """One row per entity: last value that is neither null nor empty of each scalar, sorted union of each list, number of changes."""
    last = [F.max_by(F.when(F.col(c).cast("string") != "", F.col(c)), F.when(F.col(c).cast("string") != "", F.col(seq))).alias(c) for c in scalars]
    both = [F.array_sort(F.collect_set(c)).alias(c) for c in unions]
    return changes.groupBy(key).agg(*last, *both, F.count("*").alias("n_changes"))


def reconcile(known: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Each key of either side with status known / missing / adopted."""
    a, b = known.select(*keys).distinct().withColumn("__k", F.lit(1)), present.select(*keys).distinct().withColumn("__p", F.lit(1))
    status = F.when(F.col("__p").isNull(), "missing").when(F.col("__k").isNull(), "adopted").otherwise("known")
    return a.join(b, keys, "full_outer").select(*keys, status.alias("status"))


def history_tail(df: DataFrame, key: str, order: list, n: int = 30) -> DataFrame:
    """The last ``n`` rows of each key (the bound is the feature); Spark filters each task's own tail before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("__r", rank).where(F.col("__r") <= n).drop("__r")
