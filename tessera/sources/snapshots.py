"""Snapshots of a keyed text table: one Parquet folder a generation, written only when something changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _store(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def generations(spark: SparkSession, path: str) -> list[str]:
    """The complete generations under ``path``, oldest first; names sort by time."""
    store, root = _store(spark, path)
    if not store.exists(root):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    folders = [f.getPath() for f in store.listStatus(root) if f.isDirectory()]
    return sorted(p.getName() for p in folders if store.exists(done(p, "_SUCCESS")))


def restore(spark: SparkSession, path: str, names: list[str] | None = None, generation: str | None = None) -> DataFrame:
    """``(name, text)`` of a generation, the newest by default; only ``names`` where they are given."""
    generation = generation or generations(spark, path)[-1]
    rows = spark.read.schema("name string, text string").parquet(f"{path}/{generation}")
    return rows if names is None else rows.where(F.col("name").isin(*names))


def prune(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the newest ``keep`` generations."""
    store, _ = _store(spark, path)
    old = generations(spark, path)
    for name in old[: max(len(old) - max(keep, 0), 0)]:
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)


def write_snapshot(rows: DataFrame, path: str, generation: str, keep: int = 1, names: list[str] | None = None, skip_if_same: bool = True) -> bool:
    """Write ``rows(name, text)`` as ``generation`` and keep the newest ``keep``; whether it was written.

    Nothing is written for no rows, for ``keep`` of 0 or less, or where the newest generation holds every row with the same
    text already; rows that only the generation has do not count, as a snapshot may be of some ``names`` only.
    """
    spark = rows.sparkSession
    rows = rows.select("name", "text")
    if names is not None:
        rows = rows.where(F.col("name").isin(*names))
    if not rows.limit(1).count():
        return False
    old = generations(spark, path)
    if keep > 0 and old and generation <= old[-1]:
        raise ValueError(f"generation {generation!r} does not follow {old[-1]!r}")
    wanted = keep > 0
    if wanted and old and skip_if_same:
        last = restore(spark, path).select(F.col("name").alias("n"), F.col("text").alias("t"))
        same = rows.name.eqNullSafe(last.n) & rows.text.eqNullSafe(last.t)
        wanted = bool(rows.join(last, same, "left_anti").limit(1).count())
    if wanted:
        rows.write.mode("overwrite").parquet(f"{path}/{generation}")
    prune(spark, path, keep)
    return wanted
