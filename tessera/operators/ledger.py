"""The ledger of removed entries with restore and undo, and the run log of stages with invalidation.

Both are folds over append-only events: the tables follow from the events alone, so late and replayed events need no care but
their order. Running counts go by ranges, and a key with a third of all events is not one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.numbering import total_before

REMOVE, RESTORE = "remove", "restore"


def entries(events: DataFrame, key: str, kind: str, at: str, order: list[str], fields: list[str], event: str | None = None) -> DataFrame:
    """``(key, entry, at, fields..., restored_at)``: one row for each removal of a key, with the time of its restore or null.

    A ``remove`` opens an entry, or updates the open one: later values that are neither null nor empty win and ``at`` stays. A
    ``restore`` closes the open entry, and is ignored where none is open. ``order`` must tell the events of a key apart. Rows with
    another kind, or with a null key, do not count; of rows with the same ``event`` one counts, so events may be replayed.
    """
    known = events.select(key, kind, at, *[c for c in dict.fromkeys([*order, *fields, *([event] if event else [])]) if c not in (key, kind, at)])
    known = known.where(F.col(key).isNotNull() & F.col(kind).isin(REMOVE, RESTORE))
    if event:
        known = known.dropDuplicates([event])
    closes = F.col(kind) == RESTORE
    known, before = total_before(known, [key], order, closes.cast("long"))
    filled = lambda c: F.when(~closes & F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.struct(*order))
    opened = F.when(~closes, F.struct(*order))
    folded = known.groupBy(key, before).agg(
        F.min_by(at, opened).alias("o_at"), F.max(F.when(closes, F.col(at))).alias("o_restored"), F.count(opened).alias("o_n"), *[F.max_by(c, filled(c)).alias(f"f_{i}") for i, c in enumerate(fields)]
    )
    folded = folded.where("o_n > 0").select(F.col(key), F.col("o_at").alias("at"), *[F.col(f"f_{i}").alias(c) for i, c in enumerate(fields)], F.col("o_restored").alias("restored_at"), F.col(before).alias("gap"))
    # restores without an open entry leave gaps in the running count
    numbered, earlier = total_before(folded, [key], ["gap"], F.lit(1).cast("long"))
    return numbered.select(key, (F.col(earlier) + 1).alias("entry"), "at", *fields, "restored_at")


def still_removed(ledger: DataFrame) -> DataFrame:
    """The open entries; a key has at most one."""
    return ledger.where(F.col("restored_at").isNull())


def active(rows: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """The rows whose key has no open entry; null keys stay."""
    return rows.join(still_removed(ledger).select(key), key, "left_anti").select(*rows.columns)


def undo(ledger: DataFrame, key: str, wanted: DataFrame, at: Column, bucket: str, default: str) -> tuple[DataFrame, DataFrame]:
    """``(events, moves)`` for the keys of ``wanted``: a restore for each that is removed, and ``(key, bucket, status)`` for every one.

    Status is ``restored`` with the bucket of the open entry (``default`` where it has none), or ``not removed`` with null.
    """
    asked = wanted.select(key).where(F.col(key).isNotNull()).distinct()
    found = still_removed(ledger).select(key, F.coalesce(F.nullif(F.col(bucket), F.lit("")), F.lit(default)).alias("bucket"), F.lit(True).alias("open"))
    moves = asked.join(found, key, "left").select(key, "bucket", F.when(F.col("open"), "restored").otherwise("not removed").alias("status"))
    return moves.where("status = 'restored'").select(key, F.lit(RESTORE).alias("kind"), at.alias("at")), moves


def stage_table(log: DataFrame, stages: list[str], subject: str, stage: str, status: str, order: list[str]) -> DataFrame:
    """``(subject, stage, pos, status, stale_after)`` of every stage that a subject has a record of: its last status.

    ``stages`` are in their order of work, ``pos`` from 0. A stage is ``stale`` if it was marked so, or if an earlier stage was
    recorded after it in any status but ``stale``; ``stale_after`` names the first such stage. Records of other stages do not count.
    """
    place = F.create_map(*[x for i, s in enumerate(stages) for x in (F.lit(s), F.lit(i))])
    known = log.where(F.col(stage).isin(*stages) & F.col(subject).isNotNull())
    last = known.groupBy(subject, stage).agg(F.max_by(status, F.struct(*order)).alias("last"), F.max(F.struct(*order)).alias("done"), F.max(F.when(F.col(status) != "stale", F.struct(*order))).alias("ran"))
    last = last.select(subject, F.struct(place[F.col(stage)].alias("pos"), F.col(stage).alias("stage"), "last", "done", "ran").alias("r"))
    # a subject has at most one row a stage here, so its list is bounded by the list of stages
    rows = last.groupBy(subject).agg(F.array_sort(F.collect_list("r")).alias("all")).select(subject, "all", F.explode("all").alias("r"))
    later = F.filter("all", lambda x: (x["pos"] < F.col("r.pos")) & (x["ran"] > F.col("r.done")))
    rows = rows.withColumn("by", F.get(later, 0)["stage"])
    return rows.select(subject, F.col("r.stage").alias("stage"), F.col("r.pos").alias("pos"), F.when(F.col("by").isNotNull(), "stale").otherwise(F.col("r.last")).alias("status"), F.col("by").alias("stale_after"))


def invalidate_from(table: DataFrame, stages: list[str], subject: str, first: str, at: Column, subjects: DataFrame | None = None) -> DataFrame:
    """``(subject, stage, status, at)`` records, to be appended to the log: ``first`` and all later stages that were run become stale.

    Only ``subjects`` where they are given. A stage that is not listed raises.
    """
    if first not in stages:
        raise ValueError(f"unknown stage: {first}")
    hit = table.where((F.col("pos") >= stages.index(first)) & ~F.col("status").eqNullSafe("stale"))
    if subjects is not None:
        hit = hit.join(subjects.select(subject).distinct(), subject, "left_semi")
    return hit.select(subject, "stage", F.lit("stale").alias("status"), at.alias("at"))
