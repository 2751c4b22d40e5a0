"""Batch edits of tag lists, the ledger of tags removed by hand, and the answers of a review as edits.

Tag lists are in normal form, as washing gives them; tags of edits are normalised here. Edits are folded to distinct
``(key, op, tag)`` with map-side combining first, so what a row gathers is bounded by its own distinct tags. Null keys match
nothing; null tags and null lists are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import normalize_tag

NONE = "array<string>"


def _folded(edits: DataFrame, key: str) -> DataFrame:
    """``(key, op, tag, seq)``: each edit once, at its first place."""
    tagged = edits.select(key, "op", normalize_tag(F.col("tag")).alias("tag"), "seq")
    return tagged.where(F.col(key).isNotNull() & (F.col("tag") != "")).groupBy(key, "op", "tag").agg(F.min("seq").alias("seq"))


def apply_edits(rows: DataFrame, edits: DataFrame, ledger: DataFrame, key: str, tags: str = "tags") -> tuple[DataFrame, DataFrame]:
    """``rows`` after ``edits(key, seq, op, tag)`` and the ledger ``(key, tag)`` of removals after them.

    Of a row, its ``set`` edits together replace the list, then ``remove`` edits take tags out, then ``add`` edits append
    in the order of ``seq``. Removals enter the ledger, an explicit add releases its tag from it; edits of unknown rows
    change nothing.
    """
    e = _folded(edits, key).join(rows.select(key).distinct(), key, "left_semi")
    of = lambda op: F.transform(F.array_sort(F.collect_list(F.when(F.col("op") == op, F.struct("seq", "tag")))), lambda x: x["tag"])
    each = e.groupBy(F.col(key).alias("__key")).agg(of("set").alias("__set"), of("remove").alias("__gone"), of("add").alias("__more"))
    own = F.when(F.size("__set") > 0, F.col("__set")).otherwise(F.coalesce(tags, F.array().cast(NONE)))
    new = F.array_distinct(F.concat(F.array_except(own, F.col("__gone")), F.col("__more")))
    edited = rows.join(each, rows[key] == F.col("__key"), "left")
    edited = edited.withColumn(tags, F.when(F.col("__key").isNull(), F.col(tags)).otherwise(new)).select(*rows.columns)
    released = e.where("op = 'add'").select(key, "tag")
    removals = ledger.select(key, "tag").union(e.where("op = 'remove'").select(key, "tag")).distinct()
    return edited, removals.join(released, [key, "tag"], "left_anti")


def removed_tags(merged: DataFrame, current: DataFrame, ledger: DataFrame, key: str, tags: str = "tags", refresh: str = "none") -> DataFrame:
    """``(key, tag)`` that a new wash may not bring back.

    What the last wash had written (``merged``) and a row's list of now lacks was taken out by hand, unless the list is
    empty; the ledger adds to that. ``refresh`` is ``none``, ``labels`` (only the ledger counts) or ``source`` (nothing).
    """
    if refresh not in ("none", "labels", "source"):
        raise ValueError(f"refresh is none, labels or source, not {refresh!r}")
    held = ledger.select(key, "tag").distinct()
    if refresh == "source":
        return held.limit(0)
    if refresh == "labels":
        return held
    now = current.where(F.size(tags) > 0).select(key, F.col(tags).alias("__now"))
    gone = merged.select(key, F.col(tags).alias("__was")).join(now, key).select(key, F.explode(F.array_except("__was", "__now")).alias("tag"))
    return gone.union(held).distinct()


def without_removed(rows: DataFrame, removed: DataFrame, key: str, tags: str = "tags") -> DataFrame:
    """``rows`` without the tags of ``removed(key, tag)``, in their order."""
    each = removed.groupBy(F.col(key).alias("__key")).agg(F.collect_set("tag").alias("__gone"))
    kept = F.filter(tags, lambda x: ~F.array_contains("__gone", x))
    j = rows.join(each, rows[key] == F.col("__key"), "left")
    return j.withColumn(tags, F.when(F.col("__key").isNull(), F.col(tags)).otherwise(kept)).select(*rows.columns)


def answer_edits(answers: DataFrame, key: str, fields: list[str], answer: str = "answer") -> DataFrame:
    """Answers of a review, a JSON object of comma-separated tags by field, as ``add`` edits in the order of ``fields``.

    Other fields and broken JSON give no edit.
    """
    parsed = F.from_json(answer, "map<string,string>")
    listed = [F.transform(F.split(F.coalesce(F.try_element_at(parsed, F.lit(f)), F.lit("")), ","), lambda x: F.trim(x)) for f in fields]
    out = answers.select(key, F.posexplode(F.concat(*listed)).alias("seq", "tag"))
    return out.where("tag <> ''").select(key, F.col("seq").cast("long").alias("seq"), F.lit("add").alias("op"), "tag")
