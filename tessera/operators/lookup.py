"""Lookups of rows against other tables: pairing, provenance, cascades of keys, former names, plans of derived artifacts.

Keys that are null match nothing. A side that must have one row a key is folded by an aggregation before it is joined, so a
key that holds a third of all rows is combined before the shuffle; the joins are plain equi-joins that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(rows: DataFrame, notes: DataFrame, key: str, value: str, default) -> DataFrame:
    """``rows`` with the ``value`` that ``notes`` has for their key, ``default`` where it has none or a null."""
    return rows.join(notes.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def pair_status(assets: DataFrame, captions: DataFrame, key: str, empty: Column) -> DataFrame:
    """``(key, status)`` of every key of either side: ok, missing (no caption), orphan (no asset) or empty.

    ``empty`` is a condition over ``captions``; where it is null the caption counts as filled. One row a pair.
    """
    a = assets.select(key, F.lit(True).alias("__a"))
    c = captions.select(key, F.lit(True).alias("__c"), F.coalesce(empty, F.lit(False)).alias("__e"))
    status = F.when(F.col("__a").isNull(), "orphan").when(F.col("__c").isNull(), "missing").when(F.col("__e"), "empty").otherwise("ok")
    return a.join(c, key, "full_outer").select(key, status.alias("status"))


def trace_origin(rows: DataFrame, link: str, files: DataFrame, file_key: str, parent: str, posts: DataFrame, post_key: str) -> DataFrame:
    """``rows`` with ``origin``: ``A+`` where the linked file's post is known, ``A`` where only the file is, else ``none``.

    ``files`` and ``posts`` have one row a key.
    """
    f = files.select(F.col(file_key).alias("__f"), F.col(parent).alias("__p"))
    p = posts.select(F.col(post_key).alias("__q"))
    j = rows.join(f, F.col(link) == F.col("__f"), "left").join(p, F.col("__p") == F.col("__q"), "left")
    origin = F.when(F.col("__q").isNotNull(), "A+").when(F.col("__f").isNotNull(), "A").otherwise("none")
    return j.withColumn("origin", origin).drop("__f", "__p", "__q")


def cascade_match(rows: DataFrame, catalog: DataFrame, ident: str, keys: list[tuple[str, str]]) -> DataFrame:
    """``rows`` with ``by`` and ``ref``: the first key of ``(name, column)`` that the catalog knows decides.

    One holder in the catalog is a match; more than one is ``ambiguous`` and no later key is asked; nothing is ``none``.
    """
    by, ref = F.lit("none"), F.lit(None)
    for i, (_, c) in enumerate(keys):
        hits = catalog.where(F.col(c).isNotNull()).groupBy(c).agg(F.min(ident).alias(f"__r{i}"), F.count("*").alias(f"__n{i}"))
        rows = rows.join(hits, c, "left")
    for i, (name, _) in reversed(list(enumerate(keys))):
        n = F.col(f"__n{i}")
        by = F.when(n == 1, name).when(n > 1, "ambiguous").otherwise(by)
        ref = F.when(n == 1, F.col(f"__r{i}")).when(n > 1, None).otherwise(ref)
    return rows.withColumns({"by": by, "ref": ref}).drop(*[f"__{x}{i}" for i in range(len(keys)) for x in "rn"])


def fallback_match(rows: DataFrame, first: DataFrame, second: DataFrame, keys: tuple[str, str], ident: str) -> DataFrame:
    """``rows`` with ``match``, the least ``ident`` of ``first`` with the same first key, else of ``second`` with the same second
    key, and ``by_second``: whether the first key found nothing."""
    one = first.groupBy(keys[0]).agg(F.min(ident).alias("__one"))
    two = second.groupBy(keys[1]).agg(F.min(ident).alias("__two"))
    j = rows.join(one, keys[0], "left").join(two, keys[1], "left")
    return j.withColumns({"match": F.coalesce("__one", "__two"), "by_second": F.col("__one").isNull()}).drop("__one", "__two")


def current_name(rows: DataFrame, name: str, entities: DataFrame, entity: str, former: str) -> DataFrame:
    """``rows`` with ``current``: their own name if an entity has it, else the least entity that lists it in the array ``former``."""
    own = entities.select(F.col(entity).alias(name), F.col(entity).alias("__own")).distinct()
    old = entities.select(F.explode(former).alias(name), entity).groupBy(name).agg(F.min(entity).alias("__old"))
    j = rows.join(own, name, "left").join(old, name, "left")
    return j.withColumn("current", F.coalesce("__own", "__old")).drop("__own", "__old")


def processed_keys(log: DataFrame, keys: list[Column], decision: Column) -> DataFrame:
    """``(k, decision)``: every key of a processed row, once; rows without a decision were not processed."""
    k = log.where(decision.isNotNull()).select(F.explode(F.array(*keys)).alias("k"), decision.alias("decision"))
    return k.where("k IS NOT NULL").distinct()


def clashing(names: DataFrame, taken: DataFrame, name: str) -> DataFrame:
    """The names that both tables have, once each."""
    return names.select(name).where(F.col(name).isNotNull()).distinct().join(taken.select(name).distinct(), name, "left_semi")


def artifact_plan(sources: DataFrame, artifacts: DataFrame, key: str, fresh: Column) -> DataFrame:
    """``(key, plan)``: build what has no artifact, skip what is ``fresh``, rebuild the rest, prune what has no source.

    ``fresh`` is a condition over the columns of both; null counts as not fresh. One row a key on each side.
    """
    j = sources.withColumn("__s", F.lit(True)).join(artifacts.withColumn("__a", F.lit(True)), key, "full_outer")
    plan = F.when(F.col("__s").isNull(), "prune").when(F.col("__a").isNull(), "build").when(fresh, "skip").otherwise("rebuild")
    return j.select(key, plan.alias("plan"))


def value_diff(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, op)`` of the keys whose value differs: ``-`` only before, ``+`` only after, else changed. One row a key a side."""
    a, b = before.select(key, F.lit(True).alias("__a"), F.col(value).alias("__v")), after.select(key, F.lit(True).alias("__b"), F.col(value).alias("__w"))
    j = a.join(b, key, "full_outer")
    op = F.when(F.col("__b").isNull(), "-").when(F.col("__a").isNull(), "+").when(~F.col("__v").eqNullSafe(F.col("__w")), "changed")
    return j.select(key, op.alias("op")).where("op IS NOT NULL")


def equal_but(a: Column, b: Column, volatile: str) -> Column:
    """Whether two texts are equal once all that fits the pattern ``volatile`` is taken out of both; nulls equal each other."""
    return F.regexp_replace(a, volatile, "").eqNullSafe(F.regexp_replace(b, volatile, ""))
