"""Counts of tags against a vocabulary. Occurrences are folded to distinct tags before any join, so no common tag meets in one task.

A null tag is a tag that no vocabulary holds. Where a column ``n`` is named, ``tags`` are folded and hold the number of each tag, more than
once if need be; with ``forms(tag, form, n)``, both written, they are spellings of the tags in its column ``form``, and are judged
by it: frequent ones are broadcast, and only the rare ones of a row are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.places import join_common
from tessera.storage import materialize


def _folded(tags: DataFrame, ident: str, tag: str, n: str | None = None) -> DataFrame:
    return tags.groupBy(ident, tag).agg(F.count("*").alias("__n")) if n is None else tags.select(ident, tag, F.col(n).alias("__n"))


def _judged(tags: DataFrame, ident: str, tag: str, n: str | None, forms: DataFrame | None, form: str | None, verdict: DataFrame, out: list[str]) -> DataFrame:
    """Folded tags with the columns ``out`` of ``verdict``, null where it lacks the tag (its column ``__t``)."""
    f = _folded(tags, ident, tag, n)
    if forms is None:
        return f.join(verdict, F.col(tag) == F.col("__t"), "left").select(ident, tag, "__n", *out)
    table = forms.select(tag, F.col(form).alias("__form"), F.col("n").alias("__w")).join(verdict, F.col("__form") == F.col("__t"), "left")
    return join_common(f, materialize(table.select(tag, "__w", *out), "judged"), tag, "__w").select(ident, tag, "__n", *out)


def drop_rare(tags: DataFrame, ident: str, tag: str, least: int, n: str | None = None, forms: DataFrame | None = None, form: str | None = None) -> DataFrame:
    """``(ident, n, dropped)``: the occurrences of each row and those of tags with fewer than ``least`` in the whole table."""
    counted = _folded(tags, ident, tag, n).groupBy(F.col(tag).alias("__t")).agg(F.sum("__n").alias("__c")) if forms is None else forms.groupBy(F.col(form).alias("__t")).agg(F.sum("n").alias("__c"))
    low = counted.where((F.col("__c") < least) & F.col("__t").isNotNull()).select("__t", F.lit(True).alias("__low"))
    j = _judged(tags, ident, tag, n, forms, form, low, ["__low"])
    return j.groupBy(ident).agg(F.sum("__n").alias("n"), F.sum(F.when(F.col("__low"), F.col("__n")).otherwise(0)).alias("dropped"))


def residue_top(tags: DataFrame, tag: str, known: DataFrame, name: str, top: int) -> DataFrame:
    """The ``top`` tags that are not known (the bound is the report's), by count and name."""
    n = tags.groupBy(tag).agg(F.count("*").alias("n"))
    return n.join(known.select(F.col(name).alias(tag)), tag, "left_anti").orderBy(F.desc("n"), tag).limit(top)


def vocabulary_audit(tags: DataFrame, tag: str, vocab: DataFrame, rare: int) -> DataFrame:
    """One row: distinct tags, those the vocabulary lacks, and those with fewer than ``rare`` posts."""
    v = vocab.select(F.col("name").alias(tag), "posts", F.lit(True).alias("__k"))
    j = tags.select(tag).distinct().join(v, tag, "left")
    return j.agg(F.count("*").alias("distinct_tags"), F.count(F.when(F.col("__k").isNull(), 1)).alias("unknown"), F.count(F.when(F.col("posts") < rare, 1)).alias("rare"))


def dictionary_check(tags: DataFrame, ident: str, tag: str, vocab: DataFrame, aliases: DataFrame, reserved: list[str], least: int, zero: int = 2, n: str | None = None, forms: DataFrame | None = None, form: str | None = None) -> DataFrame:
    """``(kind, tags, docs)``: distinct tags and rows by kind - reserved, exists, zero (fewer than ``zero`` posts), alias, missing."""
    v, a = vocab.select(F.col("name").alias("__t"), "posts"), aliases.select(F.col("alias").alias("__t"), F.lit(True).alias("__a"))
    kind = F.when(F.col("__t").isin(reserved), "reserved").when(F.col("posts") >= least, "exists").when(F.col("posts") < zero, "zero").when(F.col("__a"), "alias").otherwise("missing")
    every = (tags.select(F.col(tag).alias("__t")) if forms is None else forms.select(F.col(form).alias("__t"))).distinct()
    kinds = materialize(every.join(v, "__t", "left").join(a, "__t", "left").select("__t", kind.alias("kind")), "kinds")
    counted = kinds.groupBy("kind").agg(F.count("__t").alias("tags"))
    j = _judged(tags, ident, tag, n, forms, form, kinds, ["kind"]).where("kind IS NOT NULL")
    docs = j.select(ident, "kind").distinct().groupBy("kind").agg(F.count(ident).alias("docs"))
    return counted.join(docs, "kind").select("kind", "tags", "docs")


def kept_by_category(tags: DataFrame, ident: str, tag: str, vocab: DataFrame, drop: list[int], keep: list[str], n: str | None = None, forms: DataFrame | None = None, form: str | None = None) -> DataFrame:
    """``(ident, kept)``: occurrences that are not of a dropped category, or are named in ``keep``; rows that keep nothing are left out."""
    out = vocab.where(F.col("category").isin(drop) & ~F.col("name").isin(keep)).select(F.col("name").alias("__t"), F.lit(True).alias("__out"))
    j = _judged(tags, ident, tag, n, forms, form, out, ["__out"])
    return j.where("__out IS NULL").groupBy(ident).agg(F.sum("__n").alias("kept"))


def gated_drops(tags: DataFrame, ident: str, tag: str, vocab: DataFrame, always: str, unknown: str) -> DataFrame:
    """``(ident, tag, n)``: tags that fit ``always``, or fit ``unknown`` and are in no vocabulary."""
    f = _folded(tags, ident, tag).where(F.col(tag).rlike(always) | F.col(tag).rlike(unknown))
    j = f.join(vocab.select(F.col("name").alias(tag), F.lit(True).alias("__k")), tag, "left")
    return j.where(F.col(tag).rlike(always) | F.col("__k").isNull()).select(ident, tag, F.col("__n").alias("n"))


def slot_counts(tags: DataFrame, tag: str, vocab: DataFrame, slot: Column) -> DataFrame:
    """``(slot, n)`` over all occurrences; ``slot`` is an expression over the tag and ``category``."""
    n = tags.groupBy(tag).agg(F.count("*").alias("__n")).join(vocab.select(F.col("name").alias(tag), "category"), tag, "left")
    return n.groupBy(slot.alias("slot")).agg(F.sum("__n").alias("n"))


def canonical_forms(tags: DataFrame, tag: str, known: DataFrame, forms: list) -> DataFrame:
    """``(tag, canonical)`` of unknown tags: the first of the ``forms`` (functions of a column) that is known and differs."""
    names = known.select(F.col("name").alias("cand")).distinct()
    miss = tags.select(tag).distinct().join(names, F.col(tag) == F.col("cand"), "left_anti")
    c = miss.select(tag, F.posexplode(F.array(*[f(F.col(tag)) for f in forms])).alias("prio", "cand"))
    c = c.where(F.col("cand") != F.col(tag)).join(names, "cand", "left_semi")
    return c.groupBy(tag).agg(F.min_by("cand", "prio").alias("canonical"))


def implied_present(tags: DataFrame, ident: str, tag: str, parents: DataFrame) -> DataFrame:
    """``(ident, folded)``: how many distinct tags of a row another of its tags implies; ``parents(name, parent)``."""
    have = tags.select(ident, tag).distinct()
    up = have.join(parents.where("parent IS NOT NULL").select(F.col("name").alias(tag), "parent"), tag).select(ident, F.col("parent").alias(tag)).distinct()
    return have.join(up, [ident, tag], "left_semi").groupBy(ident).agg(F.count("*").alias("folded"))
