"""Screens and checks of single rows: reasons, issues, severities, conflicts, gaps, slots, and the reports over them.

Rules are given as columns and small Python tables. A rule whose condition is null does not fire.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reasons(rules: dict[str, Column]) -> Column:
    """The names of the rules that fire, in the order of the table."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()])) if rules else F.array().cast("array<string>")


def counted(name: str, n: Column) -> Column:
    """An issue with its figure: ``name(n)``."""
    return F.concat(F.lit(f"{name}("), n.cast("string"), F.lit(")"))


def decide(found: Column, keep: str = "keep") -> Column:
    """The first reason, else ``keep``."""
    return F.coalesce(F.get(found, 0), F.lit(keep))


def first_class(rules: list[tuple[str, Column]], other: str) -> Column:
    """The class of the first rule that holds."""
    out = F.lit(other)
    for name, c in reversed(rules):
        out = F.when(c, name).otherwise(out)
    return out


def ratio_gate(ratio: Column, steps: list[tuple[str, float, bool]], other: str) -> Column:
    """The first step ``(name, limit, strict)`` that the ratio passes; strict steps lie above their limit."""
    return first_class([(name, ratio > limit if strict else ratio >= limit) for name, limit, strict in steps], other)


def severity(issues: Column, errors: list[str]) -> Column:
    """Empty without issues, error if an issue is of a kind in ``errors`` (figures aside), else warn."""
    kind = F.transform(issues, lambda e: F.substring_index(e, "(", 1))
    return F.when(F.size(issues) == 0, "").when(F.arrays_overlap(kind, F.array(*map(F.lit, errors))), "error").otherwise("warn")


def issue_kinds(rows: DataFrame, issues: str) -> DataFrame:
    """``(kind, n)`` over all issues, figures aside."""
    kinds = rows.select(F.explode(issues).alias("x")).select(F.substring_index("x", "(", 1).alias("kind"))
    return kinds.groupBy("kind").agg(F.count("*").alias("n"))


def verify_report(rows: DataFrame, by: str, issues: str, errors: list[str]) -> DataFrame:
    """Rows and issues by ``by`` and severity."""
    s = severity(F.col(issues), errors).alias("severity")
    return rows.groupBy(by, s).agg(F.count("*").alias("n"), F.sum(F.size(issues)).alias("issues"))


def _names(names) -> Column:
    return F.array(*map(F.lit, names))


def conflicts(tags: Column, families: dict[str, tuple[list[str], list[str]]]) -> Column:
    """The families ``(members, excuses)`` of which two members or more are present and no excuse is."""
    rules = {}
    for name, (members, excuses) in families.items():
        many = F.size(F.array_intersect(tags, _names(members))) >= 2
        rules[name] = many & ~F.arrays_overlap(tags, _names(excuses)) if excuses else many
    return reasons(rules)


def family_counts(rows: DataFrame, ident: str, found: Column) -> DataFrame:
    """``(family, rows)``: how many rows have a conflict of each family."""
    f = rows.select(ident, F.explode(F.array_distinct(found)).alias("family")).distinct()
    return f.groupBy("family").agg(F.count(ident).alias("rows"))


def gaps(tags: Column, needed: dict[str, list[str]]) -> Column:
    """The groups of which no member is present."""
    return reasons({name: ~F.arrays_overlap(tags, _names(members)) for name, members in needed.items()})


def two_of(tags: Column, family: list[str], marker: str) -> Column:
    """Whether ``marker`` is implied: two of the family are there and it is not."""
    return (F.size(F.array_intersect(tags, _names(family))) >= 2) & ~F.array_contains(tags, F.lit(marker))


def fold_heads(tags: Column, folds: dict[str, list[str]]) -> Column:
    """``tags`` without the heads of which a more exact sibling is present."""
    out = tags
    for head, siblings in folds.items():
        out = F.when(F.arrays_overlap(tags, _names(siblings)), F.array_remove(out, F.lit(head))).otherwise(out)
    return out


def residue(rows: DataFrame, ident: str, tag: str, unwanted: Column, shown: int = 4) -> DataFrame:
    """``(ident, residue)``: the distinct unwanted tags of each row in name order, ``shown`` of them and the number of the others."""
    r = rows.where(unwanted).groupBy(ident).agg(F.array_sort(F.collect_set(tag)).alias("r"))
    more = F.when(F.size("r") > shown, F.concat(F.lit("|+"), (F.size("r") - shown).cast("string"))).otherwise("")
    return r.select(ident, F.concat(F.array_join(F.slice("r", 1, shown), "|"), more).alias("residue"))


def prefer_side(tags: DataFrame, ident: str, side: str, better: str) -> DataFrame:
    """Rows of ``better``, rows of an unknown side, and the others of those idents that have nothing of ``better``."""
    best = tags.where(F.col(side) == better).select(ident).distinct().withColumn("__best", F.lit(True))
    j = tags.join(best, ident, "left")
    return j.where(F.col(side).isNull() | (F.col(side) == better) | F.col("__best").isNull()).select(*tags.columns)


def downgrade_value(text: Column, tails: dict[str, str], other: Column) -> Column:
    """The value of the longest run of last words that ``tails`` knows, else ``other``."""
    table = F.create_map(*[F.lit(x) for kv in tails.items() for x in kv])
    w = F.split(text, " ")
    runs = F.transform(F.sequence(F.lit(1), F.size(w)), lambda i: F.array_join(F.slice(w, i, F.size(w)), " "))
    return F.coalesce(F.try_element_at(table, F.get(F.filter(runs, lambda x: F.map_contains_key(table, x)), 0)), other)
