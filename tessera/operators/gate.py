"""The protected-content gate: quarantines rows before every sink meant for training. It has no switch.

Protected terms are a table of the operator's own; they are matched on raw tags and after normalisation and alias
resolution, before any rule drops or folds a tag. A row flagged by a policy column is quarantined as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import normalize_tag


class GateError(RuntimeError):
    """The gate cannot work, so nothing may pass."""


def protect(rows: DataFrame, terms: DataFrame, aliases: DataFrame | None = None, key: str = "id", tags: str = "tags", policy: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(kept, quarantine)``; quarantine has the key and the rule that matched, never the text.

    ``terms(term)`` must not be empty; ``aliases(alias, canonical)`` are resolved tables. Rows with null tags are held.
    """
    listed = terms.select(F.lower(F.trim("term")).alias("term")).where("term <> ''").distinct()
    if not listed.limit(1).count():
        raise GateError("the table of protected terms is empty")
    raw = rows.select(key, F.explode(tags).alias("tag"))
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.lower("tag"), r"[\s_\\\\]+", " "), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    forms = raw.select(key, F.explode(F.array_distinct(F.array(F.lower("tag"), normalize_tag(F.col("tag")), bare))).alias("form")).distinct()
    if aliases is not None:
        to = aliases.select(F.col("alias").alias("form"), F.lower("canonical").alias("canonical"))
        forms = forms.select(key, "form").union(forms.join(to, "form").select(key, F.col("canonical").alias("form"))).distinct()
    hits = forms.join(listed, F.col("form") == F.col("term"), "left_semi").select(key, F.concat(F.lit("term:"), "form").alias("rule"))
    # a row whose tags are unknown cannot be cleared
    hits = hits.union(rows.where(F.col(tags).isNull()).select(key, F.lit("unreadable").alias("rule")))
    if policy:
        hits = hits.union(rows.where(F.coalesce(F.col(policy).cast("boolean"), F.lit(True))).select(key, F.lit("policy").alias("rule")))
    quarantine = hits.groupBy(key).agg(F.min("rule").alias("rule"))
    # null keys cannot be told apart, so they pass only when no row with a null key is hit
    return rows.join(quarantine, rows[key].eqNullSafe(quarantine[key]), "left_anti"), quarantine


def write_training(rows: DataFrame, path: str, ledger: str, terms: DataFrame, aliases: DataFrame | None = None, key: str = "id", tags: str = "tags", policy: str | None = None) -> None:
    """The writer for everything meant for training: kept rows as Parquet to ``path``, quarantined keys appended to ``ledger``.

    The gate always runs; there is no parameter to pass it. An empty table of terms stops the write.
    """
    kept, held = protect(rows, terms, aliases, key, tags, policy)
    held.write.mode("append").parquet(ledger)
    kept.write.parquet(path)
