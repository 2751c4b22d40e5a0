"""Nested JSON objects as dotted keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.storage import materialize


def flatten_leaves(rows: DataFrame, key: str, json: str) -> DataFrame:
    """``(key, path, value)`` of every leaf: a scalar as text, a list as JSON, null and an empty object as null.

    One round for each level of the deepest object; null and broken JSON, and what is no object, have no leaves.
    """
    inner = "startswith(schema_of_variant(e.value), 'OBJECT<')"
    level = rows.select(F.col(key).alias("key"), F.lit(None).cast("string").alias("path"), F.col(json).alias("json"))
    out = None
    while True:
        # the outer object of a list or scalar gives no entry with a key
        found = level.sparkSession.sql(
            "SELECT t.key AS key, concat_ws('.', t.path, e.key) AS path, "
            f"CASE WHEN {inner} THEN to_json(e.value) END AS json, "
            f"CASE WHEN schema_of_variant(e.value) LIKE 'ARRAY%' THEN to_json(e.value) WHEN NOT {inner} THEN CAST(e.value AS string) END AS value "
            "FROM {t} t, LATERAL variant_explode(try_parse_json(t.json)) e WHERE e.key IS NOT NULL",
            t=level,
        )
        found = materialize(found, "leaves")
        here = found.where("json IS NULL OR json = '{}'").select(F.col("key").alias(key), "path", "value")
        out = here if out is None else out.union(here)
        level = found.where("json <> '{}'").select("key", "path", "json")
        if not level.limit(1).count():
            return out
