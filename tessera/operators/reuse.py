"""Reuse of results: a result is stored under what it was made from, and found again while inputs and parameters are equal.

A table is known by an order-independent fingerprint of its rows as a multiset: their number and sums of hashes. It is one
partial aggregate, and fingerprints of parts add up, so a part that did not change need not be read again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Two 64-bit hashes are summed in three pieces of 21 bits each: a sum of longs holds 2^42 rows.
SEEDS, BITS = (42, 7919), 21
PIECES = [f"s{i}" for i in range(3 * len(SEEDS))]
FLAT = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "binary", "decimal", "char", "varchar")


def row_hashes(rows: DataFrame, columns: list[str]) -> list[Column]:
    """A hash of ``columns`` for each seed; nulls count, also inside nested values, which are hashed as JSON."""
    kinds = dict(rows.dtypes)
    value = lambda c: F.col(c) if kinds[c].startswith(FLAT) else F.to_json(F.struct(c), {"ignoreNullFields": "false"})
    values = [x for c in columns for x in (F.col(c).isNull(), value(c))]
    return [F.xxhash64(F.lit(seed), *values) for seed in SEEDS]


def fingerprint(rows: DataFrame, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """``(by..., n_rows, s0 ... s5)`` of the rows of each group, or one row for all; two groups with equal rows have equal ones.

    The order of rows and their partitions do not matter, repeats and nulls do. Without ``columns`` all others than ``by`` count,
    in the order of the table. Rows of no table have zeros.
    """
    columns = columns or [c for c in rows.columns if c not in (by or [])]
    mask = F.lit((1 << BITS) - 1).cast("long")
    parts = [F.shiftrightunsigned(h, i * BITS).bitwiseAND(mask) for h in row_hashes(rows, columns) for i in range(3)]
    sums = [F.coalesce(F.sum(p), F.lit(0)).alias(n) for p, n in zip(parts, PIECES, strict=True)]
    return rows.groupBy(*(by or [])).agg(F.count("*").alias("n_rows"), *sums)


def merge(fingerprints: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The fingerprints of the unions of the groups' rows."""
    return fingerprints.groupBy(*(by or [])).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ["n_rows", *PIECES]])


def unchanged(now: DataFrame, then: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """``(by..., unchanged)`` of every group of ``now`` and ``then``: whether it holds the same rows, each as often."""
    a, b = fingerprint(now, columns, by), fingerprint(then, columns, by)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ["n_rows", *PIECES]]
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    both = a.alias("a").join(b.alias("b"), _all(on), "full")
    return both.select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in by], _all(same).alias("unchanged"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def result_key(stage: str, inputs: dict[str, DataFrame], params: dict) -> str:
    """The digest of a stage's name, its parameters, and names, types and rows of its inputs; one row an input is read."""
    known = {name: [rows.dtypes, list(fingerprint(rows).first())] for name, rows in inputs.items()}
    return hashlib.sha256(json.dumps([stage, params, known], sort_keys=True).encode()).hexdigest()


def stored(spark: SparkSession, folder: str, stage: str, inputs: dict[str, DataFrame], params: dict, compute: Callable[..., DataFrame], removed: dict[str, DataFrame] | None = None) -> tuple[DataFrame, bool]:
    """``(result, reused)``: the stored result of equal inputs and parameters, or that of ``compute(**inputs, **params)``, now stored.

    ``removed`` has rows that an earlier use of the result took out of an input; they count as if they were still there, so
    applying a result does not make it stale. The result is written first and becomes known by the renaming of a small
    pointer, so a reader sees a whole result or none; of two writers at once the first one's stays. A pointer whose result
    is incomplete or gone is replaced. Parameters must be JSON values.
    """
    was = {name: rows.unionByName(removed[name]) if removed and name in removed else rows for name, rows in inputs.items()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    pointer = path(f"{folder}/keys/{result_key(stage, was, params)}")
    store = pointer.getFileSystem(spark._jsc.hadoopConfiguration())

    def known() -> DataFrame | None:
        if not store.exists(pointer):
            return None
        at = spark.read.text(pointer.toString()).first()
        return spark.read.parquet(at[0]) if at and store.exists(path(f"{at[0]}/_SUCCESS")) else None

    found = known()
    if found is not None:
        return found, True
    result = f"{folder}/results/{stage}-{uuid.uuid4().hex}"
    compute(**was, **params).write.parquet(result)
    draft = path(f"{folder}/drafts/{uuid.uuid4().hex}")
    out = store.create(draft, True)
    out.writeBytes(result)
    out.close()
    store.mkdirs(pointer.getParent())
    if store.exists(pointer) and known() is None:
        store.delete(pointer, False)
    if store.exists(pointer) or not store.rename(draft, pointer):
        store.delete(draft, False)
        other = known()
        if other is not None:
            return other, False
    return spark.read.parquet(result), False
