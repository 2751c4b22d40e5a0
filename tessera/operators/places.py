"""Words of rows folded inside each row, and joins in which frequent words are broadcast, so that few of them are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import words
from tessera.storage import BROADCAST_BYTES, row_bytes


def word_places(rows: DataFrame, key: str, words: Column) -> DataFrame:
    """``(key, raw, pos, n)``: every different word of a row once, with its first place (from 0) and its number in the row.

    Rows with equal keys are folded each for itself. Rows without words are left out. Nothing is shuffled.
    """
    kind = dict(rows.dtypes)[key]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = b.column("w")
            if not len(w):
                continue
            row, raw = pc.list_parent_indices(w), pc.list_flatten(w)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(w), 0).to_numpy())
            at = np.arange(len(raw)) - (ends - np.diff(ends, prepend=0))[row.to_numpy()]
            t = pa.table({"row": row, "raw": raw, "pos": pa.array(at, pa.int32())}).group_by(["row", "raw"], use_threads=False).aggregate([("pos", "min"), ("pos", "count")])
            t = pa.table({key: b.column(key).take(t["row"].combine_chunks()), "raw": t["raw"], "pos": t["pos_min"], "n": t["pos_count"]})
            yield from t.to_batches()

    return rows.select(F.col(key), words.alias("w")).mapInArrow(fold, f"`{key}` {kind}, raw string, pos int, n long")


def word_counts(rows: DataFrame, text: str) -> DataFrame:
    """``(raw, n)``: how often each word of ``functions.text.words`` is in all texts.

    What stands between blanks is counted inside batches of rows, before it is lower-cased and cut at other white space.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = pc.value_counts(pc.list_flatten(pc.split_pattern(b.column(0), " ")))
            yield pa.RecordBatch.from_arrays([v.field("values"), v.field("counts")], ["raw", "n"])

    parts = rows.select(text).mapInArrow(count, "raw string, n long")
    return parts.select(F.explode(words(F.col("raw"))).alias("raw"), "n").groupBy("raw").agg(F.sum("n").alias("n"))


def join_common(rows: DataFrame, table: DataFrame, on: str, weight: str, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` joined with ``table`` on one column. The heaviest values, as many as fit, are broadcast; only the rows of others are shuffled.

    A value has one weight, whatever rows of ``table`` it has. Both are written tables, as each is read more than once. The least weight that is broadcast is a power of two, from a count by powers.
    """
    power = F.floor(F.log2(F.greatest(F.col(weight).cast("double"), F.lit(1.0)))).cast("int")
    counts = sorted(((r.p, r.n) for r in table.groupBy(power.alias("p")).agg(F.count("*").alias("n")).collect()), key=lambda c: -(-1 if c[0] is None else c[0]))  # at most 64 rows
    left, least = most_bytes // row_bytes(table), None
    for p, n in counts:
        if p is None or n > left:
            break
        left, least = left - n, p
    else:
        return rows.join(F.broadcast(table), on)
    if least is None:
        return rows.join(table, on)
    heavy = F.coalesce(power >= least, F.lit(False))
    common = table.where(heavy)
    rare = rows.join(F.broadcast(common.select(on).distinct()), on, "left_anti").join(table.where(~heavy), on)
    return rows.join(F.broadcast(common), on).unionByName(rare)
