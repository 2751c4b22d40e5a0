"""Spellings within an edit distance, by what deletions leave of short names and by segments of long ones.

A short name and a term within the distance leave the same string when each loses at most as many characters as the distance
(FastSS; Bocek, Hunt and Stiller 2007). Such a string is nearly the whole word, so few other pairs share one, however many
words there are; a bitmap of the names' strings keeps most of the terms' from being shuffled.

A long name, of which deletions leave too many strings, is cut in distance + 1 segments of nearly equal length (Pass-Join; Li,
Deng, Wang and Feng 2011). A term within the distance holds at least one of them unchanged, at a place that the two lengths
and the segment's number narrow to a few. So segments and substrings meet in one equi-join, and letter sets rule most pairs out.

Edit distances decide in both. Nothing depends on the first letters of a word. Words are counted in characters; null words take
no part, repeated ones count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.storage import BROADCAST_BYTES, broadcast_if_small, materialize

#: Letters of the longest short name, and the largest distance at which names are short: 79 strings of 12 letters at 2, 299 at 3.
SHORT, SHORT_DISTANCE = 12, 3
#: Of a polynomial hash modulo 2^64; keys that collide cost a comparison.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Words that are in a task's memory with all that deletions leave of them.
ROWS = 4096


def letters(word: str) -> Column:
    """A bit for each of 64 classes of code points; one edit changes at most two."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda a, c: F.when(c == "", a).otherwise(a.bitwiseOR(bit(c))))


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b)).cast("int")


def _place(length: Column, i: Column, parts: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment ``i`` (from 1): the last ones are longer by one where ``parts`` does not divide."""
    short, more = _div(length, parts), length % parts
    before = F.greatest(F.lit(0), i - 1 - (parts - more))
    return (i - 1) * short + before + 1, short + (i > parts - more).cast("int")


def segments(names: DataFrame, name: str, distance: int) -> DataFrame:
    """``names`` once for each segment, with its key ``(n, i, s)``: the name's length, the segment's number and text."""
    parts = distance + 1
    cut = names.withColumn("__n", F.char_length(name)).withColumn("__i", F.explode(F.sequence(F.lit(1), F.lit(parts))))
    at, size = _place(F.col("__n"), F.col("__i"), parts)
    return cut.withColumn("seg", F.struct(F.col("__n").alias("n"), F.col("__i").alias("i"), F.substring(name, at, size).alias("s"))).drop("__n", "__i")


def substrings(terms: DataFrame, term: str, distance: int) -> DataFrame:
    """``terms`` once for each substring at a place where a segment of a name within ``distance`` can be, with the same key."""
    parts = distance + 1
    t = terms.withColumn("__l", F.char_length(term)).withColumn("__n", F.explode(F.sequence(F.greatest(F.lit(0), F.col("__l") - distance), F.col("__l") + distance)))
    t = t.withColumn("__i", F.explode(F.sequence(F.lit(1), F.lit(parts))))
    at, size = _place(F.col("__n"), F.col("__i"), parts)
    i, shift = F.col("__i"), F.col("__l") - F.col("__n")
    # i - 1 edits at most left of the segment, or parts - i right of it
    low = F.greatest(F.lit(1), at - (i - 1), at + shift - (parts - i))
    high = F.least(F.col("__l") - size + 1, at + (i - 1), at + shift + (parts - i))
    t = t.withColumns({"__low": low, "__high": high, "__size": size}).where("__low <= __high").withColumn("__at", F.explode(F.sequence("__low", "__high")))
    key = F.struct(F.col("__n").alias("n"), F.col("__i").alias("i"), F.substring(term, F.col("__at"), F.col("__size")).alias("s"))
    return t.withColumn("seg", key).drop("__l", "__n", "__i", "__low", "__high", "__size", "__at")


def left_over(points: np.ndarray, distance: int) -> np.ndarray:
    """For words of one length, by code points: a hash of each string that up to ``distance`` characters left out leave, a row for a word."""
    n, size = points.shape
    power = np.cumprod(np.full(size + 1, MULTIPLIER), dtype=np.uint64)
    # sums[m][:, k]: of the first k characters, where m before them are left out
    sums = [np.zeros((n, size + 1), np.uint64) for _ in range(distance + 1)]
    for m, s in enumerate(sums):
        np.cumsum((points[:, m:].astype(np.uint64) + np.uint64(1)) * power[: max(0, size - m)], axis=1, out=s[:, m + 1 :])
    out = []
    for m in range(min(distance, size) + 1):
        at = np.array([*combinations(range(size), m)], int)
        begin, end = np.pad(at + 1, ((0, 0), (1, 0))), np.pad(at, ((0, 0), (0, 1)), constant_values=size)
        out.append(sum(sums[i][:, end[:, i]] - sums[i][:, begin[:, i]] for i in range(m + 1)))
    return np.concatenate(out, axis=1) * MULTIPLIER


def deletions(words: DataFrame, word: str, distance: int, bitmap: Broadcast[np.ndarray] | None = None) -> DataFrame:
    """``words`` once for each way to leave out up to ``distance`` characters, with ``key``, a hash of what is left.

    With a ``bitmap`` only keys that it marks are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, ROWS) for i in range(0, len(whole), ROWS)):
                text = b.column(word).to_pylist()
                size = np.fromiter(map(len, text), int, len(text))
                for n in np.unique(size):
                    rows = np.flatnonzero(size == n)
                    points = np.frombuffer("".join(text[i] for i in rows).encode("utf-32-le"), np.uint32).reshape(len(rows), n)
                    key = left_over(points, distance)
                    row, at = (np.ones(key.shape, bool) if bitmap is None else marks(bitmap.value, key)).nonzero()
                    yield pa.RecordBatch.from_arrays([*b.take(pa.array(rows[row])).columns, pa.array(key[row, at].view(np.int64))], [*b.schema.names, "key"])

    return words.mapInArrow(run, StructType([*words.schema.fields, StructField("key", LongType())]))


def marks(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the place that the high bits of a key name is marked; a bitmap has a power of two bytes."""
    spot = key >> np.uint64(64 - (8 * len(bitmap) - 1).bit_length())
    return (bitmap[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap_of(keys: DataFrame, most_bytes: int = BROADCAST_BYTES) -> np.ndarray:
    """A bitmap of 8 to 16 bits for each of ``keys(key)``, fewer beyond ``most_bytes``; it is made in pieces of 4,096 bytes."""
    bits = max(1 << 15, min(1 << (8 * keys.count()).bit_length(), 1 << (8 * most_bytes).bit_length() - 1))
    spot = F.shiftrightunsigned("key", 65 - bits.bit_length()) + 1
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for r in keys.groupBy(F.bitmap_bucket_number(spot).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits")).toLocalIterator():
        out[r["at"] - 1] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _near(t: DataFrame, n: DataFrame, distance: int) -> DataFrame:
    """Different words ``term`` of ``t`` and ``name`` of ``n`` within ``distance`` edits, with the other columns of ``n``, each pair once."""
    short = SHORT if distance <= SHORT_DISTANCE else -1
    long_n = n.where(F.char_length("name") > short).withColumn("ln", letters("name"))
    long_t = t.where(F.char_length("term") > short - distance).withColumn("lt", letters("term"))
    met = substrings(long_t, "term", distance).join(broadcast_if_small(segments(long_n, "name", distance)), "seg")
    met = met.where(F.bit_count(F.col("lt").bitwiseXOR(F.col("ln"))) <= 2 * distance).select("term", *n.columns)
    if short >= 0:
        left = deletions(n.where(F.char_length("name") <= short), "name", distance)
        bitmap = n.sparkSession.sparkContext.broadcast(bitmap_of(left.select("key")))
        asked = deletions(t.where(F.char_length("term") <= short + distance), "term", distance, bitmap)
        met = met.unionByName(asked.join(left.hint("merge"), "key").drop("key"))  # Spark takes left for as small as n
    met = met.where("term <> name").withColumn("distance", F.levenshtein("term", "name", distance)).where("distance >= 0")
    return met.repartition("term").dropDuplicates(["term", "name"])


def near_spellings(terms: DataFrame, term: str, names: DataFrame, name: str, distance: int) -> DataFrame:
    """``(term, name, distance)`` of every two different words within ``distance`` edits."""
    t = terms.select(F.col(term).alias("term")).where("term IS NOT NULL").distinct()
    n = names.select(F.col(name).alias("name")).where("name IS NOT NULL").distinct()
    return _near(t, n, distance).select("term", "name", "distance")


def ratios(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with ``ratio``: twice the matching characters by their length together, as difflib matches them."""

    @F.pandas_udf("double")
    def ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            yield pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(left, right, strict=True)], dtype=float)

    return pairs.withColumn("ratio", ratio(a, b))


def suggestions(terms: DataFrame, vocab: DataFrame, least_posts: int, distance: int, top: int = 3, prefix: int = 0, least_ratio: float | None = None) -> DataFrame:
    """``(term, name, distance, r)``: the ``top`` nearest names with ``least_posts``, by distance, then count and name.

    ``prefix`` letters must agree, if not 0. With ``least_ratio`` pairs are judged and ranked by their ratio, column ``ratio``.
    """
    v = vocab.where((F.col("posts") >= least_posts) & F.col("name").isNotNull()).groupBy("name").agg(F.max("posts").alias("posts"))
    near = _near(terms.select("term").where("term IS NOT NULL").distinct(), v, distance)
    if prefix:
        near = near.where(F.substring("term", 1, prefix) == F.substring("name", 1, prefix))
    first, more = [F.col("distance")], []
    if least_ratio is not None:
        near, first, more = ratios(near, "term", "name").where(F.col("ratio") >= least_ratio), [F.desc("ratio")], ["ratio"]
    r = F.row_number().over(Window.partitionBy("term").orderBy(*first, F.desc("posts"), "name"))
    return near.withColumn("r", r).where(F.col("r") <= top).select("term", "name", "distance", "r", *more)


def suffix_families(heads: DataFrame, vocab: DataFrame, least_posts: int, top: int = 5, head: str = "head", letters_of_head: int = 3) -> DataFrame:
    """``(head, name, posts, r)``: for a word with a suffix (what follows its first space or hyphen), the popular names that end in it.

    Names that hold the first ``letters_of_head`` letters of the word come first, then by count and name; a word is no
    suggestion for itself. A word without a space or hyphen has no suffix. Words with the same suffix and first letters share
    their candidates: of the names of a suffix that hold the letters, by an index of their substrings, and of all its names
    only the first few are kept, so no pair of a word and a name is made beyond ``top`` + 1 a word.
    """
    tails = lambda c: F.array_distinct(F.filter(F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.char_length(c))), lambda i: F.when(F.substring(c, i - 1, F.lit(1)).isin(" ", "-"), F.substring(c, i, F.char_length(c)))), lambda s: s.isNotNull() & (s != "")))
    names = vocab.where((F.col("posts") > least_posts) & F.col("name").isNotNull()).groupBy("name").agg(F.max("posts").alias("posts"))
    index = names.select("name", "posts", F.explode(tails("name")).alias("tail"))
    asked = heads.select(F.col(head).alias("head")).where("head IS NOT NULL").distinct()
    asked = asked.withColumn("tail", F.get(tails("head"), F.lit(0))).where("tail IS NOT NULL").withColumn("part", F.substring("head", 1, letters_of_head))
    asked = materialize(asked, "heads")
    groups = asked.select("tail", "part").distinct()
    sizes = [r.n for r in groups.select(F.char_length("part").alias("n")).distinct().collect()]  # at most letters_of_head + 1
    cut = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length("name") - n + 1)), lambda i: F.substring("name", i, F.lit(n)))
    parts = F.array_distinct(F.concat(*map(cut, sizes or [0])))
    order = [F.desc("posts"), "name"]
    named = F.array_sort(F.collect_list(F.struct((-F.col("posts")).alias("p"), "name", "posts")))

    def first(rows: DataFrame, keys: list[str], most: int, out: str) -> DataFrame:
        r = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn("r", r).where(F.col("r") <= most).groupBy(*keys).agg(named.alias(out))

    # one more than top, as a word may be a name of its own; each holds its own first letters
    like = first(index.select("tail", "posts", "name", F.explode(parts).alias("part")).join(groups, ["tail", "part"], "left_semi"), ["tail", "part"], top + 1, "like")
    common = first(index.join(groups.select("tail").distinct(), "tail", "left_semi"), ["tail"], 2 * top, "common")
    found = groups.join(common, "tail").join(like, ["tail", "part"], "left")
    rest = F.filter("common", lambda x: ~x["name"].contains(F.col("part")))
    found = found.select("tail", "part", F.slice(F.concat(F.coalesce("like", F.array().cast(dict(like.dtypes)["like"])), rest), 1, top + 1).alias("found"))
    met = asked.join(found, ["tail", "part"]).select("head", F.slice(F.filter("found", lambda x: x["name"] != F.col("head")), 1, top).alias("found"))
    return met.select("head", F.posexplode("found").alias("r", "x")).select("head", "x.name", "x.posts", (F.col("r") + 1).alias("r"))
