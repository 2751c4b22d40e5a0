"""URL filters: exact membership of listed keys by a cascade of Bloom filters.

Level 1 encodes the listed keys, level 2 the keys of the corpus that level 1 takes wrongly, level 3 the listed keys
that level 2 takes wrongly, and so on until a level takes nothing wrongly. As the filters were built over the complete
set of keys of the corpus, a key's answer (the parity of the first level that refuses it) is exact, without a join.

Null urls and urls without ``://`` have an empty host and path and no keys; urls of any length are read whole. Repeated
rows and null ids keep their rows, an empty table gives none, other columns are not touched. Filters are the only broadcast
data: ``max_bits`` bounds each level, more keys than that serves are spread over several cascades by key hash, and the whole
takes about 1.44 * log2(universe / listed) + 10 bits for a listed key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.storage import materialize

SEEDS = (17, 91)


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; empty for null or no ``://``."""
    part = lambda i: F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)([^?#]*)", i), F.lit(""))
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def split_rule(rule: str) -> tuple[str, str]:
    """``example.net/en/`` is host ``example.net`` and path ``/en/``."""
    host, slash, path = rule.partition("/")
    return host, slash + path


def candidate_keys(host: Column, path: Column, rules: list[str]) -> Column:
    """Every key that could be one of ``rules``: host suffixes by label count, path prefixes by length, longest first."""
    shapes = sorted({(h.count(".") + 1, len(p)) for h, p in map(split_rule, rules)}, reverse=True)
    labels = F.split(host, r"\.", -1)

    def key(n: int, size: int) -> Column:
        suffix = F.concat_ws(".", F.slice(labels, -n, n))
        return F.when((F.size(labels) >= n) & (F.char_length(path) >= size), F.concat(suffix, F.substring(path, 1, size)))

    return F.array_compact(F.array(*[key(n, size) for n, size in shapes]))


def positions(key: str, bits: int, hashes: int) -> Column:
    """Bit positions of a key by double hashing."""
    h1, h2 = (F.shiftrightunsigned(F.xxhash64(F.lit(s), F.col(key)), 2) for s in SEEDS)
    return F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda i: F.pmod(h1 % bits + i * (h2 % bits), F.lit(bits)))


def bits_for(n: int, rate: float) -> int:
    """Bits of a Bloom filter of ``n`` keys that takes other keys wrongly at ``rate``."""
    return int(-n * np.log(rate) / np.log(2) ** 2)


def build_bloom(keys: DataFrame, rate: float, max_bits: int, level: int = 0) -> tuple[np.ndarray, int]:
    """A Bloom filter of ``keys(key)`` as 64-bit words and its number of hashes; the bits are set by an aggregation.

    Levels differ in length, so that keys which share their bits on one level part on another.
    """
    n = max(keys.count(), 1)
    bits = min(max_bits // 64 * 64, max(1024, -(-bits_for(n, rate) // 64) * 64)) + 64 * level
    hashes = max(1, min(32, round(bits / n * np.log(2))))
    spot = keys.select(F.explode(positions("key", bits, hashes)).alias("p"))
    words = spot.groupBy((F.col("p") / 64).cast("long").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b"))
    out = np.zeros(bits // 64, np.int64)
    for w, b in words.toLocalIterator():  # at most bits / 64 rows
        out[w] = b
    return out, hashes


def in_bloom(words: np.ndarray, hashes: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    bits = np.int64(len(words) * 64)
    hit = np.ones(len(h1), bool)
    for i in range(hashes):
        p = (h1 % bits + i * (h2 % bits)) % bits
        hit &= (words[p >> 6] >> (p & 63)) & 1 == 1
    return hit


def refused_at(levels: list, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The first level that refuses each key; the number of levels if none does."""
    at = np.full(len(h1), len(levels), np.int64)
    open_ = np.arange(len(h1))
    for k, (words, hashes) in enumerate(levels):
        hit = in_bloom(words, hashes, h1[open_], h2[open_])
        at[open_[~hit]] = k
        open_ = open_[hit]
    return at


class Cascade:
    """Exact membership of ``listed(key)`` among the keys of ``universe(key)`` and the listed keys themselves.

    Level 1 takes about as many other keys wrongly as there are listed ones, however large the universe is, so the levels
    after it stay as small; ``rate`` is the most it may take and the rate of the later levels.
    """

    def __init__(self, universe: DataFrame, listed: DataFrame, rate: float = 0.01, max_bits: int = 1 << 26):
        spark = universe.sparkSession
        listed = materialize(listed.select("key").where("key is not null").distinct(), "listed")
        self.levels: list[list] = []
        others = materialize(universe.select("key").where("key is not null").distinct().join(listed, "key", "left_anti"), "unlisted")
        n, unlisted = max(listed.count(), 1), max(others.count(), 1)
        first = min(rate, n / unlisted)
        shards = self.shards = max(1, -(-max(bits_for(n, first), bits_for(int(first * unlisted), rate)) // max_bits))
        for s in range(shards):
            mine = lambda df, s=s: df.where(F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(shards)) == s)
            levels: list = []
            inside, outside = mine(listed), mine(others)
            while inside.limit(1).count():
                levels.append(build_bloom(inside, rate if levels else first, max_bits, len(levels)))
                wrong = materialize(outside.where(self._passes(spark, levels[-1])), "wrong")
                inside, outside = wrong, inside
                if len(levels) > 64:
                    raise RuntimeError("the cascade does not end; raise max_bits")
            self.levels.append(levels)
        self.shared = spark.sparkContext.broadcast(self.levels)

    @staticmethod
    def _passes(spark, level) -> Column:
        shared = spark.sparkContext.broadcast(level)

        @F.pandas_udf("boolean")
        def run(h1: pd.Series, h2: pd.Series) -> pd.Series:
            return pd.Series(in_bloom(*shared.value, h1.to_numpy(), h2.to_numpy()))

        return run(*[F.shiftrightunsigned(F.xxhash64(F.lit(s), F.col("key")), 2) for s in SEEDS])

    def members(self, keys: Column) -> Column:
        """For an array of keys: an array of booleans, whether each is listed."""
        shared, shards = self.shared, self.shards

        @F.pandas_udf("array<boolean>")
        def run(h1: pd.Series, h2: pd.Series, shard: pd.Series) -> pd.Series:
            sizes = np.fromiter(map(len, h1), np.int64, len(h1))
            if not sizes.sum():
                return pd.Series([[] for _ in sizes])
            a, b, c = (np.concatenate([np.asarray(v, np.int64) for v in x]) for x in (h1, h2, shard))
            inside = np.zeros(len(a), bool)
            for s, levels in enumerate(shared.value):
                own = np.flatnonzero(c == s)
                inside[own] = refused_at(levels, a[own], b[own]) % 2 == 1
            return pd.Series(np.split(inside, np.cumsum(sizes)[:-1]))

        def hashed_with(seed: int) -> Column:
            return F.transform(keys, lambda k: F.shiftrightunsigned(F.xxhash64(F.lit(seed), k), 2))

        return run(*map(hashed_with, SEEDS), F.transform(keys, lambda k: F.pmod(F.xxhash64(F.lit(7), k), F.lit(shards))))


def judge(pages: DataFrame, allow: list[str], block: list[str], blocked_hosts: DataFrame | None = None, url: str = "url", key: str = "page_id") -> DataFrame:
    """``(page_id, host, path, rule, verdict)``: the longest rule that fits decides; without one, a page is blocked if its
    host or a parent domain is in ``blocked_hosts(key)``, and allowed otherwise."""
    host, path = host_and_path(url)
    rows = pages.select(key, host.alias("host"), path.alias("path"))
    spark = pages.sparkSession
    rules = [*allow, *block]
    rows = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), rules) if rules else F.array().cast("array<string>"))
    labels = F.split("host", r"\.", -1)
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rows = rows.withColumn("domains", domains)
    named = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string")
    universe = materialize(rows.select("host", "keys", "domains").distinct().select(F.explode(F.concat("keys", "domains")).alias("key")).distinct(), "universe")
    sets = {name: Cascade(universe, listed) for name, listed in (("allow", named(allow)), ("block", named(block)), ("hosts", blocked_hosts if blocked_hosts is not None else named([])))}
    rows = rows.withColumns({"a": sets["allow"].members(F.col("keys")), "b": sets["block"].members(F.col("keys")), "h": sets["hosts"].members(F.col("domains"))})
    fits = F.filter(F.zip_with(F.zip_with("a", "b", lambda x, y: F.struct(x.alias("allow"), y.alias("block"))), "keys", lambda m, k: F.struct(m.alias("m"), k.alias("k"))), lambda x: x["m"]["allow"] | x["m"]["block"])
    best = F.aggregate(fits, F.lit(None).cast("struct<m:struct<allow:boolean,block:boolean>,k:string>"), lambda acc, x: F.when(acc.isNull() | (F.char_length(x["k"]) > F.char_length(acc["k"])), x).otherwise(acc))
    rows = rows.withColumn("best", best)
    verdict = F.when(F.col("best.m.allow"), "allow").when(F.col("best.m.block"), "block").when(F.exists("h", lambda x: x), "block").otherwise("allow")
    return rows.select(key, "host", "path", F.col("best.k").alias("rule"), verdict.alias("verdict"))
