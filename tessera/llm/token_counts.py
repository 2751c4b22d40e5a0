"""Token counts by a digest cache.

Content is normalised (null becomes empty; ``normalise`` may do more where the tokenizer does the same) and digested;
(content digest, tokenizer version) is the key of a stored table of counts. Digests are held against the table first; only
texts whose digest it lacks are fetched, encoded once each and appended; then every document gets its count. Hot texts
collapse before the shuffle, since the distinct texts come from an aggregation with map-side combining. Repeated rows and
null ids keep their rows; texts of any length are counted whole; an empty table gives an empty result and appends nothing;
other columns are not touched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.memory import release
from tessera.llm.tokens import encoder, file_digest, slices
from tessera.storage import broadcast_if_small, discard, empty, materialize

STORED = "digest binary, n_tokens long, tokenizer string"


def stored_counts(spark: SparkSession, cache: str) -> DataFrame:
    """The stored table; empty where nothing was stored yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return empty(spark, STORED)
    return spark.read.schema(STORED).option("recursiveFileLookup", "false").parquet(cache)


def count_tokens(docs: DataFrame, cache: str, tokenizer: str, text: str = "text", normalise=lambda c: c, limit: int = 1024, version: str | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row; new counts are appended to ``cache``."""
    spark = docs.sparkSession
    version = version or file_digest(tokenizer)
    content: Column = normalise(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select("doc_id", content.alias("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    own = stored_counts(spark, cache).where(F.col("tokenizer") == version).select("digest", "n_tokens")
    missing = materialize(rows.select(digest.alias("digest")).distinct().join(own, "digest", "left_anti"), "missing")
    wanted = broadcast_if_small(missing)
    hashed = rows.select(digest.alias("digest"), "text")
    if wanted is not missing:  # few: other texts are not shuffled at all
        hashed = hashed.join(wanted, "digest", "left_semi")
    misses = hashed.groupBy("digest").agg(F.first("text").alias("text"))
    if wanted is missing:
        misses = misses.join(missing, "digest", "left_semi")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = encoder(tokenizer)
        for batch in batches:
            texts = batch["text"].tolist()
            counts = [int(n) for first, last in slices(texts) for n in tool.counts(texts[first:last])]
            yield pd.DataFrame({"digest": batch["digest"], "n_tokens": counts, "tokenizer": version})
        tool.forget()
        release()

    misses.mapInPandas(encode, STORED).write.mode("append").parquet(cache)
    discard(missing)
    counts = stored_counts(spark, cache).where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    # written, so that both sides of a join are plain shuffles and a digest that owns a third of the rows can be split
    counts = broadcast_if_small(materialize(counts, "counts"))
    out = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest.alias("digest")).join(counts, "digest", "left")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
