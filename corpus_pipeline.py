"""The corpus pipeline: quality rules, near-duplicate removal, pseudonyms and packing, stage by stage.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; its rows are written and read again for the next stage.
All stages but the last give the columns of ``documents``; null, empty and repeated rows go as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard, packing, pii, quality_rules
from tessera.llm.queries import PII_KEY
from tessera.operators.gate import protect
from tessera.storage import materialize


#: Rows in an Arrow batch: texts may be long, and both the executor and its Python workers hold whole batches.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limit of rows in an Arrow batch to ``BATCH_ROWS``; a smaller limit stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or whose host is rejected go."""
    bound_batches(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the one with the least id stays."""
    bound_batches(spark)
    return jaccard.keep_one(docs, 5, 80)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms; ``n_chars`` follows the new text."""
    bound_batches(spark)
    was = max(docs.columns, key=len) + "_"  # no other column has this name
    out = pii.pseudonymise(docs.withColumn(was, F.col("text")), PII_KEY)
    changed = F.when(F.col("text") != F.col(was), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the remaining documents."""
    bound_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality), ("ngram_jaccard", near_duplicates), ("pii", private_data), ("packing", pack)]
#: SQL has no tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def write_packed(spark: SparkSession, sf_dir: str, path: str, ledger: str, terms: DataFrame, aliases: DataFrame | None = None) -> None:
    """The pieces of ``run`` as Parquet at ``path``, for training: only of documents that the protected-content gate lets pass.

    The gate takes the words of the texts as they came from ``documents`` for tags. Every row of a ``doc_id`` that it holds
    is left out before packing, and its id and rule are appended to ``ledger``; an empty table of ``terms`` stops the write.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = F.split(F.coalesce(F.col("text"), F.lit("")), r"\s+")
    _, held = protect(docs.select("doc_id", words.alias("words")), terms, aliases, "doc_id", "words")
    held = materialize(held, "held")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    kept = docs.join(held.select(F.col("doc_id").alias("held_id")), F.col("doc_id").eqNullSafe(F.col("held_id")), "left_anti")
    held.write.mode("append").parquet(ledger)
    STAGES[-1][1](spark, kept, sf_dir).write.parquet(path)
