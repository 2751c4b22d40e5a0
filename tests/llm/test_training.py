"""What the pipeline writes for training passes the protected-content gate."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.operators.gate import GateError


def test_write_packed(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    every = {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()}
    word = docs.where(F.col("doc_id").isin(sorted(every))).select(F.explode(F.split(F.lower("text"), r"\s+")).alias("w")).where("w RLIKE '^[a-z]{6,}$'").groupBy("w").count().orderBy("count", "w").first().w
    terms = spark.createDataFrame([(word,)], "term string")
    corpus_pipeline.write_packed(spark, sf, f"{tmp_path}/pieces", f"{tmp_path}/held", terms)
    held = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/held").collect()}
    got = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/pieces").collect()}
    assert held & every and got == every - held
    with pytest.raises(GateError):
        corpus_pipeline.write_packed(spark, sf, f"{tmp_path}/none", f"{tmp_path}/held", terms.limit(0))
