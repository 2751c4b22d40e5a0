"""Shared scratch space: written tables that survive lost executors and cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
#: Bytes of a row group of a scratch table: writers hold one each, and readers split files at them.
ROW_GROUP_BYTES = 32 << 20
#: Bytes that a broadcast side may take, by ``broadcast_if_small``.
BROADCAST_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where that is unset and all runs in this process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _own[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, so that later jobs reuse the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``materialize``, after their last reader has ended."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A table of ``schema`` without rows."""
    return spark.createDataFrame([], schema)


def row_bytes(df: DataFrame) -> int:
    """Bytes that a row of ``df`` takes in a broadcast hash table, by its fixed-width types; strings count 48, nested values 256."""
    wide = {"string": 48, "binary": 48}
    return 32 + sum(wide.get(kind, 256 if "<" in kind else 16) for _, kind in df.dtypes)


def broadcast_if_small(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint where its rows take at most ``most_bytes`` bytes; beyond that Spark's own choice."""
    rows = most_bytes // row_bytes(df)
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
