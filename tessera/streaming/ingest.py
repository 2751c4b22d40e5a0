"""Keyed append as a stream: new rows above a floor join a table once, by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.keyed import first_by_key


def append_new(stream: DataFrame, table: str, checkpoint: str, key: str, order: str, floor: int = 0):
    """A streaming query that appends rows of ``stream`` with ``order`` at least ``floor`` whose key the Parquet ``table`` lacks.

    Each micro-batch is an insert-only merge and can be run again: what it wrote before is seen and left out.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = first_by_key(batch.where(F.col(order) >= floor), [key], [order])
        path = spark._jvm.org.apache.hadoop.fs.Path(table)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            new = new.join(spark.read.schema(batch.schema).parquet(table).select(key), key, "left_anti").select(*batch.columns)
        new.write.mode("append").parquet(table)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
