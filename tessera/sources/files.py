"""File sources and sinks: metadata logs, tolerant CSV, caption sidecars, asset listings, reports."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.operators.keyed import latest_by_key
from tessera.sources.lines import read_lines

ORDER = "struct<seq:bigint,at:struct<file:string,at:bigint>>"

POST = "seq long, source string, post_id string, page_url string, url string, filename string, ext string, bytes long, width int, height int, created_at string, rating string, tags array<string>, parent_id string, md5 string"


def read_log(spark: SparkSession, path: str, schema: str = POST, key: str = "filename", by_place: bool = False) -> DataFrame:
    """An append-only JSON-lines log, last row of each key; blank lines and empty strings count as absent.

    Rows follow their ``seq``, or with ``by_place`` the place of their lines: files in the order of names, then lines.
    """
    if by_place:
        lines = read_lines(spark, path)
        rows = lines.where(F.trim("line") != "").select(F.struct("file", "at").alias("at"), F.from_json("line", schema).alias("row"))
        rows = rows.select("row.*", F.col("at").alias(_place(rows.select("row.*").columns)))
    else:
        rows = spark.read.schema(schema).json(path)
    order = rows.columns[-1] if by_place else "seq"
    text = {c: F.nullif(F.col(c), F.lit("")) for c, t in rows.dtypes if t == "string"}
    last = latest_by_key(rows.withColumns(text).where(F.col(key).isNotNull()), [key], [order])
    return last.drop(order) if by_place else last


def _place(columns: list[str]) -> str:
    return max(columns, key=len) + "_at"  # no other column has this name


def write_log(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines, appended."""
    rows.write.mode("append").json(path)


def write_report(rows: DataFrame, path: str, fields: list[str]) -> None:
    """A CSV report of ``fields`` in their order, overwritten; arrays are joined, other columns left out, null is empty."""
    kinds = dict(rows.dtypes)
    out = [F.array_join(c, "|").alias(c) if kinds[c].startswith("array") else F.col(c) for c in fields]
    rows.select(*out).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def read_mapping(spark: SparkSession, path: str, key: str = "new_name", extra: tuple[str, ...] = ("bucket",)) -> DataFrame:
    """A mapping table from CSV files, each with a header; columns that older files lack are null, the last row of a key wins.

    Rows follow ``seq`` where a file has it, then the place of their lines: files in the order of names. A byte order mark is
    no part of a header, and a row is a line. What the driver reads is one header for each form of the files.
    """
    lines = read_lines(spark, path)
    heads = lines.where("at = 0").select("file", F.col("line").alias("head"))
    parts = []
    for (head,) in heads.select("head").distinct().collect():
        names = next(csv.reader([head]))
        at = _place(names)
        rows = lines.where((F.col("at") > 0) & (F.trim("line") != "")).join(heads.where(F.col("head") == head), "file", "left_semi")
        schema = StructType([StructField(n, StringType()) for n in names])
        row = F.from_csv("line", F.lit(schema.toDDL()), {"escape": '"'})
        rows = rows.select(F.struct("file", "at").alias(at), row.alias("row")).select(F.col(at), "row.*")
        seq = F.col("seq").cast("long") if "seq" in names else F.lit(None).cast("long")
        parts.append(rows.select(F.struct(seq.alias("seq"), F.col(at).alias("at")).alias("order"), F.struct(*names).alias("row")))
    every = list(dict.fromkeys(c for p in parts for c in p.schema["row"].dataType.names)) or [key]
    every += [c for c in extra if c not in every]
    at = _place(every)
    out = spark.createDataFrame([], StructType([StructField(c, StringType()) for c in every])).withColumn(at, F.lit(None).cast(ORDER))
    for p in parts:
        out = out.unionByName(p.select(F.col("order").alias(at), "row.*"), allowMissingColumns=True)
    return latest_by_key(out, [key], [at]).drop(at)


def list_assets(spark: SparkSession, path: str, extensions: tuple[str, ...] = ("jpg", "jpeg", "png", "webp")) -> DataFrame:
    """``(path, bucket, stem, ext, length, modified)`` of files under ``path``; their content is never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.select("path", F.element_at(F.split("path", "/"), -2).alias("bucket"), F.regexp_extract(name, r"^(.*?)(?:\.[^.]*)?$", 1).alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("ext"), "length", F.col("modificationTime").alias("modified"))
    return rows.where(F.col("ext").isin(*extensions))


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    """``(bucket, stem, text)`` of caption files beside the assets."""
    rows = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path)
    at = F.split(F.input_file_name(), "/")
    return rows.select(F.element_at(at, -2).alias("bucket"), F.regexp_replace(F.element_at(at, -1), r"\.txt$", "").alias("stem"), F.col("value").alias("text"))
