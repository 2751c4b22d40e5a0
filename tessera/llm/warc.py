"""WARC: a deterministic sharded writer and its reader.

Records are range-sorted by key: the bounds of the ranges are keys chosen by a hash, so they depend on the set of keys
alone and not on how Spark dealt the rows. Each task writes its ranges as gzip members, rolls a file once its compressed
size reaches a limit, and makes ids, lengths and digests anew. Files are written under temporary names; the rows of the
tasks that succeeded name the files to keep, these are renamed, and a manifest written last makes the archive valid.
An attempt that died leaves only temporary files, which no manifest names.

Null html is an empty payload, a null url leaves out the target, a null key sorts first (repeated keys keep all their
records; of equal large payloads every record with the largest key is a response). Empty tables give an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, temporary string, shard long, roll long, records long, bytes long, sha1 string"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, html string"


def record_id(key: int | None, digest: str) -> str:
    """A urn that follows from the key and the payload's digest."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}:{digest}')}>"


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def build_record(key: int | None, url: str | None, payload: bytes, size: int, digest: str, keeper: int | None) -> bytes:
    """One WARC/1.1 record; ``keeper`` is the key of the response that a revisit refers to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if keeper is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if keeper is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(key, digest)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base32(digest)}",
        f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).hexdigest())}",
        f"Content-Length: {len(block)}",
    ]
    if key is not None:
        head.append(f"X-Row-Key: {key}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=TARGET)}")
    if keeper is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(keeper, digest)}", f"X-Refers-To-Row-Key: {keeper}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: Everything printable but the percent sign stays; quote() takes the rest, so unquote() gives the url back.
TARGET = "".join(chr(c) for c in range(0x21, 0x7F) if c != 0x25)


def range_bounds(df: DataFrame, key: str, ranges: int, over: int = 16) -> list[int]:
    """About ``ranges`` - 1 keys that cut the table into ranges of like size, the same for the same set of keys.

    Of the distinct keys those whose hash falls into a small share are taken (about ``over`` a range) and each
    ``over``-th of them bounds a range; at most some ``over`` * ``ranges`` keys reach the driver.
    """
    keys = df.select(F.col(key).alias("k")).where("k is not null").distinct()
    share = max(1, keys.count() // (ranges * over))
    chosen = sorted(r.k for r in keys.where(F.pmod(F.xxhash64(F.lit(2024), "k"), F.lit(share)) == 0).toLocalIterator())
    step = max(1, round(len(chosen) / ranges))
    return chosen[step::step]


def keepers(digests: DataFrame, least: int) -> DataFrame:
    """``(page_id, keeper)`` of every row that repeats a payload of at least ``least`` bytes; narrow columns only."""
    large = digests.where(F.col("size") >= least)
    top = large.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    return large.join(top, "digest").where("keeper is not null and (page_id < keeper or page_id is null)").select("page_id", "digest", "keeper")


def write_warc(pages: DataFrame, path: str, shard_bytes: int = 32 << 20, file_bytes: int = 64 << 20, least: int = 1000, max_ranges: int = 20000) -> DataFrame:
    """Write ``pages(page_id, url, html)`` to ``path`` and return the manifest."""
    spark = pages.sparkSession
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html").cast("long")})
    total = rows.agg(F.sum("size")).first()[0] or 0
    bounds = np.array(range_bounds(rows, "page_id", int(min(max_ranges, max(1, total // shard_bytes)))), np.int64)

    @F.pandas_udf("long")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), "right"))

    # markers tell the writer of a repeat just before the record comes, so payloads are shuffled once and never joined
    marks = keepers(rows.select("page_id", "digest", "size"), least).distinct()
    marks = marks.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "digest", F.lit(0).cast("long").alias("size"), "keeper")
    both = rows.withColumn("keeper", F.lit(None).cast("long")).unionByName(marks).withColumn("shard", shard(F.coalesce("page_id", F.lit(-(2**63)))))
    both = both.repartitionById(len(bounds) + 1, F.col("shard").cast("int")).sortWithinPartitions("shard", "page_id", "digest", F.col("keeper").desc_nulls_last(), "url")
    keys = {c: F.col(c).cast("string") for c in ("page_id", "keeper")}  # pandas turns a long with nulls into doubles
    both = both.withColumns(keys)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(path)
        attempt, out, marked = uuid.uuid4().hex, [], None
        current, roll, sink = None, 0, None
        done: list[tuple] = []

        def close():
            nonlocal sink
            if sink is not None:
                sink.close()
                done.append((f"part-{current:06d}-{roll:05d}.warc.gz", out[0], current, roll, out[1], out[2], out[3].hexdigest()))
                sink = None

        for batch in batches:
            for key, url, html, digest, size, keeper, s in zip(*(batch[c] for c in ("page_id", "url", "html", "digest", "size", "keeper", "shard")), strict=True):
                key = None if key is None else int(key)
                if keeper is not None:
                    marked = (key, digest, int(keeper))
                    continue
                if s != current:
                    close()
                    current, roll = int(s), 0
                if sink is None:
                    name = f"_temporary-{current:06d}-{roll:05d}-{attempt}"
                    store.create_dir(f"{root}/_writing", recursive=True)
                    sink, out = store.open_output_stream(f"{root}/_writing/{name}", compression=None), [name, 0, 0, hashlib.sha1()]
                to = marked[2] if marked and marked[:2] == (key, digest) else None
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(build_record(key, url, html.encode() if to is None else b"", int(size), digest, to)) + packer.flush()
                sink.write(member)
                out[1] += 1
                out[2] += len(member)
                out[3].update(member)
                if out[2] >= file_bytes:
                    close()
                    roll += 1
        close()
        yield pd.DataFrame(done, columns=[c.split()[0] for c in MANIFEST.split(", ")])

    both.mapInPandas(write, MANIFEST).write.parquet(f"{path}/_written")  # Spark commits the rows of one attempt a task
    written = spark.read.schema(MANIFEST).parquet(f"{path}/_written")

    def publish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name, temporary in zip(batch["file"], batch["temporary"], strict=True):
                if store.get_file_info(f"{root}/_writing/{temporary}").type != fs.FileType.NotFound:
                    store.move(f"{root}/_writing/{temporary}", f"{root}/{name}")
                elif store.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(name)
            yield batch

    written.mapInPandas(publish, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _headers(data: bytes) -> dict[str, str]:
    return {k.decode().lower(): v.decode() for k, _, v in (x.partition(b": ") for x in data.split(b"\r\n")[1:])}


def read_members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    rest = b""
    unpacker, parts = zlib.decompressobj(31), []
    while data := rest or stream.read(chunk):
        rest = b""
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            rest = unpacker.unused_data
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the file ends inside a member")


def parse_record(data: bytes) -> tuple:
    """The columns of ``RECORD``; lengths and digests are checked."""
    head, _, block = data.partition(b"\r\n\r\n")
    h = _headers(head)
    block, end = block[: int(h["content-length"])], block[int(h["content-length"]) :]
    if end != b"\r\n\r\n" or "sha1:" + base32(hashlib.sha1(block).hexdigest()) != h["warc-block-digest"]:
        raise ValueError(f"record {h.get('warc-record-id')} is damaged")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
    size, kind = int(_headers(http)["content-length"]), h["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {h.get('warc-record-id')} has another payload than its digest says")
    key, to, url = h.get("x-row-key"), h.get("x-refers-to-row-key"), h.get("warc-target-uri")
    url = url and re.sub(rb"%([0-9A-F]{2})", lambda m: bytes.fromhex(m[1].decode()), url.encode()).decode()
    return key and int(key), url, kind, to and int(to), size, digest, payload.decode() if kind == "response" else None


def read_warc(spark: SparkSession, path: str, html: bool = True, batch_bytes: int = 8 << 20) -> DataFrame:
    """The records of the files that the manifest names; files are the unit of work and are streamed."""
    files = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").select("file")
    names = [c.split()[0] for c in RECORD.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(path)
        for name in (n for b in batches for n in b["file"]):
            held, size = [], 0
            with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                for member in read_members(stream):
                    row = parse_record(member)
                    held.append(row if html else (*row[:-1], None))
                    size += len(member) if html else 256
                    if size >= batch_bytes:
                        yield pd.DataFrame(held, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
                        held, size = [], 0
            yield pd.DataFrame(held, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    # one task a file: a stated number is not coalesced by their small names, as adaptive execution would do
    return files.repartition(max(1, files.count())).mapInPandas(read, RECORD)
