"""Byte-level BPE: encoding by a fold of ranked merges over distinct words, decoding by concatenation of pieces.

The words of all texts are counted once; each distinct word is encoded by Spark's higher-order functions. Its bytes (as
pairs of hexadecimal digits) form an array, ``aggregate`` merges the neighbours of least rank until none has a rank, and
ranks come from a literal map. As Spark searches a map from its start, the literal is an array of small maps, found by hash.


Texts are never shuffled: the code of words (a 64-bit hash, checked to be unique, and the ids) is kept in the shared folder for
up to ``most_words`` words, the most frequent ones; each worker loads it and looks its words up there. Beyond that bound the
other words' ids are joined to the texts that hold them, by text digest. Decoding concatenates the binary pieces of all ids,
a slice of texts at a time.

Null text is empty and has no ids; rows with null or repeated ids keep their rows; a single word of any length is one row
of the fold. White space and letters are Unicode's as Java knows it.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.storage import materialize, scratch_path

NONE = 2**31 - 1
BUCKETS = 1 << 15


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def rank_table(ranks: dict[bytes, int]) -> Column:
    """The literal map from hexadecimal bytes to ranks, as an array of maps by hash."""
    table: list[dict] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        key = token.hex().upper()
        table[xxhash.xxh64_intdigest(key.encode(), 42) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(table)), "array<map<string,int>>")


def rank_of(table: Column, piece: Column) -> Column:
    # a power of two many buckets: the low bits of the hash are its remainder, whatever the sign
    bucket = F.get(table, F.xxhash64(piece).bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
    return F.coalesce(F.try_element_at(bucket, piece), F.lit(NONE))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` made once."""
    return F.transform(F.array(value), body)[0]


def encode_word(word: Column, table: Column) -> Column:
    """The ids of a word: itself if it has a rank, else what the merges leave."""
    whole = F.hex(word.cast("binary"))
    pieces = F.regexp_extract_all(whole, F.lit("[0-9A-F]{2}"), 0)

    def pairs(p: Column) -> Column:
        return F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1), lambda a, b: rank_of(table, F.concat(a, b)))

    def merge(s: Column, i: Column) -> Column:
        p, r = s["p"], s["r"]
        rest = F.greatest(F.size(p) - i - 1, F.lit(0))

        def put(m: Column) -> Column:
            before = F.when(i > 1, F.array(rank_of(table, F.concat(F.get(p, i - 2), m)))).otherwise(F.array().cast("array<int>"))
            after = F.when(rest > 0, F.array(rank_of(table, F.concat(m, F.get(p, i + 1))))).otherwise(F.array().cast("array<int>"))
            new_p = F.concat(F.slice(p, F.lit(1), i - 1), F.array(m), F.slice(p, i + 2, rest))
            new_r = F.concat(F.slice(r, F.lit(1), F.greatest(i - 2, F.lit(0))), before, after, F.slice(r, i + 2, F.greatest(rest - 1, F.lit(0))))
            return F.struct(new_p.alias("p"), new_r.alias("r"))

        return let(F.concat(F.get(p, i - 1), F.get(p, i)), put)

    def step(s: Column, _: Column) -> Column:
        best = F.array_min(s["r"])
        return F.when(best < NONE, let(F.array_position(s["r"], best).cast("int"), lambda i: merge(s, i))).otherwise(s)

    start = let(pieces, lambda p: F.struct(p.alias("p"), pairs(p).alias("r")))
    merged = F.aggregate(F.sequence(F.lit(1), F.greatest(F.octet_length(word) - 1, F.lit(1))), start, step, lambda s: F.transform(s["p"], lambda x: rank_of(table, x)))
    return let(rank_of(table, whole), lambda r: F.when(r < NONE, F.array(r)).when(F.length(whole) > 2, merged))


def by_id(ranks: dict[bytes, int]) -> pa.Array:
    """The piece of each id, null where there is none."""
    pieces: list = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pa.array(pieces, pa.large_binary())


def joined(table: pa.Array, ids: pa.Array, cuts: np.ndarray) -> list[memoryview]:
    """The entries of ``table`` for ``ids`` one after another, cut at ids ``cuts``."""
    if not len(ids):
        return [memoryview(b"")] * (len(cuts) - 1)
    taken = table.take(ids)
    if taken.null_count:
        raise ValueError("an id without a piece")
    at, data = np.frombuffer(taken.buffers()[1], np.int64)[cuts].tolist(), memoryview(taken.buffers()[2] or b"")
    return [data[a:b] for a, b in zip(at, at[1:], strict=False)]


class Code:
    """Ids of words by hash: sorted hashes, an index of their leading bits, and the lists of ids in the same order."""

    def __init__(self, hashes: np.ndarray, ids: pa.Array):
        keys = hashes.view(np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[order], np.uint64(0))
        self.bits = max(1, int(len(keys)).bit_length())
        self.first = np.searchsorted(self.keys[:-1], np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)).astype(np.int32)
        self.ids = ids.take(pa.array(order))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of hashes, -1 for those that are missing."""
        keys = hashes.view(np.uint64)
        at = self.first[(keys >> np.uint64(64 - self.bits)).astype(np.int64)].astype(np.int64)
        open_ = np.flatnonzero(self.keys[at] != keys)
        while len(open_):
            at[open_] += 1
            over = (at[open_] >= len(self.keys) - 1) | (self.keys[np.minimum(at[open_], len(self.keys) - 1)] > keys[open_])
            at[open_[over]] = -1
            open_ = open_[~over]
            open_ = open_[self.keys[at[open_]] != keys[open_]]
        if len(self.keys) == 1:
            at[:] = -1
        return at


_loaded: dict[str, Code] = {}


def load_code(path: str, kind: pa.DataType) -> Code:
    """The code of words from the shared folder, once for each worker; it never passes through the driver."""
    if path not in _loaded:
        _loaded.clear()
        store, root = fs.FileSystem.from_uri(path)
        hashes, ids = [np.empty(0, np.int64)], [pa.array([], kind)]
        for info in sorted(store.get_file_info(fs.FileSelector(root)), key=lambda x: x.path):
            if info.base_name.endswith(".parquet"):
                with store.open_input_file(info.path) as f:
                    table = pq.read_table(f, columns=["h", "ids"])
                hashes.append(table["h"].to_numpy())
                ids += table["ids"].cast(kind).chunks
        _loaded[path] = Code(np.concatenate(hashes), pa.concat_arrays(ids))
    return _loaded[path]


def words_of(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), 0)


def word_ids(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str) -> DataFrame:
    """``(word, n, ids)`` of every distinct word, encoded once; written."""
    counted = docs.select(F.explode(words_of(F.col(text), pattern)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return materialize(counted.select("word", "n", encode_word(F.col("word"), rank_table(ranks)).alias("ids")), "words")


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", most_words: int = 4_000_000, slice_words: int = 500_000, ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row: the ids of its whole text and the bytes that they decode to.

    With ``ids`` a column of the ids follows.
    """
    spark = docs.sparkSession
    known = word_ids(docs, ranks, pattern, text)
    total = known.count()
    for seed in range(100):
        hashed = known.withColumn("h", F.xxhash64(F.lit(seed), "word"))
        if hashed.agg(F.count_distinct("h")).first()[0] == total:
            break
    else:
        raise RuntimeError("no hash tells all words apart")
    least = 0  # words that occur at least so often are loaded by every worker
    if total > most_words:
        spread = sorted(((r.k, r.c) for r in known.groupBy(F.floor(F.log2("n") * 4).alias("k")).agg(F.count("*").alias("c")).collect()), reverse=True)
        fits, least = 0, 2.0**60
        for k, c in spread:
            fits += c
            if fits > most_words:
                break
            least = 2.0 ** (k / 4)
    code = hashed.select("h", "ids", F.floor(F.log2("n") * 4).alias("often"))
    bound = int(round(np.log2(least) * 4)) if least else 0
    path = scratch_path(spark, "code")
    (code.where(F.col("often") >= bound) if least else code).select("h", "ids").write.parquet(path)
    kind = pa.list_(pa.uint16() if max(ranks.values(), default=0) < 1 << 16 else pa.int32())
    pieces = by_id(ranks)
    shown = pa.array([f"{i},".encode() for i in range(len(pieces))], pa.large_binary())

    words = words_of(F.col(text), pattern)
    rows = docs.select("doc_id", F.transform(words, lambda w: F.xxhash64(F.lit(seed), w)).alias("h"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("digest"))
    if least:
        rest = code.where(F.col("often") < bound).select("h", F.struct("h", "ids").alias("word"))
        need = rows.select("digest", F.explode(F.array_distinct("h")).alias("h")).distinct().join(rest, "h")
        more = need.groupBy("digest").agg(F.collect_list("word").alias("more"))
        rows = rows.join(more, "digest", "left").select("doc_id", "h", "more")
    else:
        rows = rows.select("doc_id", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = load_code(path, kind)
        for batch in batches:
            offsets = batch["h"].offsets.to_numpy()
            flat = batch["h"].values.to_numpy(zero_copy_only=False)
            first = 0
            while first < batch.num_rows:  # rows of about slice_words words at a time
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + slice_words, "right")) - 1)
                ends = offsets[first : last + 1] - offsets[first]
                at = code.find(flat[offsets[first] : offsets[last]])
                if not least and (at < 0).any():
                    raise ValueError("a word is missing")
                of = code.ids
                if least and (at < 0).any():  # the slice's own words, then those that came with its rows
                    extra = [w for x in batch["more"].slice(first, last - first).to_pylist() if x for w in x]
                    rare = Code(np.array([w["h"] for w in extra], np.int64), pa.array([w["ids"] for w in extra], kind))
                    lost = np.flatnonzero(at < 0)
                    near, own = np.unique(at[at >= 0], return_inverse=True)
                    of = pa.concat_arrays([of.take(pa.array(near)), rare.ids])
                    at[at >= 0] = own
                    at[lost] = len(near) + rare.find(flat[offsets[first] + lost])
                tokens = of.take(pa.array(at))
                cuts = tokens.offsets.to_numpy()[ends].astype(np.int64)
                tokens = tokens.flatten()
                digests = [hashlib.sha256(x[:-1]).hexdigest() for x in joined(shown, tokens, cuts)]
                decoded = [hashlib.sha256(x).hexdigest() for x in joined(pieces, tokens, cuts)]
                out = [batch["doc_id"].slice(first, last - first), pa.array(np.diff(cuts)), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
                if ids:
                    out.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), tokens.cast(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if ids else [])])
                first = last

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else ""))
