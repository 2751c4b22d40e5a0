"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct word shingles. Tokens are hashed to the bits of a sparse sketch, by XOR: a bit is the
parity of the tokens that fall on it, so the Hamming distance of two sketches is at most the symmetric difference of the
sets. Sets that reach the similarity differ in at most d tokens, d following from their sizes; a sketch of more than d
bands therefore has a band on which both agree. Documents are grouped by size, since similar sets have similar sizes; a
group fixes d and the number of bands. A document emits one key a band that has tokens (a linear hash of the band's
bits); should it have no more than d such bands, it emits its empty bands too, so no pair is missed.

Pairs are not enumerated inside a bucket. Exact copies are joined by digest beforehand, and only keys that occur twice
are kept. Then, each step leaving less to the next:

1. each member of a bucket is held against the bucket's least document by dense sketches, whose distance must allow the
   similarity; what passes gives families;
2. buckets whose other members lie in several families are compared inside tasks, sketches only, and add a forest of
   passing pairs;
3. the members of a family are verified by their exact sets against its least document;
4. those that it did not link are verified against the whole family, in blocks of bounded size.

Blocks and streamed parts are bounded by documents and by tokens, so a hot bucket or family is split over tasks. The links
found connect whatever the pairs of the similarity connect: a pair that is skipped lies in one component already.

Null and empty texts have an empty set and link with nothing; a text of fewer words than a shingle is one token. A very
long text is one set and one sketch of a size in proportion to it. Rows with a null id get a null component and take no
part; rows that share an id are one document; an empty table gives an empty result. Other columns are not touched, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.memory import release
from tessera.llm.tokens import slices
from tessera.operators.components import connected_components
from tessera.storage import broadcast_if_small, discard, materialize

U = np.uint64
BLANKS = " \t\n\r\x0b\x0c"
FEATURES = "doc_id string, n_shingles long, digest binary, sketch array<long>, keys array<long>"
#: Documents and tokens in a block that a task holds, and in a part that it streams.
BLOCK, TOKENS = 2048, 2_000_000
#: Bits of the table of repeated keys (16 MB); fuller tables let more single keys through.
TABLE_BITS = 1 << 27
#: Streamed documents that a task compares at once.
CHUNK = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (splitmix64's finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """64-bit hashes of the words of each text; only the distinct words of the batch are hashed."""
    parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pa.array([t or "" for t in texts], pa.large_string()))))
    coded = parts.values.dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pandas()), U, len(coded.dictionary))
    ends = np.cumsum(parts.value_lengths().to_numpy(zero_copy_only=False))
    own = np.split(known[coded.indices.to_numpy()], ends[:-1]) if texts else []
    return [h if t and t.strip(BLANKS) else h[:0] for h, t in zip(own, texts, strict=True)]


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text's word hashes; fewer words than ``size`` are one shingle."""
    if not len(words):
        return words
    width = min(size, len(words))
    n = len(words) - width + 1
    out = np.full(n, U(size - width))
    for k in range(width):
        out = mix(out * U(0x9E3779B97F4A7C15) + words[k : k + n] + U(k))
    return np.unique(out)


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """The set of each text."""
    for first, last in slices([t or "" for t in texts]):
        yield from (shingle_set(h, size) for h in word_hashes(texts[first:last]))


@lru_cache
def geometry(percent: int) -> list[tuple[int, int, int, int]]:
    """Size groups ``(first, last, most differing tokens, bands)`` for a similarity of ``percent``."""
    out, first, ratio = [], 1, (100 / percent) ** 2
    while first < 1 << 40:
        nxt = int(first * ratio) + 1
        differ = 2 * (100 - percent) * (nxt - 1) // (100 + percent)
        slack = next((s for s in np.arange(1.02, 3, 0.02) if s * (differ + 1) * (1 - np.exp(-first / (s * (differ + 1)))) >= 1.04 * (differ + 1) + 1), 1.0)
        out.append((first, nxt - 1, differ, max(differ + 1, int(np.ceil(slack * (differ + 1))) if differ else 1)))
        first = nxt
    return out


@lru_cache
def _firsts(percent: int) -> np.ndarray:
    return np.array([g[0] for g in geometry(percent)], np.int64)


def band_keys(tokens: np.ndarray, group: int, percent: int) -> np.ndarray:
    """The keys of the bands of a sorted token set in one size group."""
    _, _, differ, bands = geometry(percent)[group]
    band = np.minimum(((tokens >> U(11)).astype(np.float64) * (bands / 2.0**53)).astype(np.int64), bands - 1)  # sorted as tokens are
    starts = np.flatnonzero(np.diff(band, prepend=-1))
    bit = (mix(tokens) & U((1 << 20) - 1)) | (band.astype(U) << U(20))
    parity = np.bitwise_xor.reduceat(mix(bit + U(0x632BE59BD9B4E019)), starts)
    used = band[starts]
    if len(used) <= differ:
        empty = np.setdiff1d(np.arange(bands), used)
        used, parity = np.concatenate([used, empty]), np.concatenate([parity, np.zeros(len(empty), U)])
    return (mix(parity ^ mix(used.astype(U) + (U(group) << U(40)))) & ~U(63)) | U(group & 63)  # the group stays readable


def keys_of(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Keys in the own size group, and in the next if a similar set can lie there."""
    n = len(tokens)
    group = int(np.searchsorted(_firsts(percent), n, "right")) - 1
    own = band_keys(tokens, group, percent)
    return np.concatenate([own, band_keys(tokens, group + 1, percent)]) if n * 100 // percent >= _firsts(percent)[group + 1] else own


def sketch_bits(n: int, percent: int) -> int:
    """Bits of the dense sketch of a set of ``n`` tokens: a power of two, at least the last size of its group."""
    last = geometry(percent)[int(np.searchsorted(_firsts(percent), n, "right")) - 1][1]
    return max(256, 1 << (last - 1).bit_length())


def sketch(tokens: np.ndarray, bits: int) -> np.ndarray:
    """A dense parity sketch; XOR of its halves is the sketch of half as many bits."""
    odd = np.bincount((tokens & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(U)


def fold(words: np.ndarray, size: int) -> np.ndarray:
    """A sketch folded to ``size`` words."""
    return np.bitwise_xor.reduce(words.reshape(-1, size), axis=0)


def _features(size: int, percent: int):
    names = [c.split()[0] for c in FEATURES.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple] = set()
        for batch in batches:
            out, total = [], 0
            for doc, tokens in zip(batch["doc_id"], shingle_sets(batch["text"].tolist(), size), strict=True):
                digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None
                keys = dense = None
                if digest and doc is not None and (digest, doc) not in seen:  # a repeated row adds nothing
                    if len(seen) < 200_000:
                        seen.add((digest, doc))
                    keys = keys_of(tokens, percent).view(np.int64)
                    dense = sketch(tokens, sketch_bits(len(tokens), percent)).view(np.int64)
                    total += len(keys) + len(dense)
                out.append((doc, len(tokens), digest, dense, keys))
                if total > 500_000:
                    yield pd.DataFrame(out, columns=names)
                    out, total = [], 0
            yield pd.DataFrame(out, columns=names)
        release()

    return run


def _sets(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, total = [], 0
            for doc, tokens in zip(batch["doc"], shingle_sets(batch["text"].tolist(), size), strict=True):
                out.append((doc, tokens.tobytes()))
                total += len(tokens)
                if total > 1_000_000:
                    yield pd.DataFrame(out, columns=["doc", "tokens"])
                    out, total = [], 0
            yield pd.DataFrame(out, columns=["doc", "tokens"])
        release()

    return run


class Block:
    """Documents that a task holds, and the links to them of those that stream past."""

    def __init__(self, percent: int, exact: bool):
        self.percent, self.exact = percent, exact
        self.docs: list[int] = []
        self.sets: list[np.ndarray] = []  # token sets, or sketches unless exact
        self.sizes: list[int] = []
        self.up: dict[int, int] = {}
        self.dense: tuple | None = None
        self.out: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up.setdefault(y, y)
            x = up[x]
        return x

    def hold(self, doc: int, comp: int, n: int, data: bytes) -> None:
        self.docs.append(doc)
        self.sizes.append(n)
        self.sets.append(np.frombuffer(data, U))
        self._known(doc, comp)

    def _known(self, doc: int, comp: int) -> None:
        p, q = self.find(doc), self.find(comp)
        self.up[max(p, q)] = min(p, q)

    def _sketch(self, data: np.ndarray, n: int) -> np.ndarray:
        return sketch(data, sketch_bits(n, self.percent)) if self.exact else data

    def meet(self, rows: list[tuple[int, int, int, np.ndarray]]) -> None:
        """Compare streamed ``(doc, comp, n, data)`` with the held documents."""
        if not rows or not self.docs:
            return
        if self.dense is None:
            own = [self._sketch(s, n) for s, n in zip(self.sets, self.sizes, strict=True)]
            least = min(map(len, own))
            self.dense = (np.stack([fold(x, least) for x in own]), np.array(self.sizes, np.int64), np.array(self.docs, np.int64))
        mine, sizes, docs = self.dense
        new = [r[3] for r in rows]
        theirs = [self._sketch(s, r[2]) for s, r in zip(new, rows, strict=True)]
        width = min(mine.shape[1], *map(len, theirs))
        if width < mine.shape[1]:
            mine = np.bitwise_xor.reduce(mine.reshape(len(mine), -1, width), axis=1)
            self.dense = (mine, sizes, docs)
        theirs = np.stack([fold(x, width) for x in theirs])
        n = np.array([r[2] for r in rows], np.int64)
        far = np.zeros((len(rows), len(sizes)), np.int64)
        for w in range(width):
            far += np.bitwise_count(theirs[:, w][:, None] ^ mine[None, :, w])
        a, b = n[:, None], sizes[None, :]
        may = (far * (100 + self.percent) <= (100 - self.percent) * (a + b)) & (100 * np.minimum(a, b) >= self.percent * np.maximum(a, b))
        may &= np.array([r[0] for r in rows], np.int64)[:, None] != docs[None, :]
        i, j = np.nonzero(may)
        order = np.argsort(far[i, j], kind="stable")
        for r in rows:
            self._known(r[0], r[1])
        for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
            p, q = self.find(rows[x][0]), self.find(self.docs[y])
            if p == q:
                continue
            if self.exact:
                common = len(np.intersect1d(new[x], self.sets[y], assume_unique=True))
                if 100 * common < self.percent * (rows[x][2] + self.sizes[y] - common):
                    continue
            self.up[max(p, q)] = min(p, q)
            self.out.append((rows[x][0], self.docs[y]))


def _compare(percent: int, exact: bool):
    """Links of sorted rows ``(group, side, doc, comp, n, data)``; the rows of side 0 of a group come first and are held.

    A group without rows of side 1 is compared with itself.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, current, rows, streamed = Block(percent, exact), None, [], False
        out: list[tuple[int, int]] = []

        def ended() -> list[tuple[int, int]]:
            mine = rows if streamed else list(zip(block.docs, block.docs, block.sizes, block.sets, strict=True))
            for i in range(0, len(mine), CHUNK):
                block.meet(mine[i : i + CHUNK])
            return block.out

        for batch in batches:
            for group, side, doc, comp, n, data in zip(*(batch[c] for c in ("group", "side", "doc", "comp", "n", "data")), strict=True):
                if group != current:
                    out += ended()
                    block, current, rows, streamed = Block(percent, exact), group, [], False
                if not side:
                    block.hold(doc, comp, n, data)
                else:
                    streamed = True
                    rows.append((doc, comp, n, np.frombuffer(data, U)))
                    if len(rows) >= CHUNK:
                        block.meet(rows)
                        rows = []
            if out:
                yield pd.DataFrame(out, columns=["src", "dst"])
                out = []
        yield pd.DataFrame(out + ended(), columns=["src", "dst"])
        release()

    return run


def _linked(rows: DataFrame, key: list[str], percent: int, exact: bool) -> DataFrame:
    """Links inside groups of ``rows(*key, side, doc, comp, n, data)``."""
    dealt = rows.select(F.xxhash64(*key).alias("group"), *key, "side", "doc", "comp", "n", "data").repartition(*key)
    dealt = dealt.sortWithinPartitions(*key, "side", "doc").select("group", "side", "doc", "comp", "n", "data")
    return dealt.mapInPandas(_compare(percent, exact), "src long, dst long")


def _parts(docs: Column, tokens: Column) -> Column:
    """In how many parts a group of so many documents and tokens is dealt."""
    return F.ceil(F.greatest(docs / F.lit(BLOCK), tokens / F.lit(TOKENS), F.lit(1))).cast("int")


def _place(parts: str) -> Column:
    return F.pmod(F.xxhash64("doc"), F.col(parts)).cast("int")


def _may_reach(percent: int) -> Column:
    """Whether sizes ``n``, ``m`` and dense sketches ``sketch``, ``other`` allow the similarity."""
    half = lambda a: F.zip_with(F.slice(a, F.lit(1), F.size(a) / 2), F.slice(a, F.size(a) / 2 + 1, F.size(a) / 2), lambda x, y: x.bitwiseXOR(y))
    a, b = F.col("sketch"), F.col("other")
    for _ in range(int(np.ceil(np.log2((100 / percent) ** 2)))):  # sizes of neighbouring groups
        a, b = F.when(F.size(a) > F.size(b), half(a)).otherwise(a), F.when(F.size(b) > F.size(a), half(b)).otherwise(b)
    far = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    n, m = F.col("n"), F.col("m")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (far * (100 + percent) <= (100 - percent) * (n + m))


def key_bit(key: Column) -> Column:
    """The place of a key in the bit table; the group in a key's low bits is left out."""
    return F.pmod(F.shiftright(key, 6), F.lit(TABLE_BITS)) + 1


def load_bits(path: str) -> np.ndarray:
    """The bit table from the shared folder, read by each task that needs it."""
    store, root = fs.FileSystem.from_uri(path)
    bits = np.zeros(TABLE_BITS // 8, np.uint8)
    for info in store.get_file_info(fs.FileSelector(root)):
        if info.base_name.endswith(".parquet"):
            with store.open_input_file(info.path) as f:
                for row in pq.read_table(f).to_pylist():
                    part = np.frombuffer(row["bits"], np.uint8)
                    bits[(row["bucket"] - 1) * len(part) : row["bucket"] * len(part)] = part
    return bits


def _repeated_keys(path: str):
    """Rows ``(key, doc)`` of keys whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = load_bits(path)
        for batch in batches:
            lists = batch["keys"]
            keys = lists.flatten().to_numpy(zero_copy_only=False)
            docs = np.repeat(batch["doc_id"].to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False))
            place = (keys >> 6) % TABLE_BITS
            on = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            yield pa.RecordBatch.from_arrays([pa.array(keys[on], pa.int64()), pa.array(docs[on], pa.int64())], names=["key", "doc"])
        release()

    return run


def _candidates(found: DataFrame, copies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rest, sketches)``: by key the documents behind the key's least one, and the sketches of all these; both written.

    Keys are counted first. Those that occur twice set the bits of a table of fixed size, and only keys whose bit is set
    are shuffled with their documents; a bit that a single key shares lets that key through and costs a row, no more.
    """
    spark = found.sparkSession
    own = found.where("keys is not null").join(broadcast_if_small(copies.select(F.col("src").alias("doc_id")).distinct()), "doc_id", "left_anti")
    repeated = own.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("docs")).where("docs > 1")
    place = key_bit(F.col("key"))
    # dealt by bucket first, as partial bitmaps of every task would be larger than the places themselves
    places = repeated.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit")).repartition("bucket")
    table = materialize(places.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "bits")
    members = materialize(own.select("doc_id", "keys").mapInArrow(_repeated_keys(table._scratch_path), "key long, doc long"), "members")
    least = members.groupBy("key").agg(F.min("doc").alias("least"), F.count("*").alias("docs")).where("docs > 1").drop("docs")
    rest = materialize(members.join(least, "key").where("least < doc"), "rest")
    discard(table, members)
    sketched = found.where("keys is not null").select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch", "digest")
    some = materialize(rest.select("doc").union(rest.select("least")).distinct(), "some")
    sketches = materialize(sketched.join(broadcast_if_small(some), "doc", "left_semi").dropDuplicates(["doc", "digest"]).drop("digest"), "sketches")
    discard(some)
    return rest, sketches


def _families(rest: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """``(doc, family)``, written: components of pairs whose sketches allow the similarity; no such pair lies across two."""
    pairs = rest.select("doc", "least").distinct().join(sketches, "doc")
    pairs = pairs.join(sketches.select(F.col("doc").alias("least"), F.col("n").alias("m"), F.col("sketch").alias("other")), "least")
    near = materialize(pairs.where(_may_reach(percent)).select(F.col("doc").alias("src"), F.col("least").alias("dst")), "near")
    labels = connected_components(near).select(F.col("node").alias("doc"), F.col("component").alias("comp"))
    placed = materialize(rest.select("key", "doc").join(labels, "doc", "left").select("key", "doc", F.coalesce("comp", "doc").alias("comp")), "placed")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("docs")).where("low < high")
    mixed = mixed.select("key", _parts(F.col("docs"), F.lit(0)).alias("parts"))
    open_ = placed.join(mixed, "key").withColumn("part", _place("parts"))
    held = open_.select("key", "doc", "comp", F.col("part").alias("block"), F.lit(0).alias("side"))
    passing = open_.where("parts > 1").select("key", "doc", "comp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"), F.lit(1).alias("side"))
    dealt = held.union(passing)
    data = F.unhex(F.array_join(F.transform("sketch", lambda x: F.lpad(F.hex(x), 16, "0")), ""))
    dealt = dealt.join(sketches.select("doc", "n", data.alias("data")), "doc")
    more = materialize(_linked(dealt, ["key", "block"], percent, False), "more")
    discard(placed)
    families = connected_components(near.union(more)).select(F.col("node").alias("doc"), F.col("component").alias("family"))
    families = materialize(families, "families")
    discard(near, more)
    return families


def _verified(docs: DataFrame, text: str, families: DataFrame, sketches: DataFrame, size: int, percent: int) -> DataFrame:
    """Links by exact sets that connect what the similarity connects inside families; written."""
    texts = docs.select(F.col("doc_id").alias("doc"), F.col(text).alias("text"))

    def sets(wanted: DataFrame) -> DataFrame:
        return texts.join(broadcast_if_small(wanted), "doc", "left_semi").mapInPandas(_sets(size), "doc long, tokens binary")

    def judged(dealt: DataFrame, name: str) -> DataFrame:
        wanted = materialize(dealt.select("doc").distinct(), "wanted")
        rows = sets(wanted).withColumn("n", F.octet_length("tokens") / 8).select("doc", F.col("n").cast("long").alias("n"), F.col("tokens").alias("data"))
        out = materialize(_linked(rows.join(broadcast_if_small(dealt), "doc"), ["family", "block", "part"], percent, True), name)
        discard(wanted)
        return out

    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["family", "block", "part", "side", "doc", "comp"]
    sized = materialize(families.join(sketches.groupBy("doc").agg(F.max("n").alias("n")), "doc"), "sized")
    total = sized.groupBy("family").agg(_parts(F.count("*"), F.sum("n")).alias("parts"))
    here = sized.join(total, "family").withColumns({"block": F.lit(0), "comp": F.col("doc")})
    centre = here.where("doc = family").withColumns({"part": every("parts"), "side": F.lit(0)}).select(*columns)
    others = here.where("doc <> family").withColumns({"part": _place("parts"), "side": F.lit(1)}).select(*columns)
    first = materialize(centre.union(others), "dealt")
    links = judged(first, "links")
    discard(first)

    done = links.select(F.col("src").alias("doc"), F.lit(True).alias("done")).distinct()
    state = sized.join(broadcast_if_small(done), "doc", "left").withColumn("done", F.coalesce("done", F.col("doc") == F.col("family")))
    left = state.where("NOT done").groupBy("family").agg(_parts(F.count("*"), F.sum("n")).alias("blocks"))
    state = materialize(state.join(broadcast_if_small(left), "family").join(total, "family").withColumn("comp", F.when(F.col("done"), F.col("family")).otherwise(F.col("doc"))), "state")
    held = state.where("NOT done").withColumns({"block": _place("blocks"), "part": every("parts"), "side": F.lit(0)}).select(*columns)
    passing = state.where("doc <> family").withColumns({"block": every("blocks"), "part": _place("parts"), "side": F.lit(1)}).select(*columns)
    second = materialize(held.union(passing), "dealt")
    out = materialize(links.union(judged(second, "links")), "links")
    discard(sized, state, second, links)
    return out


def shingle_components(docs: DataFrame, size: int, percent: int, text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row; similarity is at least ``percent`` / 100."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col(text).alias("text"))
    found = rows.mapInPandas(_features(size, percent), FEATURES).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = materialize(found, "features")
    base = materialize(found.select("doc_id", "n_shingles"), "sizes")
    named = found.where("doc_id is not null and digest is not null")
    least = named.groupBy("digest").agg(F.min("doc_id").alias("dst"), F.max("doc_id").alias("most")).where("dst < most").drop("most")
    least = broadcast_if_small(materialize(least, "least"))  # written, so that a hot digest's side of the join can be split
    copies = materialize(named.select("doc_id", "digest").join(least, "digest").where("doc_id > dst").select(F.col("doc_id").alias("src"), "dst").distinct(), "copies")
    rest, sketches = _candidates(found, copies)
    discard(found)
    families = _families(rest, sketches, percent)
    discard(rest)
    links = _verified(docs, text, families, sketches, size, percent)
    discard(families, sketches)
    labels = connected_components(copies.union(links))
    discard(copies, links)
    out = base.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that lie in the component of a smaller id; of rows with one id, one stays.

    Rows with a null id stay. Only ids are shuffled unless ids repeat.
    """
    found = materialize(shingle_components(docs, size, percent, text), "components")
    gone = found.where("component_id < doc_id").select("doc_id").distinct()
    kept = docs.join(broadcast_if_small(materialize(gone, "gone")), "doc_id", "left_anti").select(*docs.columns)
    repeated = materialize(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not repeated.limit(1).count():
        return kept
    repeated = broadcast_if_small(repeated)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(kept.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"]))
