"""Hard negatives by a multiway hyperplane tree with range tables (after GNAT, Brin 1995); the result is exact.

Rows are integer vectors that are compared by inner product. One more coordinate gives all rows the same length, so that a
greater product with a query is a smaller Euclidean distance, and a window of scores is an annulus around the query. Each
node of the tree has a few split points; a row belongs to the nearest one. For each pair of split points the node stores the
range of distances from the one to all rows under the other. A query's distances to the split points then bound its
distances to each subtree, by those ranges and by the hyperplanes between split points; subtrees that no annulus of the
query meets are left out, and every row of the other leaves is compared. A query first visits the leaf that it would
belong to; the k-th best score found there narrows its annuli for the rest.

The split points come from a bounded sample of rows (``SAMPLE_ROWS``), the ranges and leaves from all rows. Neighbouring
leaves of few rows form a bundle, which a query meets once, if it may meet any of its leaves. Bundles and queries are dealt
in blocks of bounded size, so that no leaf, label or group of copies is one task's work, and a query's way to the leaves is
found for a bounded number of queries at a time (``ROUTE_PAIRS``). Of equal vectors
with equal labels only those with the least ids can be among the first, so no more are indexed than are asked for; equal
queries are asked once.

Rows with a null id, label or vector or a null component take no part. Equal rows count once; rows that share an id but not
their vector or label count each. A shorter vector counts as one that ends in zeros. Ties go to the smaller id. Columns
other than the four named ones are not read. Empty tables give no rows. Scores must fit a long; if components are so
large that they might not, ``ValueError`` is raised.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.storage import empty, materialize

#: Rows from which split points are chosen.
SAMPLE_ROWS = 16384
#: Split points of a node, leaves at most, and rows that a leaf should have.
WAYS, MOST_LEAVES, LEAF_ROWS = 12, 4096, 1024
#: Rows and queries that meet in one group at most, roughly.
BLOCK_ROWS, LOT_QUERIES, TILE = 8192, 8192, 256
#: Pairs of a query's window and a leaf that are held at once while queries are routed.
ROUTE_PAIRS = 1 << 20
LEAST, MOST = -(2**63), 2**63 - 1
WINDOWS = "array<struct<key: bigint, low: bigint, high: bigint>>"


@dataclass
class Node:
    splits: np.ndarray  # lifted split points
    child: list[int]  # a node's number, or -1 - the leaf's number
    apart: np.ndarray
    low: np.ndarray
    high: np.ndarray


@dataclass
class Tree:
    dims: int
    square: float  # of the common length of all lifted rows
    kind: str  # of the stored components
    nodes: list[Node] = field(default_factory=list)
    leaves: int = 0

    def unpack(self, codes: pd.Series) -> np.ndarray:
        return np.frombuffer(b"".join(codes), self.kind).reshape(len(codes), self.dims).astype(np.int64)

    def pack(self, vectors: pd.Series) -> list[bytes]:
        out = []
        for v in vectors:
            row = np.zeros(self.dims, self.kind)
            row[: len(v)] = v
            out.append(row.tobytes())
        return out

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(float)
        return np.hstack([x, np.sqrt(np.maximum(0, self.square - (x * x).sum(1)))[:, None]])

    @property
    def slack(self) -> float:
        """More than distances are off by rounding."""
        return 1e-5 * self.square**0.5

    def fit(self, sample: np.ndarray, leaf_rows: float) -> None:
        """Split points from ``sample``, down to leaves of ``leaf_rows`` rows of it."""
        x = self.lifted(np.unique(sample, axis=0)) if len(sample) else np.zeros((1, self.dims + 1))
        rng = np.random.default_rng(0)
        todo = [(x, None, 0)]
        while todo:
            x, parent, place = todo.pop(0)
            if parent is not None and (len(x) <= max(leaf_rows, 2 * WAYS) or self.leaves + WAYS + len(todo) > MOST_LEAVES):
                self.nodes[parent].child[place], self.leaves = -1 - self.leaves, self.leaves + 1
                continue
            some = x[rng.permutation(len(x))[: 3 * WAYS]]
            chosen, near = [0], distances(some, some[:1])[:, 0]
            while len(chosen) < min(WAYS, len(some)):  # each next one is farthest from those chosen
                chosen.append(int(near.argmax()))
                near = np.minimum(near, distances(some, some[chosen[-1:]])[:, 0])
            splits, at = some[chosen], len(self.nodes)
            m = len(splits)
            self.nodes.append(Node(splits, [0] * m, distances(splits, splits), np.full((m, m), np.inf), np.full((m, m), -np.inf)))
            if parent is not None:
                self.nodes[parent].child[place] = at
            own = distances(x, splits).argmin(1)
            todo += [(x[own == j], at, j) for j in range(m)]

    def places(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each node that rows ``x`` (lifted) pass: its number, the rows, their distances to its split points, the nearest."""
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            d = distances(x[rows], self.nodes[at].splits)
            nearest = d.argmin(1)
            yield at, rows, d, nearest
            for j, child in enumerate(self.nodes[at].child):
                if child >= 0 and (own := rows[nearest == j]).size:
                    todo.append((child, own))

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each of the lifted rows."""
        out = np.zeros(len(x), np.int32)
        for at, rows, _, nearest in self.places(x):
            child = np.array(self.nodes[at].child)[nearest]
            out[rows[child < 0]] = -1 - child[child < 0]
        return out

    def visits(self, q: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) wherever the annulus of ``near`` to ``far`` around a query may hold a row of the leaf."""
        found, todo = [], [(0, np.arange(len(q)))]
        while todo:
            at, own = todo.pop()
            node = self.nodes[at]
            d = np.sqrt(np.maximum(0, (q[own] ** 2).sum(1)[:, None] + self.square - 2 * q[own] @ node.splits[:, :-1].T))
            low, high = np.zeros(d.shape), np.full(d.shape, np.inf)
            for i in range(d.shape[1]):
                low = np.maximum(low, np.maximum(d[:, i : i + 1] - node.high[i], node.low[i] - d[:, i : i + 1]))
                high = np.minimum(high, d[:, i : i + 1] + node.high[i])
                with np.errstate(divide="ignore", invalid="ignore"):  # how far beyond the hyperplane between i and j
                    plane = (d**2 - d[:, i : i + 1] ** 2) / (2 * node.apart[i])
                low = np.maximum(low, np.where(node.apart[i] > self.slack, plane, 0))
            meets = (low - self.slack <= far[own][:, None]) & (high + self.slack >= near[own][:, None])
            for j, child in enumerate(node.child):
                some = own[meets[:, j]]
                if some.size and child >= 0:
                    todo.append((child, some))
                elif some.size:
                    found.append((some, np.full(len(some), -1 - child)))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T))


def _annuli(tree: Tree, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distances of scores ``low`` to ``high``."""
    total = (q**2).sum(1) + tree.square
    near = np.where(high == MOST, 0, np.sqrt(np.maximum(0, total - 2.0 * high)))
    return near, np.where(low == LEAST, np.inf, np.sqrt(np.maximum(0, total - 2.0 * low)))


def build(rows: DataFrame) -> tuple[Tree, DataFrame] | None:
    """The tree over ``rows`` (id, label, class, v) and its table ``(id, label, leaf, code)``; none if there are no rows."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    t = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims"), F.max(square).alias("square"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("top")).first()
    if not t.n:
        return None
    top, dims = t.top or 0, max(1, t.dims)
    if dims * top * top >= 2**63:
        raise ValueError("scores of these vectors may not fit a long")
    tree = Tree(dims, float(t.square or 0), "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<i8")
    share = min(1.0, SAMPLE_ROWS / t.n)
    sample = rows.where(F.pmod(F.xxhash64("class"), F.lit(1 << 30)) < int(share * (1 << 30)))
    tree.fit(tree.unpack(pd.Series(tree.pack([r.v for r in sample.select("v").toLocalIterator()]))), LEAF_ROWS * share)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            code = pd.Series(tree.pack(b["v"]))
            if len(b):
                yield pd.DataFrame({"id": b["id"], "label": b["label"], "leaf": tree.leaf(tree.lifted(tree.unpack(code))), "code": code})

    kind = dict(rows.dtypes)
    index = materialize(rows.select("id", "label", "v").mapInPandas(place, f"id {kind['id']}, label {kind['label']}, leaf int, code binary"), "gnat")

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high = ([np.array(getattr(n, k)) for n in tree.nodes] for k in ("low", "high"))
        for b in batches:
            for at, _, d, nearest in tree.places(tree.lifted(tree.unpack(b["code"]))):
                for j in np.unique(nearest):
                    low[at][:, j] = np.minimum(low[at][:, j], d[nearest == j].min(0))
                    high[at][:, j] = np.maximum(high[at][:, j], d[nearest == j].max(0))
        for at, (x, y) in enumerate(zip(low, high, strict=True)):
            i, j = np.nonzero(x <= y)
            yield pd.DataFrame({"node": at, "i": i, "j": j, "low": x[i, j], "high": y[i, j]})

    table = index.select("code").mapInPandas(spans, "node int, i int, j int, low double, high double")
    for r in table.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).toLocalIterator():  # by MOST_LEAVES and WAYS
        tree.nodes[r.node].low[r.i, r.j], tree.nodes[r.node].high[r.i, r.j] = r.low, r.high
    return tree, index


def bundles(tree: Tree, index: DataFrame) -> list[tuple[int, int, int]]:
    """(leaf, bundle, blocks of the bundle): neighbouring leaves of up to ``BLOCK_ROWS`` rows together; a larger leaf alone, in blocks."""
    rows = {r["leaf"]: r["n"] for r in index.groupBy("leaf").agg(F.count("*").alias("n")).toLocalIterator()}  # by MOST_LEAVES
    of, held = [], [0]
    for leaf in range(tree.leaves):
        n = rows.get(leaf, 0)
        if held[-1] and held[-1] + n > BLOCK_ROWS:
            held.append(0)
        held[-1] += n
        of.append(len(held) - 1)
    return [(leaf, b, max(1, -(-held[b] // BLOCK_ROWS))) for leaf, b in enumerate(of)]


def routed(tree: Tree, of: np.ndarray, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows of ``batch`` (qid, label, code, home, windows) once for each bundle but their home's that one of their windows may meet.

    ``of`` has the bundle of each leaf, in ascending order. About ``ROUTE_PAIRS`` pairs of a window and a leaf are held at once.
    """
    batch = batch[batch["windows"].map(len) > 0]
    ends = batch["windows"].map(len).cumsum().to_numpy()
    part = ends // max(1, ROUTE_PAIRS // tree.leaves)
    for start, end in zip(*(lambda cuts: (np.r_[0, cuts], np.r_[cuts, len(batch)]))(np.flatnonzero(np.diff(part)) + 1), strict=True):
        b = batch.iloc[start:end]
        if len(b):
            row = np.repeat(np.arange(len(b)), [len(w) for w in b["windows"]])
            low, high = (np.array([w[k] for ws in b["windows"] for w in ws], np.int64) for k in ("low", "high"))
            q = tree.unpack(b["code"]).astype(float)[row]
            at, leaf = tree.visits(q, *_annuli(tree, q, low, high))
            meets = np.zeros((len(b), int(of[-1]) + 1), bool)
            meets[row[at], of[leaf]] = True
            meets[np.arange(len(b)), of[b["home"].to_numpy()]] = False
            at, bundle = np.nonzero(meets)
            yield b.iloc[at].assign(bundle=bundle.astype("int32"))


def _route(tree: Tree, places: list[tuple[int, int, int]], queries: DataFrame, n: int) -> DataFrame:
    """The ``n`` ``queries`` (qid, label, code, home, windows) once for each bundle but that of their home that one of their windows may meet."""
    of = np.array([b for _, b, _ in places])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield from routed(tree, of, b)

    spread = queries.repartition(max(1, -(-n * tree.leaves // ROUTE_PAIRS)), "qid")
    return spread.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in queries.dtypes) + ", bundle int")


def _meet(tree: Tree, index: DataFrame, places: list[tuple[int, int, int]], lots: int, visits: DataFrame, k: int, same: bool) -> DataFrame:
    """``(qid, key, score, id)``: the first ``k`` rows of each group of a bundle's block and a lot of queries, by window."""

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(rows) and len(asked):
            rows = rows.sort_values("id", kind="stable")
            ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
            x, q = tree.unpack(rows["code"]), tree.unpack(asked["code"])
            if tree.dims * float(np.abs(x).max()) * float(np.abs(q).max()) < 2**53:  # then floats hold every sum
                x, q = x.astype(float), q.astype(float)
            for t in range(0, len(q), TILE):
                scores = (q[t : t + TILE] @ x.T).astype(np.int64)
                for s, qid, label, windows in zip(scores, asked["qid"][t : t + TILE], asked["label"][t : t + TILE], asked["windows"][t : t + TILE], strict=True):
                    fit = np.flatnonzero((labels == label) == same)
                    s = s[fit]
                    for w in windows:
                        at = np.flatnonzero((s >= w["low"]) & (s <= w["high"]))
                        if len(at) > k:
                            at = at[s[at] >= np.partition(s[at], len(at) - k)[len(at) - k]]
                        at = at[np.argsort(-s[at], kind="stable")[:k]]
                        out += [(qid, w["key"], int(s[i]), ids[fit[i]]) for i in at]
        return pd.DataFrame(out, columns=["qid", "key", "score", "id"])

    key = ["bundle", "block", "lot"]
    table = lambda rows, schema: F.broadcast(index.sparkSession.createDataFrame(rows, schema))
    rows = index.join(table(places, "leaf int, bundle int, blocks int"), "leaf").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.select("id", "label", "code", "bundle", "block", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"))
    asked = visits.join(table(sorted({x[1:] for x in places}), "bundle int, blocks int"), "bundle").withColumn("lot", F.pmod(F.xxhash64("qid"), F.lit(lots)).cast("int"))
    asked = asked.select("qid", "label", "code", "windows", "bundle", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "lot")
    return rows.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(run, f"qid binary, key bigint, score bigint, id {dict(index.dtypes)['id']}")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid", "key").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(tree: Tree, index: DataFrame, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """``(qid, key, score, id, rank)``: for each window of ``queries`` (qid, label, code, home, windows) its first ``k`` rows.

    Only rows of the query's own label are taken if ``same``, else only those of other labels.
    """
    places = bundles(tree, index)
    n = queries.count()
    lots = max(1, -(-n // LOT_QUERIES))
    own = queries.join(F.broadcast(index.sparkSession.createDataFrame([x[:2] for x in places], "home int, bundle int")), "home")
    home = materialize(_first(_meet(tree, index, places, lots, own, k, same), k), "gnat-home")
    bound = home.where(F.col("rank") == k).groupBy("qid").agg(F.map_from_entries(F.collect_list(F.struct("key", "score"))).alias("bound"))
    raised = F.transform("windows", lambda w: F.struct(w["key"].alias("key"), F.coalesce(F.greatest(w["low"], F.col("bound")[w["key"]]), w["low"]).alias("low"), w["high"].alias("high")))
    narrowed = queries.join(bound, "qid", "left").select("qid", "label", "code", "home", raised.alias("windows"))
    rest = _meet(tree, index, places, lots, _route(tree, places, narrowed, n), k, same)
    return _first(home.drop("rank").unionByName(rest), k)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, vec_id: str = "vec_id", label: str = "label", vector: str = "vector") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` over all rows.

    ``rows`` has integer vectors (array<bigint>). Where ``anchor`` holds of a row, its first ``positives`` other rows of its
    label are its positives; for each, the first ``negatives`` rows of other labels are given whose score is ``low`` to
    ``high`` percent of the positive's.
    """
    rows = rows.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<bigint>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    rows = rows.withColumn("class", F.unhex(F.sha2(F.concat_ws("|", F.col("label").cast("string"), F.array_join("v", ",")), 256)))
    least = Window.partitionBy("class").orderBy("id")
    kept = rows.withColumn("r", F.dense_rank().over(least)).where(F.col("r") <= max(positives + 1, negatives)).groupBy("class", "id").agg(F.first("label").alias("label"), F.first("v").alias("v"))
    kept = materialize(kept, "gnat-rows")
    built = build(kept)
    kind = dict(kept.dtypes)["id"]
    if built is None:
        return empty(rows.sparkSession, f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score bigint, negative_score bigint")
    tree, index = built
    anchors = materialize(rows.where("anchor").select("class", "id").distinct(), "gnat-anchors")

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            code = pd.Series(tree.pack(b["v"]), dtype=object)
            q = tree.unpack(code)
            yield pd.DataFrame({"qid": b["qid"], "label": b["label"], "code": code, "home": tree.leaf(np.hstack([q, np.zeros((len(q), 1))]))})

    asked = kept.join(anchors.select("class").distinct(), "class", "left_semi").groupBy(F.col("class").alias("qid")).agg(F.first("label").alias("label"), F.first("v").alias("v"))
    queries = materialize(asked.mapInPandas(prepare, f"qid binary, label {dict(kept.dtypes)['label']}, code binary, home int"), "gnat-queries")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("key"), F.lit(LEAST).cast("bigint").alias("low"), F.lit(MOST).cast("bigint").alias("high")))
    near = search(tree, index, queries.withColumn("windows", whole), positives + 1, True)
    near = materialize(near.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("near")), "gnat-near")

    scores = near.select("qid", F.array_distinct(F.transform("near", lambda x: x["score"])).alias("scores"))
    window = f"transform(scores, s -> named_struct('key', s, 'low', -((-{low} * s - pmod(-{low} * s, 100)) div 100), 'high', ({high} * s - pmod({high} * s, 100)) div 100))"
    windows = scores.select("qid", F.filter(F.expr(window), lambda w: w["low"] <= w["high"]).cast(WINDOWS).alias("windows"))
    far = search(tree, index, queries.join(windows, "qid"), negatives, False)
    far = far.groupBy("qid", "key").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("far"))

    pairs = anchors.join(near, F.col("class") == F.col("qid")).select("qid", F.col("id").alias("anchor_id"), F.explode(F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, positives)).alias("p"))
    pairs = pairs.select("qid", "anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("key"))
    out = pairs.join(far, ["qid", "key"]).select("anchor_id", "positive_id", F.col("key").alias("positive_score"), F.explode("far").alias("f"))
    return out.select("anchor_id", "positive_id", F.col("f.rank").cast("int").alias("rank"), F.col("f.id").alias("negative_id"), "positive_score", F.col("f.score").alias("negative_score"))
