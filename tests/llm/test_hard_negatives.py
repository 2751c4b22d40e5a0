import math
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import hard_negatives as hn
from tessera.llm.queries import QUERIES

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain(rows, is_anchor):
    """All pairs: rows are (id, label, vector)."""
    rows = sorted({(i, y, tuple(v)) for i, y, v in rows if i is not None and y is not None and v is not None and None not in v})
    dot = lambda a, b: sum(p * q for p, q in zip(a, b, strict=False))
    out = []
    for i, y, v in rows:
        if is_anchor(i):
            scored = sorted((-dot(v, w), j, z) for j, z, w in rows)
            for p, j, _ in [x for x in scored if x[1] != i and x[2] == y][:5]:
                fit = [(-s, k) for s, k, z in scored if z != y and 50 * -p <= 100 * -s <= 95 * -p]
                out += [(i, j, r, k, -p, s) for r, (s, k) in enumerate(fit[:3], 1)]
    return sorted(out)


def mined(frame, every):
    return sorted(tuple(r[c] for c in COLUMNS) for r in hn.hard_negatives(frame, F.col("vec_id") % every == 0).collect())


@pytest.fixture
def small_tree(monkeypatch):
    """Many leaves, blocks and lots from few rows."""
    for name, value in (("WAYS", 4), ("LEAF_ROWS", 30), ("BLOCK_ROWS", 40), ("LOT_QUERIES", 20)):
        monkeypatch.setattr(hn, name, value)


@pytest.mark.parametrize("seed", range(3))
def test_all_pairs(spark, small_tree, seed):
    rng = random.Random(seed)
    centres = [[rng.randrange(-60, 60) for _ in range(6)] for _ in range(5)]
    rows = [(i, rng.randrange(4), [c + rng.randrange(-9, 9) for c in rng.choice(centres)]) for i in range(300)]
    rows += [(i, rng.randrange(2), rows[0][2]) for i in range(300, 400)]  # a hot vector
    rows += rows[:5] + [(7, 0, [1, 2, 3, 4, 5, 6])]  # repeated rows, an id with two vectors
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>").withColumn("class", F.lit("x")).withColumn("id", F.lit(1)).repartition(5)
    want = plain(rows, lambda i: i % 10 == 0)
    assert want and mined(frame, 10) == want


def test_odd_rows(spark, small_tree):
    big = 2**27
    rows = [(0, 1, [big, 1]), (50, 1, [big, 0]), (1, 1, None), (2, None, [1, 1]), (None, 1, [big, 1]), (3, 1, [big, None]), (4, 2, [big * 3 // 5]), (5, 2, []), (6, 2, [big // 2, 9]), (8, 2, [-big, 0]), (100, 3, [0, 0]), (9, 3, [0, 0])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")
    want = plain(rows, lambda i: i % 50 == 0)
    assert want and mined(frame, 50) == want
    assert mined(frame.where("false"), 50) == [] and mined(frame.where("vec_id = 1"), 1) == []
    with pytest.raises(ValueError, match="long"):
        mined(spark.createDataFrame([(0, 1, [2**32, 2**32])], "vec_id long, label int, vector array<long>"), 50)


def test_tree_leaves_out_only_what_cannot_match():
    rng = np.random.default_rng(3)
    x = (rng.integers(-300, 300, (20, 8))[rng.integers(0, 20, 3000)] + rng.integers(-20, 20, (3000, 8))).astype(np.int64)
    tree = hn.Tree(8, float((x**2).sum(1).max()), "<i2")
    tree.fit(x[:1000], 40)
    lifted = tree.lifted(x)
    leaf = tree.leaf(lifted)
    for at, _, d, nearest in tree.places(lifted):
        for j in np.unique(nearest):
            tree.nodes[at].low[:, j], tree.nodes[at].high[:, j] = d[nearest == j].min(0), d[nearest == j].max(0)
    q = x[:60].astype(float)
    scores = (x[:60] @ x.T).astype(np.int64)
    high = np.floor(0.95 * scores.max(1)).astype(np.int64)
    low = (0.8 * scores.max(1)).astype(np.int64)
    at, to = tree.visits(q, *hn._annuli(tree, q, low, high))
    visited = set(zip(at.tolist(), to.tolist(), strict=True))
    need = {(i, int(leaf[j])) for i, j in zip(*np.nonzero((scores >= low[:, None]) & (scores <= high[:, None])), strict=True)}
    assert need <= visited
    assert len(visited) < 0.6 * len(q) * tree.leaves


def wide_tree(leaves, dims=4):
    """One node of ``leaves`` leaves, all of which every query meets."""
    rng = np.random.default_rng(5)
    tree = hn.Tree(dims, 1e6, "<i2", leaves=leaves)
    splits = tree.lifted(rng.integers(-300, 300, (leaves, dims)))
    tree.nodes.append(hn.Node(splits, [-1 - j for j in range(leaves)], hn.distances(splits, splits), np.zeros((leaves, leaves)), np.full((leaves, leaves), 1e9)))
    return tree


def asked_of(n, windows, tree):
    whole = [{"key": j, "low": hn.LEAST, "high": hn.MOST} for j in range(windows)]
    code = tree.pack(pd.Series([[i % 90, 1] for i in range(n)]))
    return pd.DataFrame({"qid": [b"%d" % i for i in range(n)], "label": 0, "code": code, "home": [i % tree.leaves for i in range(n)], "windows": [whole] * n})


def test_routes_of_many_queries_are_found_in_bounded_memory(monkeypatch):
    """10,000 queries of three windows, all of which meet 100 leaves: 3 million pairs."""
    monkeypatch.setattr(hn, "ROUTE_PAIRS", 1 << 15)
    tree, batch = wide_tree(100), asked_of(10_000, 3, wide_tree(100))
    tracemalloc.start()
    try:
        n = largest = 0
        for part in hn.routed(tree, np.arange(100) // 10, batch):
            n, largest = n + len(part), max(largest, len(part))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 10_000 * 9 and largest <= 1100 and peak < 8 << 20


def test_a_query_meets_each_bundle_once(monkeypatch):
    monkeypatch.setattr(hn, "ROUTE_PAIRS", 60)
    tree = wide_tree(7)
    batch = asked_of(25, 2, tree)
    batch.at[3, "windows"] = []
    of = np.array([0, 0, 1, 1, 1, 2, 3])
    got = sorted((r.qid, r.bundle) for part in hn.routed(tree, of, batch) for r in part.itertuples())
    assert got == sorted((b"%d" % i, b) for i in range(25) for b in range(4) if i != 3 and b != of[i % 7])
    assert list(hn.routed(tree, of, batch[:0])) == list(hn.routed(tree, of, batch[3:4])) == []


def test_query(spark, sf):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rows = [(i, (y + 1) % 10 if i % 7 == 0 else y, [math.floor(256 * float(c)) for c in v]) for i, y, v in rows]
    got = sorted(tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_hard_negatives"](spark, sf).collect())
    assert got == plain(rows, lambda i: i % 50 == 0)
