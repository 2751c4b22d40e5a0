"""Greedy, non-transitive choice by rank: a row goes if a better row that stays is near it.

This is the maximal independent set that the order of the rows gives. Rows without a better undecided neighbour stay, their
neighbours go, and the pairs left are settled in the next round. Each round is a few equi-joins over a written table. After
``ROUNDS`` rounds the connected components with at most ``LOCAL_PAIRS`` pairs left are settled in a task each; larger ones go
on by rounds, whatever their size.
"""

from __future__ import annotations

from collections import Counter, defaultdict, deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.components import connected_components
from tessera.storage import discard, materialize

ROUNDS, LOCAL_PAIRS = 4, 100_000


def gone_of(better: list, worse: list) -> set:
    """The nodes that go among the pairs of one component; no pairs form a circle."""
    after, waits = defaultdict(list), Counter(worse)
    for a, b in zip(better, worse, strict=True):
        after[a].append(b)
    ready, gone = deque(x for x in after if not waits[x]), set()
    while ready:
        x = ready.popleft()
        for y in after[x]:
            if x not in gone:
                gone.add(y)
            waits[y] -= 1
            if not waits[y]:
                ready.append(y)
    return gone


def hashable(node):
    """``node`` as a key of a dict: structs come to pandas as dicts, arrays as lists."""
    if isinstance(node, dict):
        return tuple(hashable(x) for x in node.values())
    return tuple(map(hashable, node)) if hasattr(node, "__iter__") and not isinstance(node, (str, bytes)) else node


def dropped(pairs: DataFrame) -> DataFrame:
    """``(node)`` of the rows that go, from ``pairs(better, worse)`` of different nodes of any type that Spark orders; the order must hold no circle."""
    kind = dict(pairs.dtypes)["better"]
    left = materialize(pairs.select("better", "worse").distinct(), "settle")
    parts, rounds, large = [], 0, left.isEmpty()
    while not left.isEmpty():
        if rounds >= ROUNDS and not large:
            roots = connected_components(left, "better", "worse")
            owned = materialize(left.join(roots, left.better == roots.node).select("better", "worse", "component"), "settle-owned")
            sizes = owned.groupBy("component").agg(F.count("*").alias("n"))
            small = sizes.where(F.col("n") <= LOCAL_PAIRS)

            def local(frame: pd.DataFrame) -> pd.DataFrame:
                better, worse = frame["better"].map(hashable), frame["worse"].map(hashable)
                gone = worse.isin(gone_of(better.tolist(), worse.tolist())) & ~worse.duplicated()
                return frame.loc[gone, ["worse"]].rename(columns={"worse": "node"})

            parts.append(materialize(owned.join(small, "component").groupBy("component").applyInPandas(local, f"node {kind}"), "settle-gone"))
            rest = materialize(owned.join(small, "component", "left_anti").select("better", "worse"), "settle")
            discard(left, owned)
            left, large = rest, True
            continue
        stays = left.join(left.select(F.col("worse").alias("better")).distinct(), "better", "left_anti")
        gone = materialize(stays.select(F.col("worse").alias("node")).distinct(), "settle-gone")
        rest = left.join(gone, left.better == gone.node, "left_anti")
        rest = materialize(rest.join(gone, rest.worse == gone.node, "left_anti"), "settle")
        discard(left)
        left, rounds = rest, rounds + 1
        parts.append(gone)
    out = left.select(F.col("better").alias("node"))
    for p in parts:
        out = out.union(p)
    return out.distinct()


def settle(pairs: DataFrame, better: Column) -> DataFrame:
    """``(dropped, of)`` from ``pairs(a, b)`` with the condition that ``a`` precedes ``b``: each row that goes and the best row that stays near it.

    ``rank_a`` and ``rank_b`` of ``pairs`` order the rows that stay, the least first.
    """
    side = lambda x, y: (F.when(better, F.col(x)).otherwise(F.col(y)))
    ordered = materialize(pairs.select(side("a", "b").alias("better"), side("b", "a").alias("worse"), side("rank_a", "rank_b").alias("rank")), "settle-pairs")
    gone = materialize(dropped(ordered), "settle-gone")
    kept = ordered.join(gone, ordered.better == gone.node, "left_anti").join(gone.select(F.col("node").alias("worse")), "worse", "left_semi")
    return kept.groupBy(F.col("worse").alias("dropped")).agg(F.min_by("better", "rank").alias("of"))
