"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.storage import discard, materialize


#: Edges of a node beyond which it is looked up in a broadcast table; that has at most two rows for as many edges.
HUB_EDGES = 100_000
#: Nodes that a task of ``spanning`` keeps at most; then it starts anew.
SPAN_NODES = 1 << 20


def _with_least(edges: DataFrame, end: str, least: DataFrame) -> DataFrame:
    """``(u, v, m)``: ``edges`` with the least neighbour of their ``end``, from ``least(x, m, n)``; edges of a hub never meet in one task."""
    hubs = least.where(F.col("n") > HUB_EDGES).select(F.col("x").alias("hub"), F.col("m").alias("hub_m"))
    marked = edges.join(F.broadcast(hubs), F.col(end) == F.col("hub"), "left")
    plain = marked.where("hub IS NULL").select("u", "v").join(least.select("x", "m"), F.col(end) == F.col("x"))
    return plain.select("u", "v", "m").union(marked.where("hub IS NOT NULL").select("u", "v", "hub_m"))


def spanning(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(src, dst)``: of the edges that a task reads, those that join two of its trees; the components stay the same.

    For pairs that come from few nodes a task, before they are shuffled. Edges with a null end are left out.
    """

    def thin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        up: dict = {}

        def root(x):
            while (above := up.setdefault(x, x)) != x:
                up[x] = up[above]
                x = above
            return x

        for f in frames:
            kept = []
            for a, b in zip(f[src].tolist(), f[dst].tolist(), strict=True):
                ra, rb = root(a), root(b)
                if ra != rb:
                    up[ra] = rb
                    kept.append((a, b))
            yield pd.DataFrame(kept, columns=[src, dst])
            if len(up) > SPAN_NODES:
                up.clear()

    e = edges.select(src, dst).where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    return e.mapInPandas(thin, e.schema)


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an edge between two different nodes; component is the least node.

    Edges with a null end and self loops are ignored, repeated edges count once; without edges the result is empty.
    Minima are partial aggregates, so a hub that owns a third of the edges is combined before the shuffle; adaptive execution
    does not split joins with an aggregate, so the edges of hubs are joined by broadcast. Each round is written to the shared
    folder and the round before it deleted.
    """
    a, b = F.col(src), F.col(dst)
    cur = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    cur = materialize(cur.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "components")
    sign = _signature(cur)
    for _ in range(max_rounds):
        if not sign[0]:
            break
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"), "n")
        least = materialize(least, "components-least")
        large = materialize(_with_least(cur, "v", least).select("u", F.col("m").alias("v")).distinct(), "components-large")
        low = materialize(large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"), F.count("*").alias("n")), "components-least")
        rest = _with_least(large, "u", low).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = materialize(rest.union(low.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct(), "components")
        discard(least, large, low)
        discard(cur)
        cur = nxt
        before, sign = sign, _signature(cur)
        if sign == before:
            break
    else:
        raise RuntimeError(f"no fixpoint after {max_rounds} rounds")
    star = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.union(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
