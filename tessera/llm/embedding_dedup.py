"""Embedding near-duplicates: PCA-ordered tiled comparison with suffix-norm bounds.

Vectors are normalised and rotated to the principal axes of the whole table, so that the leading dimensions carry most
of a dot product. Blocks are cut along the first axis; two blocks meet only if that axis leaves a distance that the
threshold allows. Inside a pair of blocks, tiles first multiply the leading dimensions and add the product of the suffix
norms (Cauchy-Schwarz), which bounds the cosine from above; only pairs whose bound reaches the threshold go on to the next
dimensions. Values within rounding of the threshold are taken from the vectors as they came.

Equal vectors are joined first and compared once. A pair of blocks gives each vector's number of links and a spanning
forest of what it linked, never the pairs themselves. Vectors that are null, empty, zero or hold null or non-finite
components link with nothing, nor do vectors of different lengths or rows with a null id; repeated rows count as vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.components import connected_components
from tessera.storage import materialize

NEAR = 1e-9
TILE = 1024


def forest(n: int, u: np.ndarray, v: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Least index that each of ``n`` nodes reaches by the edges, from earlier roots on."""
    root = np.arange(n) if root is None else root
    while len(u):
        a, b = root[u], root[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def linked(a: np.ndarray, b: np.ndarray, threshold: float, raw_a: np.ndarray, raw_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``a`` and ``b`` (rotated unit vectors) whose cosine reaches ``threshold``."""
    dims = a.shape[1]
    cuts = [max(1, dims // 4), max(1, dims // 2), dims]
    suffix = [[np.sqrt(np.maximum(0, 1 - (x[:, :k] ** 2).sum(1))) for k in cuts] for x in (a, b)]
    bound = np.hstack([a[:, : cuts[0]], suffix[0][0][:, None]]) @ np.hstack([b[:, : cuts[0]], suffix[1][0][:, None]]).T
    i, j = np.nonzero(bound >= threshold - NEAR)
    if len(i) > 0.05 * bound.size:
        value = a @ b.T
        i, j = np.nonzero(value >= threshold - NEAR)
        value = value[i, j]
    else:
        value = np.einsum("nd,nd->n", a[i, : cuts[0]], b[j, : cuts[0]])
        for k, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False), 1):
            value = value + np.einsum("nd,nd->n", a[i, low:high], b[j, low:high])
            on = value + (suffix[0][k][i] * suffix[1][k][j] if high < dims else 0) >= threshold - NEAR
            i, j, value = i[on], j[on], value[on]
    edge = np.flatnonzero(np.abs(value - threshold) <= NEAR)
    if len(edge):
        x, y = raw_a[i[edge]], raw_b[j[edge]]
        cosine = np.einsum("nd,nd->n", x, y) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
        keep = np.ones(len(i), bool)
        keep[edge[cosine < threshold]] = False
        i, j = i[keep], j[keep]
    return i, j


def unit(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _rotation(classes: DataFrame, dims: int) -> np.ndarray:
    """Principal axes of all unit vectors, strongest first; one dims x dims matrix reaches the driver."""
    upper = np.triu_indices(dims)

    def moments(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            x = unit(np.array(batch["v"].tolist()))
            total += x.T @ x
        yield pd.DataFrame({"at": np.arange(len(upper[0])), "x": total[upper]})

    total = np.zeros((dims, dims))
    for r in classes.select("v").mapInPandas(moments, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
        total[upper[0][r["at"]], upper[1][r["at"]]] = r["x"]
    return np.linalg.eigh(total + np.triu(total, 1).T)[1][:, ::-1].copy()


def _compare(classes: DataFrame, dims: int, threshold: float, block_rows: int) -> DataFrame:
    """``(rep, links, root)`` partial results over all pairs of blocks."""
    axes = _rotation(classes, dims)
    n = classes.count()
    blocks = max(1, -(-n // block_rows))

    @F.pandas_udf("double")
    def lead(v: pd.Series) -> pd.Series:
        return pd.Series(unit(np.array(v.tolist())) @ axes[:, 0])

    rows = materialize(classes.select("rep", "n", "v", lead("v").alias("lead")), "vectors")
    cuts = rows.agg(F.percentile_approx("lead", F.array(*[F.lit(k / blocks) for k in range(1, blocks)]), 100 * blocks)).first()[0] if blocks > 1 else []
    cuts = np.unique(np.array(cuts, float))

    @F.pandas_udf("int")
    def block(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, x.to_numpy(), "right").astype("int32"))

    rows = rows.withColumn("block", block("lead"))
    # along one axis two unit vectors that reach the threshold are at most this far apart
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    span = rows.groupBy("block").agg(F.min("lead").alias("low"), F.max("lead").alias("high"))
    spans = sorted((r.block, r.low, r.high) for r in span.collect())  # one row a block
    meets = [(b, min(x for x, lo, hi in spans if x <= b and hi >= low - reach), max(x for x, lo, hi in spans if x >= b and lo <= high + reach)) for b, low, high in spans] if len(spans) < 2000 else _meets(spans, reach)
    table = F.broadcast(rows.sparkSession.createDataFrame(meets, "block int, first int, last int"))
    dealt = rows.join(table, "block").select("rep", "n", "v", "block", F.explode(F.sequence("first", "last")).alias("other"))
    dealt = dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        i, j = key
        frame = frame.sort_values("rep", kind="stable")
        sides = [frame[frame["block"] == i], frame[frame["block"] == j]] if i != j else [frame, frame]
        raw = [np.array(s["v"].tolist(), float).reshape(len(s), dims) for s in sides]
        turned = [unit(x) @ axes if len(x) else x for x in raw]
        weight = [s["n"].to_numpy() for s in sides]
        shift = len(sides[0]) if i != j else 0
        total = len(sides[0]) + (len(sides[1]) if i != j else 0)
        links, root = np.zeros(total, np.int64), np.arange(total)
        for x in range(0, len(raw[0]), TILE):
            for y in range(x if i == j else 0, len(raw[1]), TILE):
                p, q = linked(turned[0][x : x + TILE], turned[1][y : y + TILE], threshold, raw[0][x : x + TILE], raw[1][y : y + TILE])
                p, q = p + x, q + y
                if i == j:
                    upper = p < q
                    p, q = p[upper], q[upper]
                if len(p):
                    links += np.bincount(p, weights=weight[1][q], minlength=total).astype(np.int64)
                    links += np.bincount(q + shift, weights=weight[0][p], minlength=total).astype(np.int64)
                    root = forest(total, p, q + shift, root)
        rep = np.concatenate([s["rep"].to_numpy() for s in (sides if i != j else sides[:1])]) if total else np.empty(0, np.int64)
        some = np.flatnonzero(links)
        return pd.DataFrame({"rep": rep[some], "links": links[some], "root": rep[root[some]]})

    return dealt.groupBy("i", "j").applyInPandas(run, "rep long, links long, root long")


def _meets(spans: list[tuple], reach: float) -> list[tuple[int, int, int]]:
    """As the plain search, for many blocks: spans are sorted and do not overlap by more than their ends."""
    ids, lows, highs = (np.array(x) for x in zip(*spans, strict=True))
    first = np.minimum(np.searchsorted(highs, lows - reach, "left"), np.arange(len(ids)))
    last = np.maximum(np.searchsorted(lows, highs + reach, "right") - 1, np.arange(len(ids)))
    return [(int(b), int(ids[f]), int(ids[z])) for b, f, z in zip(ids, first, last, strict=True)]


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, vector: str = "embedding", block_rows: int = 4096) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    v = F.col(vector).cast("array<double>")
    sound = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", F.when(sound, v).alias("v"))
    # equal vectors have equal text; zeros lose their sign first
    rows = rows.withColumn("class", F.when(F.col("v").isNotNull(), F.unhex(F.md5(F.transform("v", lambda x: x + F.lit(0.0)).cast("string").cast("binary")))))
    classes = rows.where("v is not null").groupBy("class").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("v").alias("v"))
    classes = materialize(classes, "classes")
    sizes = [r[0] for r in classes.select(F.size("v")).distinct().collect()]  # few lengths, one as a rule
    members = rows.select("vec_id", "class").join(classes.select("class", "rep", "n"), "class", "left")
    parts = [materialize(_compare(classes.where(F.size("v") == d), d, threshold, block_rows), "links") for d in sizes]
    if not parts:
        return members.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    links = parts[0]
    for more in parts[1:]:
        links = links.union(more)
    roots = connected_components(links.select("rep", "root"), "rep", "root")
    counts = links.groupBy("rep").agg(F.sum("links").alias("links")).join(roots.select(F.col("node").alias("rep"), "component"), "rep", "left")
    out = members.join(counts, "rep", "left")
    component = F.coalesce("component", "rep", "vec_id")
    n_links = F.coalesce(F.col("n") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    return out.select("vec_id", n_links.cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
