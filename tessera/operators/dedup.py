"""Duplicates of assets: exact groups, Hamming and correlation joins, similarity tests, keepers, greedy passes."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.components import connected_components
from tessera.operators.correlate import correlated_pairs  # noqa: F401
from tessera.operators.settle import dropped, hashable, settle
from tessera.storage import broadcast_if_small, materialize

#: Boxes of one image and label that are settled in one task, and rounds of them that a larger one takes.
LOCAL_BOXES, FRONTS = 100_000, 8
#: Boxes that are judged together, by rank, and those of them that meet others at once.
HEAD, NEIGHBOURS = 128, 16
EDGES = ["x1", "y1", "x2", "y2"]


def sign_bits(v: Column) -> Column:
    """64 sign bits as a signed long: bit i is set when element i is positive."""
    return F.aggregate(F.transform(v, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _bands(code: Column, distance: int) -> list[Column]:
    """The bits of a code in distance + 1 bands: two codes within the distance agree in one of them."""
    bands = distance + 1
    edges = [round(i * 64 / bands) for i in range(bands + 1)]
    return [F.struct(F.lit(i).alias("i"), F.call_function("shiftrightunsigned", F.call_function("shiftleft", code, F.lit(64 - hi)), F.lit(64 - hi + lo)).alias("bits")) for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))]


def hamming_pairs(codes: DataFrame, key: str, code: str, distance: int) -> DataFrame:
    """``(a, b, distance)`` of codes within ``distance``: one of distance + 1 bands must agree, so bands are joined and pairs verified."""
    dealt = codes.select(F.col(key).alias("a"), F.col(code).alias("ca"), F.explode(F.array(*_bands(F.col(code), distance))).alias("band"))
    other = dealt.select(F.col("a").alias("b"), F.col("ca").alias("cb"), "band")
    near = dealt.join(other, "band").where("a < b").withColumn("distance", hamming(F.col("ca"), F.col("cb")))
    return near.where(F.col("distance") <= distance).select("a", "b", F.col("distance").cast("long").alias("distance")).distinct()


def near_codes(rows: DataFrame, key: str, code: str, aspect: str, distance: int, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """``(pairs, members)``: near pairs of codes whose aspect ratios differ by at most ``tolerance`` of the larger one.

    Rows with equal code and aspect are one class, of its least key: ``members(key, rep)`` and ``pairs(a, b, distance, n_a, n_b)`` of
    the classes. Ratios are dealt to buckets of their logarithm as wide as the tolerance, so near ones are in the same or
    the next bucket, which the bands are joined with. Null codes and ratios that are null, not finite or not positive pair
    with nothing; ``tolerance`` is at least 0 and below 1.
    """
    if not 0 <= tolerance < 1:
        raise ValueError("the tolerance is a share of the larger ratio")
    reps, members = fold_classes(rows.select(key, F.col(code).alias("code"), F.col(aspect).cast("double").alias("ratio")), ["code", "ratio"], key, [])
    usable = reps.where(F.col("code").isNotNull() & (F.col("ratio") > 0) & (F.col("ratio") < float("inf")))
    # a little wider than the tolerance, so that rounding of logarithms parts no pair; pairs are verified on the ratios
    step = F.floor(F.ln("ratio") / F.lit(-math.log1p(-tolerance) + 1e-9))
    band = F.explode(F.array(*_bands(F.col("code"), distance)))
    dealt = usable.select(F.col(key).alias("a"), F.col("code").alias("ca"), F.col("ratio").alias("ra"), F.col("n").alias("n_a"), step.alias("step"), band.alias("band"))
    other = dealt.select(F.col("a").alias("b"), F.col("ca").alias("cb"), F.col("ra").alias("rb"), F.col("n_a").alias("n_b"), F.explode(F.array("step", F.col("step") + 1)).alias("step"), F.col("step").alias("own"), "band")
    near = dealt.join(other, ["step", "band"]).where((F.col("own") != F.col("step")) | (F.col("a") < F.col("b")))
    near = near.withColumn("distance", hamming(F.col("ca"), F.col("cb")).cast("long"))
    near = near.where((F.col("distance") <= distance) & (F.abs(F.col("ra") - F.col("rb")) <= tolerance * F.greatest("ra", "rb")))
    first = F.col("a") < F.col("b")
    ends = [F.when(first, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (("a", "b", "a"), ("b", "a", "b"), ("n_a", "n_b", "n_a"), ("n_b", "n_a", "n_b"))]
    return near.select(*ends, "distance").distinct(), members


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row; named in a lambda itself, it would be computed again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def signature(v: Column) -> Column:
    """Mean-centred and L2-normalised; a constant vector stays zero."""
    d = v.cast("array<double>")
    mean = F.try_divide(F.aggregate(d, F.lit(0.0), lambda a, x: a + x), F.size(d))
    centred = _let(mean, lambda m: F.transform(d, lambda x: x - m))
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))
    return _let(centred, lambda c: _let(norm(c), lambda n: F.transform(c, lambda x: F.when(n > 0, x / n).otherwise(0.0))))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def ssim(a: Column, b: Column) -> Column:
    """Global SSIM of two arrays on a 0..255 scale, population variance."""
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.size(v)
    ma, mb = mean(a), mean(b)
    va, vb = (F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x) / F.size(v) - m * m for v, m in ((a, ma), (b, mb)))
    cov = dot(a, b) / F.size(a) - ma * mb
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    return ((2 * ma * mb + c1) * (2 * cov + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2))


def differences(a: Column, b: Column, block: int = 8) -> Column:
    """Struct of mean, maximum and largest block mean of the absolute differences of two 8 x 8 ... arrays, row by row."""
    d = F.zip_with(a, b, lambda x, y: F.abs(x - y))
    blocks = F.transform(F.sequence(F.lit(0), F.call_function("div", F.size(d) - 1, F.lit(block)).cast("int")), lambda i: F.aggregate(F.slice(d, i * block + 1, F.lit(block)), F.lit(0.0), lambda s, x: s + x) / block)
    return F.struct((F.aggregate(d, F.lit(0.0), lambda s, x: s + x) / F.size(d)).alias("mean"), F.array_max(d).alias("max"), F.array_max(blocks).alias("block"))


def keeper_rank(df: DataFrame, group: str, order: list, ident: str) -> DataFrame:
    """``(group, keeper, n)``: the best row of each group of two or more."""
    return df.groupBy(group).agg(F.max_by(ident, F.struct(*order)).alias("keeper"), F.count("*").alias("n")).where("n > 1")


def judged_pairs(near: DataFrame, rows: DataFrame, key: str, pixels: str) -> DataFrame:
    """``near(a, b, distance)`` with ``ssim`` and the differences ``d`` of the two rows' arrays."""
    side = lambda k, p: rows.select(F.col(key).alias(k), F.col(pixels).alias(p))
    j = near.join(side("a", "pa"), "a").join(side("b", "pb"), "b")
    return j.select("a", "b", "distance", ssim(F.col("pa"), F.col("pb")).alias("ssim"), differences(F.col("pa"), F.col("pb")).alias("d"))


def dedup_tiers(rows: DataFrame, key: str, pixels: str, code: str, order: list, distance: int = 4, same: float = 0.995, review: float = 0.97) -> DataFrame:
    """``(tier, decision, keeper, dropped, distance, ssim)`` of exact, near and similar rows; a similar pair is only reported.

    The keepers of exact groups and the rows without one are compared. Only pairs with SSIM ``same`` are united,
    and near rows carry the distance and SSIM to their keeper. Keepers are best by ``order``.
    """
    digest = F.sha2(F.array_join(F.transform(pixels, lambda x: x.cast("string")), ","), 256)
    groups = materialize(keeper_rank(rows.withColumn("h", digest), "h", order, key), "exact")
    exact = materialize(rows.withColumn("h", digest).join(groups, "h").where(F.col(key) != F.col("keeper")).select("keeper", F.col(key).alias("dropped")), "exact")
    left = materialize(rows.join(exact, F.col(key) == F.col("dropped"), "left_anti"), "left")
    judged = materialize(judged_pairs(hamming_pairs(left, key, code, distance), left, key, pixels).where(F.col("ssim") >= review).drop("d"), "judged")
    member = materialize(left.join(connected_components(judged.where(F.col("ssim") >= same), "a", "b"), F.col(key) == F.col("node")), "member")
    kept = keeper_rank(member, "component", order, key).join(left.select(F.col(key).alias("keeper"), F.col(pixels).alias("pa"), F.col(code).alias("ca")), "keeper")
    near = member.join(kept, "component").where(F.col(key) != F.col("keeper"))
    near = near.select("keeper", F.col(key).alias("dropped"), hamming(F.col("ca"), F.col(code)).cast("long").alias("distance"), ssim(F.col("pa"), F.col(pixels)).alias("ssim"))
    rank = left.select(F.col(key).alias("k"), F.struct(*order).alias("o"))
    similar = judged.where(F.col("ssim") < same).join(rank.select(F.col("k").alias("a"), F.col("o").alias("oa")), "a").join(rank.select(F.col("k").alias("b"), F.col("o").alias("ob")), "b")
    first = F.col("oa") >= F.col("ob")
    similar = similar.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("keeper"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("dropped"), "distance", "ssim")
    exact = exact.withColumns({"distance": F.lit(0).cast("long"), "ssim": F.lit(None).cast("double")})
    tier = lambda df, name, decision: df.select(F.lit(name).alias("tier"), F.lit(decision).alias("decision"), "keeper", "dropped", "distance", "ssim")
    return tier(exact, "exact", "drop").union(tier(near, "near", "drop")).union(tier(similar, "similar", "review"))


def fold_classes(rows: DataFrame, by: list, key: str, order: list) -> tuple[DataFrame, DataFrame]:
    """Rows that are equal in ``by`` folded to the first by ``order``, then key: its row with ``n``, and ``(key, rep)`` of every row.

    A key is that of one row. The fold is a partial aggregate, so a class of any size is one row after the shuffle.
    """
    digest = F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") if isinstance(c, str) else c.cast("string").alias(f"k{i}") for i, c in enumerate(by)]), {"ignoreNullFields": "false"}), 256)
    named = materialize(rows.select(F.struct(*rows.columns).alias("row"), F.struct(*order, F.col(key)).alias("at"), digest.alias("h")), "classes")
    reps = named.groupBy("h").agg(F.min_by("row", "at").alias("row"), F.count("*").alias("n"))
    reps = materialize(reps, "class-reps")
    member = named.select("h", F.col("row").getField(key).alias(key)).join(reps.select("h", F.col("row").getField(key).alias("rep")), "h").select(key, "rep")
    return reps.select(*[F.col("row").getField(c).alias(c) for c in rows.columns], "n"), member


def greedy_dedup(members: DataFrame, near: DataFrame, family: str, key: str, order: str) -> DataFrame:
    """``(dropped, of)``. Non-transitive: in each family by ``order`` descending, a row goes if it is near a row that was kept.

    ``near(a, b)`` holds the candidate pairs. Ties go by key, a null order comes last.
    """
    ranked = members.select(F.col(family).alias("f"), F.col(key).alias("k"), F.col(order).alias("o"))
    side = lambda x: ranked.select(F.col("k").alias(x), F.col("f").alias("f" + x), F.struct(F.col("o").isNull().alias("none"), (-F.col("o")).alias("o"), "k").alias("rank_" + x))
    pairs = near.select("a", "b").where("a <> b").join(side("a"), "a").join(side("b"), "b").where("fa <=> fb")
    return settle(pairs, F.col("rank_a") < F.col("rank_b"))


def greedy_classes(rows: DataFrame, family: str, key: str, order: str, pixels: str, near: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``greedy_dedup`` where rows of a family with equal ``pixels`` are compared once: ``near(reps)`` gives the pairs of representatives.

    The first row of a class stands for all; its copies go for the row that it went for, or for itself.
    """
    reps, member = fold_classes(rows, [family, pixels], key, [F.col(order).isNull(), -F.col(order)])
    gone = materialize(greedy_dedup(reps, near(reps), family, key, order), "greedy")
    out = member.join(gone.withColumnRenamed("dropped", "rep"), "rep", "left")
    return out.select(F.col(key).alias("dropped"), F.coalesce("of", "rep").alias("of")).where("dropped <> of")


def unique_content(rows: DataFrame, bucket: str, key: str, pixels: str, near: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(bucket, uniq, dup)``: a row is a copy if it is near a row that counts, of an earlier bucket or its own with a lesser key.

    The rows are passed in the order of bucket and key, and only those that count are compared with, as in ``greedy_dedup``.
    Equal rows are compared once. A null bucket comes first; buckets without a row that counts are left out.
    """
    reps, _ = fold_classes(rows, [pixels], key, [F.col(bucket)])
    side = lambda x: reps.select(F.col(key).alias(x), F.struct(bucket, F.col(key).alias("k")).alias("rank_" + x))
    pairs = near(reps).select("a", "b").where("a <> b").join(side("a"), "a").join(side("b"), "b")
    gone = settle(pairs, F.col("rank_a") < F.col("rank_b")).select(F.col("dropped").alias(key))
    uniq = reps.join(gone, key, "left_anti").groupBy(F.col(bucket).alias("of")).agg(F.count("*").alias("uniq"))
    n = rows.groupBy(bucket).agg(F.count("*").alias("n"))
    return n.join(uniq, F.col(bucket).eqNullSafe(F.col("of"))).select(bucket, "uniq", (F.col("n") - F.col("uniq")).alias("dup"))


def fingerprint(content: str | Column, head: int = 262144) -> Column:
    """Struct of the length of binary ``content`` and the MD5 of its first ``head`` bytes."""
    c = F.col(content) if isinstance(content, str) else content
    return F.struct(F.octet_length(c).cast("long").alias("bytes"), F.md5(F.substring(c, 1, head)).alias("head"))


def phash(rows: DataFrame, key: str, pixels: str, size: int = 8, low: int = 8) -> DataFrame:
    """``(key, hash)``: bits of the DCT-II's low block above the median of its terms without the first."""
    at = np.arange(size)
    basis = np.cos(np.pi * (2 * at[None, :] + 1) * at[:, None] / (2 * size))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for v in batch["v"]:
                c = (basis @ np.array(v, float).reshape(size, size) @ basis.T)[:low, :low].ravel()
                out.append(int(np.packbits(c > np.median(c[1:])).view(">u8")[0].astype(np.int64)))
            yield pd.DataFrame({"id": batch["id"], "hash": out})

    return rows.select(F.col(key).alias("id"), F.col(pixels).cast("array<double>").alias("v")).mapInPandas(run, "id long, hash long").withColumnRenamed("id", key)


def overlap(a: str, b: str) -> Column:
    """Intersection over union of the boxes in struct columns ``a`` and ``b``; 0 where both are empty."""
    f = lambda x, c: F.col(f"{x}.{c}")
    span = lambda lo, hi: F.greatest(F.lit(0.0), F.least(f(a, hi), f(b, hi)) - F.greatest(f(a, lo), f(b, lo)))
    area = lambda x: F.greatest(F.lit(0.0), f(x, "x2") - f(x, "x1")) * F.greatest(F.lit(0.0), f(x, "y2") - f(x, "y1"))
    both = span("x1", "x2") * span("y1", "y2")
    return both / F.greatest(area(a) + area(b) - both, F.lit(1e-12))


def overlapping_pairs(boxes: DataFrame, iou: float) -> DataFrame:
    """``(a, b)`` of structs of ``boxes`` (image, label, box, score, x1, y1, x2, y2) with an overlap of at least ``iou``, by a grid.

    Sides of such boxes differ by a factor of 1 / iou at most, and left and upper edges by 1 - iou of the greater side. So a
    box lies in one cell of a grid whose cells grow with the boxes' width and height, and looks for the others in the few
    cells of its own and the neighbouring sizes that they can begin in. Each pair is met once, from its first box by rank.
    """
    if not 0 < iou <= 1:
        raise ValueError("an overlap is above 0 and at most 1")
    grow = 1 / iou if iou < 1 else 2.0
    b = boxes.where("x2 > x1 AND y2 > y1 AND score IS NOT NULL").select(F.struct("image", "label", "box", "score", *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2"))).alias("b"))
    rank = lambda x: F.struct((-F.col(f"{x}.score")).alias("s"), F.col(f"{x}.box").alias("k"))
    level = lambda side: F.floor(F.log(side) / math.log(grow) + 1e-9).cast("int")
    cell = lambda at, size: F.floor(at / F.pow(F.lit(grow), size + 1)).cast("long")
    b = b.withColumns({"w": level(F.col("b.x2") - F.col("b.x1")), "h": level(F.col("b.y2") - F.col("b.y1"))})
    home = b.select(F.col("b").alias("other"), F.struct("b.image", "b.label", "w", "h", cell(F.col("b.x1"), F.col("w")).alias("cx"), cell(F.col("b.y1"), F.col("h")).alias("cy")).alias("at"))
    near = [F.lit(d) for d in (-1, 0, 1)]
    look = b.select("b", F.explode(F.array(*[F.struct((F.col("w") + i).alias("w"), (F.col("h") + j).alias("h"), F.greatest("w", F.col("w") + i).alias("tw"), F.greatest("h", F.col("h") + j).alias("th")) for i in near for j in near])).alias("s"))

    def cells(at: str, size: str, top: str) -> Column:
        reach = (1 - iou + 1e-9) * F.pow(F.lit(grow), F.col(f"s.{top}") + 1)
        return F.sequence(cell(F.col(f"b.{at}") - reach, F.col(f"s.{size}")), cell(F.col(f"b.{at}") + reach, F.col(f"s.{size}")))

    look = look.select("b", "s", F.explode(cells("x1", "w", "tw")).alias("cx")).select("b", "s", "cx", F.explode(cells("y1", "h", "th")).alias("cy"))
    look = look.select("b", F.struct("b.image", "b.label", F.col("s.w").alias("w"), F.col("s.h").alias("h"), "cx", "cy").alias("at"))
    j = look.join(home, "at").where((rank("b") < rank("other")) & (overlap("b", "other") >= iou))
    return j.select(F.col("b").alias("a"), F.col("other").alias("b"))


def _box_overlaps(boxes: np.ndarray, others: np.ndarray, iou: float) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all pairs of ``boxes`` and ``others`` (columns x1, y1, x2, y2) that overlap by ``iou``; edges far apart are left out first."""
    x1, y1, x2, y2 = others.T
    near = np.abs(x1 - boxes[:, :1]) <= _reach(boxes, 0, iou)[:, None]
    near &= np.abs(y1 - boxes[:, 1:2]) <= _reach(boxes, 1, iou)[:, None]
    i, j = np.nonzero(near)
    a1, b1, a2, b2 = boxes[i].T
    both = np.maximum(0, np.minimum(x2[j], a2) - np.maximum(x1[j], a1)) * np.maximum(0, np.minimum(y2[j], b2) - np.maximum(y1[j], b1))
    hit = both / np.maximum((x2[j] - x1[j]) * (y2[j] - y1[j]) + (a2 - a1) * (b2 - b1) - both, 1e-12) >= iou
    return i[hit], j[hit]


def _reach(boxes: np.ndarray, side: int, iou: float) -> np.ndarray:
    """How far the left (``side`` 0) or upper (1) edges of boxes that overlap by ``iou`` are from those of ``boxes`` at most."""
    return ((1 - iou) / iou + 1e-9) * (boxes[:, side + 2] - boxes[:, side]) + 1e-12 * np.abs(boxes[:, side])


def _strike_out(edges: np.ndarray, iou: float) -> Callable[[np.ndarray], np.ndarray]:
    """A function of boxes that gives the numbers of those of ``edges`` that overlap one of them by ``iou``, and forgets these.

    ``edges`` are held by their left edge, and a few neighbouring boxes at a time meet those in their reach.
    """
    left = np.argsort(edges[:, 0], kind="stable")
    held = edges[left]

    def strike(boxes: np.ndarray) -> np.ndarray:
        nonlocal left, held
        live = np.ones(len(left), bool)
        boxes = boxes[np.argsort(boxes[:, 0], kind="stable")]
        for at in range(0, len(boxes), NEIGHBOURS):
            some = boxes[at : at + NEIGHBOURS]
            reach = _reach(some, 0, iou)
            lo, hi = np.searchsorted(held[:, 0], (some[:, 0] - reach).min()), np.searchsorted(held[:, 0], (some[:, 0] + reach).max(), "right")
            live[lo + _box_overlaps(some, held[lo:hi], iou)[1]] = False
        gone, left, held = left[~live], left[live], held[live]
        return gone

    return strike


def _kept_boxes(frame: pd.DataFrame, iou: float) -> pd.DataFrame:
    """The rows of one image and label that greedy suppression keeps."""
    key = frame["box"].map(hashable) if frame["box"].dtype == object else frame["box"]
    frame = frame.iloc[pd.DataFrame({"s": -frame["score"], "k": key}).reset_index(drop=True).sort_values(["s", "k"]).index]
    wide = ((frame["x2"] > frame["x1"]) & (frame["y2"] > frame["y1"])).to_numpy()
    flat, frame = frame[~wide], frame[wide].drop_duplicates(EDGES)
    edges, gone, kept = frame[EDGES].to_numpy(), np.zeros(len(frame), bool), np.zeros(len(frame), bool)
    strike, todo = _strike_out(edges, iou), np.arange(len(frame))
    with np.errstate(all="ignore"):
        while len(todo):  # the next boxes by rank that nothing kept so far overlaps: among themselves, then against the rest
            head, todo = todo[:HEAD], todo[HEAD:]
            meets, out = np.zeros((len(head), len(head)), bool), np.zeros(len(head), bool)
            meets[_box_overlaps(edges[head], edges[head], iou)] = True
            for i, at in enumerate(head):
                if not out[i]:
                    kept[at] = True
                    out |= meets[i]
            gone[strike(edges[head[kept[head]]])] = True
            todo = todo[~gone[todo]]
    return pd.concat([frame[kept], flat])


def _free_boxes(frame: pd.DataFrame, kept: pd.DataFrame, iou: float) -> pd.DataFrame:
    """The rows of ``frame`` that overlap none of ``kept``; a box without area overlaps nothing."""
    wide = lambda b: ((b["x2"] > b["x1"]) & (b["y2"] > b["y1"])).to_numpy()
    gone, asked = np.zeros(len(frame), bool), np.flatnonzero(wide(frame))
    with np.errstate(all="ignore"):
        gone[asked[_strike_out(frame[EDGES].to_numpy()[asked], iou)(kept.loc[wide(kept), EDGES].to_numpy())]] = True
    return frame[~gone]


def _suppress_pairs(boxes: DataFrame, iou: float) -> DataFrame:
    """Greedy suppression by all overlapping pairs, settled in rounds, whatever the size of a group."""
    first = F.struct((-F.col("score")).alias("s"), "box")
    wide = "x2 > x1 AND y2 > y1 AND NOT isnan(x2) AND NOT isnan(y2)"
    folded = materialize(boxes.where(wide).groupBy("image", "label", *EDGES).agg(F.min_by("box", first).alias("box"), F.min_by("score", first).alias("score")), "boxes")
    name = lambda x: F.struct(f"{x}.image", f"{x}.label", f"{x}.box")
    gone = dropped(overlapping_pairs(folded, iou).select(name("a").alias("better"), name("b").alias("worse"))).select("node.*")
    return folded.join(gone, ["image", "label", "box"], "left_anti").unionByName(boxes.where(f"NOT ({wide})"))


def suppress(boxes: DataFrame, iou: float = 0.6, least: DataFrame | None = None) -> DataFrame:
    """Greedy non-maximum suppression of ``(image, label, box, score, x1, y1, x2, y2)`` in each image and label: ``(image, label, box, score)`` kept.

    ``least(label, score)`` is the least score of a class, if given; a label that it does not name is left out. Boxes of a
    higher score come first, ties by least box. Equal boxes of one image and label are one class, whose first box stands
    for all. Boxes without area, or with an edge that is no number, overlap nothing and stay; a null score or edge takes no part. ``box`` is unique in its
    image and label.

    An image and label of at most ``LOCAL_BOXES`` boxes is settled at once, against the boxes that stay, so that no pairs
    are made. Of a larger one the first ``LOCAL_BOXES`` boxes are settled so and what they suppress is taken from the
    others, in blocks of bounded size; after ``FRONTS`` such rounds what is left goes by overlapping pairs.
    """
    if not 0 < iou <= 1:
        raise ValueError("an overlap is above 0 and at most 1")
    if least is not None:
        limits = materialize(least.groupBy(F.col("label").alias("of")).agg(F.max("score").alias("limit")), "box-limits")
        boxes = boxes.join(broadcast_if_small(limits), (boxes.label == F.col("of")) & (boxes.score >= F.col("limit"))).select(boxes.columns)
    group, out = ["image", "label"], ["image", "label", "box", "score"]
    left = boxes.where(" AND ".join(f"{c} IS NOT NULL" for c in [*out, *EDGES])).select(*out, *(F.col(c).cast("double").alias(c) for c in EDGES))
    schema = ", ".join(f"{c} {t}" for c, t in left.dtypes)
    settled = lambda rows: rows.groupBy(*group).applyInPandas(lambda frame: _kept_boxes(frame, iou), schema)
    free = lambda rows, kept: _free_boxes(rows, kept, iou)[[*out, *EDGES]]
    rank = F.struct((-F.col("score")).alias("s"), "box")
    parts = []
    for i in range(FRONTS + 1):
        large = materialize(left.groupBy(*group).agg(F.count("*").alias("n")).where(F.col("n") > LOCAL_BOXES), "box-groups")
        if large.isEmpty():
            parts.append(settled(left))
            break
        parts.append(settled(left.join(F.broadcast(large), group, "left_anti")))
        rest = left.join(F.broadcast(large), group)
        if i == FRONTS:
            parts.append(_suppress_pairs(rest.drop("n"), iou))
            break
        front = materialize(rest.withColumn("r", F.rank().over(Window.partitionBy(*group).orderBy(rank))).where(F.col("r") <= LOCAL_BOXES).drop("r"), "box-front")
        kept = materialize(settled(front.drop("n")), "box-kept")
        last = front.groupBy(*group).agg(F.max(rank).alias("last"))
        blocks = F.ceil(F.col("n") / LOCAL_BOXES).cast("int")
        after = rest.join(F.broadcast(last), group).where(rank > F.col("last")).withColumn("part", F.pmod(F.xxhash64("box"), blocks).cast("int")).drop("n", "last")
        copies = kept.join(F.broadcast(large), group).withColumn("part", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("n")
        left = materialize(after.groupBy(*group, "part").cogroup(copies.groupBy(*group, "part")).applyInPandas(free, schema), "boxes")
        parts.append(kept)
    done = parts[0].select(*out)
    for p in parts[1:]:
        done = done.union(p.select(*out))
    return done
