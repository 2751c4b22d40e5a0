"""Greedy choice by rank and its callers, against the plain sequential pass."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import dedup, settle


def plain_gone(edges):
    """Nodes in order of number; ``edges`` are (better, worse) with better < worse."""
    up = {}
    for a, b in edges:
        up.setdefault(b, set()).add(a)
    kept, gone = set(), set()
    for x in sorted({x for e in edges for x in e}):
        (gone if up.get(x, set()) & kept else kept).add(x)
    return gone


def shapes():
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(60)]
    ladder = [(i, i + d) for i in range(200, 260) for d in (1, 2)]
    star = [(1000, 1001 + i) for i in range(300)] + [(1001 + i, 2000) for i in range(300)]
    some = [tuple(sorted(rng.sample(range(3000, 3060), 2))) for _ in range(150)]
    return chain + ladder + star + some + chain[:5]


@pytest.mark.parametrize(("rounds", "local"), [(4, 100_000), (1, 5), (2, 0)])
def test_dropped(spark, monkeypatch, rounds, local):
    monkeypatch.setattr(settle, "ROUNDS", rounds)
    monkeypatch.setattr(settle, "LOCAL_PAIRS", local)
    edges = shapes() if local else [e for e in shapes() if e[0] > 250]
    got = [r.node for r in settle.dropped(spark.createDataFrame(edges, "better long, worse long").repartition(3)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_gone(edges)
    assert settle.dropped(spark.createDataFrame([], "better long, worse long")).count() == 0


def test_dropped_structs_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(settle, "ROUNDS", 1)
    pairs = spark.createDataFrame(shapes(), "a long, b long")
    name = lambda c: F.struct(F.lit("x").alias("image"), F.struct(F.col(c).alias("box")).alias("in"), F.array(c).alias("all"))
    got = [r.node["in"].box for r in settle.dropped(pairs.select(name("a").alias("better"), name("b").alias("worse"))).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_gone(shapes())


def test_greedy_by_order_and_family(spark):
    rows = [(1, 0, 5), (2, 0, 9), (3, 0, 9), (4, 1, 1), (5, 0, None), (6, None, 1), (7, None, 1)]
    near = [(1, 2), (2, 3), (1, 4), (5, 1), (6, 7), (7, 7), (None, 2)]
    got = dedup.greedy_dedup(spark.createDataFrame(rows, "k long, f long, o long"), spark.createDataFrame(near, "a long, b long"), "f", "k", "o").collect()
    assert {tuple(r) for r in got} == {(1, 2), (3, 2), (7, 6)}


def test_classes_fold_a_hot_copy(spark):
    rows = [(i, 0, [1.0, 2.0]) for i in range(400)] + [(900, 0, [1.0, 3.0]), (901, 0, None), (902, 0, None), (903, 1, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "k long, f int, p array<double>").withColumn("o", -F.col("k")).withColumn("n2", F.lit(1))
    seen = []

    def near(reps):
        seen.append(reps.count())
        return spark.createDataFrame([(0, 900)], "a long, b long")

    got = {tuple(r) for r in dedup.greedy_classes(frame, "f", "k", "o", "p", near).collect()}
    assert seen == [4] and got == {(i, 0) for i in range(1, 400)} | {(900, 0), (902, 901)}


def plain_boxes(rows, iou):
    kept = []
    for r in sorted((r for r in rows if None not in r), key=lambda r: (-r[3], r[2])):
        def over(s, r=r):
            if s[:2] != r[:2]:
                return 0
            w, h = min(r[6], s[6]) - max(r[4], s[4]), min(r[7], s[7]) - max(r[5], s[5])
            both = max(0, w) * max(0, h)
            area = lambda b: max(0, b[6] - b[4]) * max(0, b[7] - b[5])
            return both / max(area(r) + area(s) - both, 1e-12)

        if all(over(s) < iou for s in kept):
            kept.append(r)
    return {r[:4] for r in kept}


@pytest.mark.parametrize("iou", [0.3, 0.6, 1.0])
def test_boxes(spark, iou):
    rng = random.Random(int(iou * 100))
    rows = []
    for i in range(500):
        image = 1 if i % 3 else rng.randrange(6)  # a hot image
        x, y, w, h = rng.uniform(-20, 20), rng.uniform(-5, 5), rng.choice([0, 0.5, 4, 5, 6, 40]), rng.choice([1, 3, 3.3, 9])
        rows.append((image, rng.choice("ab"), i, rng.choice([0.1, 0.3, 0.5, 0.5, 0.9]), x, y, x + w, y + h))
    rows += [(*r[:2], r[2] + 1000, r[3], *r[4:]) for r in rows[:100]] + [(1, "a", 5000, None, 0.0, 0.0, 1.0, 1.0), (1, "a", 5001, 0.5, None, 0.0, 1.0, 1.0)]
    frame = spark.createDataFrame(rows, "image long, label string, box long, score double, x1 double, y1 double, x2 double, y2 double").withColumn("at", F.lit(1))
    assert {tuple(r) for r in dedup.suppress(frame, iou).collect()} == plain_boxes(rows, iou)
    least = spark.createDataFrame([("a", 0.3), ("a", 0.5)], "label string, score double")
    assert {tuple(r) for r in dedup.suppress(frame, iou, least).collect()} == plain_boxes([r for r in rows if r[1] == "a" and (r[3] or 0) >= 0.5], iou)
    assert dedup.suppress(frame.where("false"), iou).count() == 0


@pytest.mark.parametrize(("local", "fronts"), [(1000, 1), (40, 30), (25, 2), (60, 0)])
def test_boxes_of_large_images(spark, monkeypatch, local, fronts):
    """The first boxes of an image are settled at once, what they leave in further rounds, the rest by pairs."""
    monkeypatch.setattr(dedup, "LOCAL_BOXES", local)
    monkeypatch.setattr(dedup, "FRONTS", fronts)
    rng = random.Random(local)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.choice("aab"), f"b{i}é", rng.choice([0.1, 0.5, 0.5, 0.9]), x := rng.uniform(-9, 9), y := rng.uniform(0, 2), x + rng.choice([0, 0.5, 3, 4, 5]), y + rng.choice([1, 3, 3.3])) for i in range(600)]
    rows += [(*r[:2], r[2] + "x", *r[3:]) for r in rows[:60]] + [(1, "a", "z", None, 0.0, 0.0, 1.0, 1.0), (9, "a", "one", 0.5, 0.0, 0.0, 1.0, 1.0), (9, "a", "nan", 0.4, 0.0, 0.0, math.nan, 1.0)]
    frame = spark.createDataFrame(rows, "image long, label string, box string, score double, x1 double, y1 double, x2 double, y2 double")
    got = [tuple(r) for r in dedup.suppress(frame, 0.5).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_boxes(rows, 0.5)
    assert dedup.suppress(frame.where("false"), 0.5).count() == 0


def test_suppression_makes_no_pairs(spark):
    """40,000 boxes of one image on one another: 800 million pairs, of which one box stays."""
    frame = spark.range(40_000).selectExpr("1 AS image", "'a' AS label", "id AS box", "id % 1000 / 1000 AS score", "id / 1e6 AS x1", "0.0 AS y1", "10 + id / 1e6 AS x2", "10.0 AS y2")
    assert [tuple(r) for r in dedup.suppress(frame).collect()] == [(1, "a", 999, 0.999)]


def test_fingerprint(spark):
    rows = spark.createDataFrame([(b"x" * 10, ), (b"x" * 9 + b"y",), (None,)], "content binary").select(dedup.fingerprint("content", 9).alias("f")).collect()
    assert rows[0].f == rows[1].f and rows[0].f.bytes == 10 and rows[2].f.bytes is None


def test_numbering_keeps_every_column(spark):
    from tessera.operators import numbering

    names = ["__part", "__n", "__off", "__r", "__p", "__g", "__i", "g"]
    rows = spark.createDataFrame([(1, 2, 3, 4, 5, 6, 7, "x"), (1, 2, 3, 4, 5, 6, 8, "x")], ", ".join(f"{n} {'string' if n == 'g' else 'int'}" for n in names))
    for out in (numbering.number_all(rows, ["__i"], "k"), numbering.number_within(rows, ["g"], ["__i"], "k")):
        assert out.columns == [*names, "k"] and sorted((r["__i"], r["__part"], r["__g"], r.k) for r in out.collect()) == [(7, 1, 6, 1), (8, 1, 6, 2)]
    out = numbering.distinct_names(rows, "g", ["__i"], lambda name, i: F.concat(name, i))
    assert out.columns == names and sorted(r.g for r in out.collect()) == ["x", "x2"]


@pytest.mark.parametrize(("text", "want"), [("-" * 100_000 + "1", 2), ("(" * 5000 + "3" + ")" * 5000, 2), ("--3", 3), ("-(2-n)", 4), ("max(1, min(n, 9)) - 1", 5), ("min(3)", 2), ("3 3", 2), ("n//2*2", 6), ("7-2-1", 4), ("n/0+1", 2), ("1/0", 2), ("", 2)])
def test_take_expressions(spark, text, want):
    from tessera.operators.ranking import take_expression

    assert spark.range(6, 7).select(take_expression(text, F.col("id")).alias("k")).first().k == want
