"""Families and near codes against plain versions on small tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import dedup, families
from tessera.plans.registry import QUERIES


@pytest.mark.parametrize("tolerance", [0.0, 0.05, 0.5])
def test_near_codes(spark, tolerance):
    rng = random.Random(6)
    base = [rng.getrandbits(63) for _ in range(6)]
    rows = [(i, rng.choice(base) ^ sum(1 << b for b in rng.sample(range(60), rng.choice([0, 1, 2, 5]))), rng.choice([0.5, 0.525, 1.0, 1.05, 1.0526, 0.95, 2.0])) for i in range(150)]
    rows += [(1000 + i, base[0], 1.0) for i in range(200)] + [(2000, None, 1.0), (2001, base[0], None), (2002, base[0], 0.0), (2003, base[0], -1.0), (2004, base[0], math.nan), (2005, base[0], math.inf), (2006, -base[0], 1.0)]
    frame = spark.createDataFrame(rows, "k long, c long, r double").withColumn("code", F.lit("other"))
    pairs, members = dedup.near_codes(frame, "k", "c", "r", 3, tolerance)
    classes = {}
    for k, c, r in rows:
        classes.setdefault((c, str(r)), []).append((k, c, r))
    reps = [(min(v)[0], v[0][1], v[0][2], len(v)) for v in classes.values()]
    fit = [x for x in reps if x[1] is not None and x[2] is not None and 0 < x[2] < math.inf]
    want = {(a[0], b[0], a[3], b[3], ((a[1] ^ b[1]) & (2**64 - 1)).bit_count()) for a in fit for b in fit if a[0] < b[0] and ((a[1] ^ b[1]) & (2**64 - 1)).bit_count() <= 3 and abs(a[2] - b[2]) <= tolerance * max(a[2], b[2])}
    got = [tuple(r) for r in pairs.collect()]
    assert set(got) == want and len(got) == len(want)
    assert {(r.k, r.rep) for r in members.collect()} == {(k, min(v)[0]) for v in classes.values() for k, _, _ in v}
    assert dedup.near_codes(frame.limit(0), "k", "c", "r", 3, tolerance)[0].count() == 0
    with pytest.raises(ValueError):
        dedup.near_codes(frame, "k", "c", "r", 3, 1.0)


def test_declared_keys(spark):
    rows = [("x.png", "a", "Yard", 5, 2), ("x.png", "b", "yard2", 6, None), ("y.png", "a", "Pool", 7, None), ("z.png", "a", None, 8, 1), ("w.png", "a", "pool", None, None)]
    frame = spark.createDataFrame(rows, "name string, bucket string, source string, post int, root int")
    got = families.unique_labels(frame, "name", "bucket").select("label", families.declared_key(F.col("label"), F.col("source"), F.col("post"), F.col("root"), ("yard",), "y").alias("key"))
    assert sorted(map(tuple, got.collect())) == [("a/x.png", "y:2"), ("b/x.png", "y:6"), ("w.png", "single:w.png"), ("y.png", "pool:7"), ("z.png", "post:8")]


def test_family_plan(spark):
    # three groups in a chain by the vectors 2-3 and 4-5, one group alone, one row without a vector
    e = {1: [1, 0, 0, -1], 2: [0, 1, -1, 0], 3: [0, 1.01, -1, 0], 4: [0, 0, 1, -1.0], 5: [0, 0, 1, -1.1], 6: [1, -3, 1, 1], 7: None, 8: [0, 1, -1, 0]}
    group = {1: "b:1", 2: "b:1", 3: "a:1", 4: "a:1", 5: "c:1", 6: "d:1", 7: "single:7", 8: "b:1"}
    rows = [(k, group[k], None if e[k] is None else [float(x) for x in e[k]], -k) for k in e]
    frame = spark.createDataFrame(rows, "id long, g string, v array<double>, rank long")
    seen = []

    def near(reps):
        seen.extend(r.id for r in reps.collect())
        return spark.createDataFrame([(4, 5), (2, 3), (1, 6)], "a long, b long")

    plans, members, merges = families.family_plan(frame, "id", "g", "v", "v", "rank", near, 0.99, 4)
    assert sorted(seen) == [1, 2, 3, 4, 5, 6]
    assert {(r.id, r.family, r.of) for r in members.collect()} == {(1, "a:1+2", None), (2, "a:1+2", None), (8, "a:1+2", 2), (3, "a:1+2", 2), (4, "a:1+2", None), (5, "a:1+2", 4), (6, "d:1", None), (7, "single:7", None)}
    assert {tuple(r) for r in plans.collect()} == {("a:1+2", 3, 6, 3, "diff3", 2), ("d:1", 1, 1, 1, "diff1", 4), ("single:7", 1, 1, 1, "diff1", 4)}
    assert {(r.family, r.a, r.b) for r in merges.collect()} == {("a:1+2", 2, 3), ("a:1+2", 3, 8), ("a:1+2", 4, 5)}


def test_family_queries(spark, sf):
    members, plans = QUERIES["family_members"](spark, sf).collect(), QUERIES["family_plans"](spark, sf).collect()
    v = {r.vec_id: list(map(float, r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    kept = {}
    for r in members:
        kept.setdefault(r.family, []).append(r.of is None)
    assert len(members) == len(v) + sum(k % 5 == 0 for k in v)
    assert {(r.family, r.n_members, r.kept) for r in plans} == {(f, len(x), sum(x)) for f, x in kept.items()}
    # a planted copy without a changed element goes for its original
    of = {r.vec_id: r.of for r in members}
    assert all(of[k + 1000000] is not None for k in v if k % 20 == 0)
