import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import toxicity as tx
from tessera.llm.queries import QUERIES


def plain_segments(scores):
    """The best segment first, then those of what is left and right of it, by all pairs of ends."""
    best = None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            if best is None or total > best[0] or (total == best[0] and (i, j) < best[1:]):
                best = (total, i, j)
    if best is None or best[0] <= 0:
        return []
    s, i, j = best
    return [*plain_segments(scores[:i]), (i, j, s), *((a + j + 1, b + j + 1, x) for a, b, x in plain_segments(scores[j + 1 :]))]


def test_segments():
    rng = random.Random(5)
    for _ in range(800):
        scores = [rng.choice([-1, -1, -1, 2, 3, 5, -4]) for _ in range(rng.randrange(0, 40))]
        scores = [s if s == -1 else s + rng.random() / 100 for s in scores]  # no ties
        scored = [(i, s) for i, s in enumerate(scores) if s != -1]
        got = tx.maximal_segments(scored, len(scores))
        assert [x[:2] for x in got] == [x[:2] for x in plain_segments(scores)]
        for i, j, s in got:
            assert s == pytest.approx(sum(scores[i : j + 1])) and s > 0
        assert all(a[1] < b[0] for a, b in zip(got, got[1:], strict=False))
    assert tx.maximal_segments([(0, 4), (1, -5), (2, 3), (3, -3), (4, 1), (5, 2), (6, -2), (7, 2), (8, -2), (9, 1), (10, 5)], 11) == [(0, 0, 4), (2, 2, 3), (4, 10, 7)]
    many = [(i, 1 if i % 3 else 2) for i in range(0, 300_000, 2)]
    assert len(tx.maximal_segments(many, 300_000)) >= 1


def test_decay():
    x = tx.decay({3: 0.01, 5: 0.001})
    assert x > 0 and 0.989 * math.exp(-x) + 0.01 * math.exp(3 * x) + 0.001 * math.exp(5 * x) == pytest.approx(1)
    assert tx.decay({}) == 1.0


def test_evidence_grows():
    model = tx.Model({}, 1.0, 0.1)
    some = [tx.evidence(500, np.array(s), model) for s in ([], [3], [6], [12], [12, 9], [12, 9, 9])]
    assert some == sorted(some) and some[0] == 0
    assert tx.evidence(50_000, np.array([12]), model) < tx.evidence(500, np.array([12]), model)


def test_logistic_stays_finite():
    base, slope = tx.logistic(np.array([0.0, 3.0]), np.array([0.0, 40.0]), np.array([200.0, 40.0]))
    chance = lambda x: 1 / (1 + math.exp(-base - slope * x))
    assert chance(0) < 0.1 and chance(3) > 0.9
    base, slope = tx.logistic(np.array([0.0]), np.array([2.0]), np.array([10.0]))
    assert math.isfinite(base) and slope == 0


def corpus(rng, n=500):
    clean = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(clean) for _ in range(rng.randrange(5, 120))]
        if i % 7 == 0:
            at = rng.randrange(len(text) + 1)
            text[at:at] = [rng.choice(["zonkers", "zonkerish", "Wuzzle,", "wuzzled"]) for _ in range(rng.randrange(1, 4))]
        rows.append((i, " ".join(text), int(i % 7 == 0)))
    return rows


def test_held_out(spark):
    rows = corpus(random.Random(2))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (902, " ,. "), (None, "zonkers a b"), (1, rows[1][1])], "doc_id long, text string").withColumn("y", F.lit("x")).repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    got = tx.score(docs, labels, F.col("doc_id") % 3 == 0).collect()
    assert len(got) == len(rows) + 5
    truth = {i: y for i, _, y in rows}
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in truth:
            assert r.held_out == (r.doc_id % 3 == 0)
            assert (r.score >= 0.3) == bool(truth[r.doc_id]), r
            for p in r.passages:
                words = tx.find_words(rows[r.doc_id][1].lower())
                assert any(w.startswith(("zonke", "wuzzl")) for w in words[p["first"] : p["last"] + 1])
        elif r.doc_id is not None:
            assert r.score < 0.3 and r.n == 0 and r.passages == []
        else:
            assert r.held_out is False and r.score >= 0.3


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for labels in ([], [(9, 1)], [(1, None)]):
        got = tx.score(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(False)).collect()
        assert [r.score for r in got] == [0.0, 0.0]
    assert tx.score(docs.where("false"), spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), F.lit(False)).collect() == []
    same = tx.score(docs, spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int"), F.lit(False)).collect()
    assert all(0 <= r.score < 0.3 for r in same)


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op11_toxicity"](spark, sf).collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [i for i in truth if got[i].held_out]
    assert all(got[i].predicted == int(got[i].score >= 0.3) for i in got)
    assert sum(got[i].predicted == truth[i] for i in held) / len(held) > 0.97
    bad, good = ([got[i].score for i in held if truth[i] == y] for y in (1, 0))
    area = sum((a > b) + (a == b) / 2 for a in bad for b in good) / (len(bad) * len(good))
    assert area > 0.95
