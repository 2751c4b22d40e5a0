"""The removal ledger and the run log against plain passes over their events."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import ledger

KIND = "name string, kind string, at int, seq long, bucket string, reason string, extra int"


def plain(events):
    out = []
    for e in sorted((e for e in events if e[0] is not None), key=lambda e: (e[2], e[3])):
        open_ = next((r for r in out if r["name"] == e[0] and r["to"] is None), None)
        if e[1] == "restore" and open_:
            open_["to"] = e[2]
        if e[1] == "remove":
            if not open_:
                open_ = {"name": e[0], "at": e[2], "bucket": None, "reason": None, "to": None, "no": 1 + sum(r["name"] == e[0] for r in out)}
                out.append(open_)
            open_["bucket"], open_["reason"] = e[4] or open_["bucket"], e[5] or open_["reason"]
    return {(r["name"], r["no"], r["at"], r["bucket"], r["reason"], r["to"]) for r in out}


def events():
    rng = random.Random(8)
    names = ["hot"] * 20 + ["a", "b", "c", None, ""]
    return [(rng.choice(names), rng.choice(["remove", "remove", "restore", "other", None]), rng.randint(0, 40), i, rng.choice(["b1", "b2", "", None]), rng.choice(["r1", "", None]), i % 3) for i in range(300)]


def fold(frame):
    return ledger.entries(frame, "name", "kind", "at", ["at", "seq"], ["bucket", "reason"], "seq")


def test_entries(spark):
    rows = events()
    want = plain(rows)
    assert {tuple(r) for r in fold(spark.createDataFrame(rows, KIND).repartition(5)).collect()} == want
    # replayed and late events: the same events in other batches, some of them twice
    late = spark.createDataFrame(rows[150:], KIND).union(spark.createDataFrame(rows[:200], KIND))
    got = [tuple(r) for r in fold(late).collect()]
    assert len(got) == len(want) and set(got) == want
    assert fold(spark.createDataFrame([], KIND)).count() == 0


def test_undo_returns_to_the_bucket(spark):
    rows = [("x", "remove", 1, 1, "b1", "r", 0), ("x", "remove", 2, 2, "", "s", 0), ("y", "remove", 1, 3, None, None, 0), ("z", "remove", 1, 4, "b2", "", 0), ("z", "restore", 2, 5, None, None, 0)]
    frame = spark.createDataFrame(rows, KIND)
    book = fold(frame)
    wanted = spark.createDataFrame([("x",), ("x",), ("y",), ("z",), ("w",), (None,)], "name string")
    more, moves = ledger.undo(book, "name", wanted, F.lit(9), "bucket", "images")
    assert sorted(tuple(r) for r in moves.collect()) == [("w", None, "not removed"), ("x", "b1", "restored"), ("y", "images", "restored"), ("z", None, "not removed")]
    assert ledger.active(wanted, book, "name").count() == 3
    after = fold(frame.unionByName(more.withColumn("seq", F.lit(10) + F.monotonically_increasing_id()), allowMissingColumns=True))
    assert ledger.still_removed(after).count() == 0 and {(r.name, r.restored_at) for r in after.collect()} == {("x", 9), ("y", 9), ("z", 2)}


def test_stages(spark):
    stages = ["fetch", "dedup", "wash", "review"]
    log = [("d", "fetch", "done", 1), ("d", "dedup", "done", 2), ("d", "wash", "preview", 3), ("d", "wash", "done", 4), ("d", "dedup", "done", 5), ("d", "odd", "done", 9), ("e", "wash", "done", 1), ("e", "fetch", "done", 2), ("e", "fetch", "stale", 3), (None, "wash", "done", 1)]
    frame = spark.createDataFrame(log, "ds string, stage string, status string, at int")
    table = ledger.stage_table(frame, stages, "ds", "stage", "status", ["at"])
    assert {tuple(r) for r in table.collect()} == {("d", "fetch", 0, "done", None), ("d", "dedup", 1, "done", None), ("d", "wash", 2, "stale", "dedup"), ("e", "fetch", 0, "stale", None), ("e", "wash", 2, "stale", "fetch")}
    marks = ledger.invalidate_from(table, stages, "ds", "dedup", F.lit(6))
    assert [tuple(r) for r in marks.collect()] == [("d", "dedup", "stale", 6)]
    after = ledger.stage_table(frame.union(marks), stages, "ds", "stage", "status", ["at"])
    assert {(r.ds, r.stage) for r in after.where("status = 'stale'").collect()} == {("d", "dedup"), ("d", "wash"), ("e", "fetch"), ("e", "wash")}
    only = ledger.invalidate_from(table, stages, "ds", "fetch", F.lit(6), spark.createDataFrame([("e",)], "ds string"))
    assert only.count() == 0
    with pytest.raises(ValueError, match="unknown stage"):
        ledger.invalidate_from(table, stages, "ds", "odd", F.lit(1))
