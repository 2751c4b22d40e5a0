"""Fingerprints of tables and stored results."""

import itertools
import random
from collections import Counter

from pyspark.sql import functions as F

from tessera.operators import reuse

KIND = "g string, a string, b string, n double, l array<string>, m struct<x:int,y:string>"
ROWS = [("p", "x", None, 1.0, ["u", None], (1, None)), ("p", None, "x", 1.0, [None, "u"], (None, "1")), ("p", "", "x", None, [], None), ("q", "x", "", float("nan"), None, (1, "1"))]


def test_equal_only_for_equal_multisets(spark):
    some = [list(c) for n in range(4) for c in itertools.combinations_with_replacement(ROWS, n)]
    frame = spark.createDataFrame([(str(i), *r) for i, rows in enumerate(some) for r in random.Random(i).sample(rows, len(rows))], "i string, " + KIND).repartition(7)
    got = {r.i: tuple(r)[1:] for r in reuse.fingerprint(frame, by=["i"]).collect()}
    want = {str(i): tuple(sorted(Counter(map(repr, rows)).items())) for i, rows in enumerate(some) if rows}
    assert len(set(got.values())) == len(got) == len(set(want.values())) == len(want)
    back = reuse.fingerprint(frame.orderBy(F.desc("i"), "a").coalesce(1), by=["i"]).collect()
    assert {r.i: tuple(r)[1:] for r in back} == got
    none = reuse.fingerprint(frame.where("false")).first()
    assert tuple(none) == (0,) * 7


def test_parts_add_up(spark):
    frame = spark.createDataFrame(ROWS * 5, KIND)
    assert reuse.merge(reuse.fingerprint(frame, ["a", "b", "l"], ["g"])).first() == reuse.fingerprint(frame, ["a", "b", "l"]).first()


def test_unchanged_groups(spark):
    then = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1), ("c", None), (None, 3), ("d", 1)], "g string, v int")
    now = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), ("c", None), ("c", None), (None, 3), ("e", 1)], "g string, v int")
    got = {(r.g, r.unchanged) for r in reuse.unchanged(now, then, ["g"]).collect()}
    assert got == {("a", True), ("b", False), ("c", False), (None, True), ("d", False), ("e", False)}


def test_stored_results(spark, tmp_path):
    folder, runs = f"file://{tmp_path}/it's here", []

    def top(rows, least):
        runs.append(least)
        return rows.where(F.col("v") >= least)

    rows = spark.createDataFrame([(1, 5), (2, 7), (2, 7), (3, 9)], "k int, v int")
    ask = lambda r, least=7, **k: reuse.stored(spark, folder, "top", {"rows": r}, {"least": least}, top, **k)
    first, reused = ask(rows)
    assert not reused and sorted(first.collect()) == [(2, 7), (2, 7), (3, 9)]
    again, reused = ask(rows.orderBy(F.desc("k")).repartition(3))
    assert reused and sorted(again.collect()) == sorted(first.collect()) and runs == [7]
    assert not ask(rows, 8)[1] and not ask(rows.union(rows.where("k = 1")))[1] and not ask(rows.distinct())[1] and len(runs) == 4
    # a result that was applied: the rows it named are gone from the input
    assert ask(rows.where("k < 3"), removed={"rows": rows.where("k = 3")})[1] and not ask(rows.where("k < 3"))[1]
    # a result without its mark of completion is made anew
    for mark in (tmp_path / "it's here" / "results").glob("*/_SUCCESS"):
        mark.unlink()
    assert not ask(rows)[1] and ask(rows)[1]
    assert sorted(p.name for p in (tmp_path / "it's here" / "drafts").iterdir() if p.suffix != ".crc") == []
