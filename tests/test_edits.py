"""Edits, removals, answers, snapshots, stage parameters, the kept vocabulary and nested leaves on literal frames."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import params
from tessera.functions.text import first_source
from tessera.operators import edits, vocab
from tessera.operators.leaves import flatten_leaves
from tessera.sources import snapshots

ROWS = "id long, tags array<string>, seq string"
EDITS = "id long, seq long, op string, tag string"


def pairs(df):
    return sorted((r.id, r.tag) for r in df.collect())


def test_edits(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "a"], "x"), (2, None, "x"), (3, [], "x"), (4, ["a"], "x"), (None, ["a"], "x"), (5, ["b", "c"], "x"), (5, ["b"], "y")], ROWS)
    given = [(1, 1, "remove", "B"), (1, 2, "add", "New_Tag"), (1, 3, "add", "c"), (1, 4, "add", "c"), (2, 1, "add", "b"), (3, 1, "set", "y"), (3, 0, "set", "z"), (3, 2, "remove", "y"), (9, 1, "add", "old"), (None, 1, "add", "q"), (5, 1, "remove", "b"), (5, 2, "add", "b"), (4, 1, "add", None)]
    ledger = spark.createDataFrame([(1, "c"), (1, "kept"), (9, "old")], "id long, tag string")
    out, after = edits.apply_edits(rows, spark.createDataFrame(given, EDITS), ledger, "id")
    assert out.columns == rows.columns
    want = [(1, ["a", "new tag", "c"], "x"), (2, ["b"], "x"), (3, ["z"], "x"), (4, ["a"], "x"), (None, ["a"], "x"), (5, ["c", "b"], "x"), (5, ["b"], "y")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert pairs(after) == [(1, "b"), (1, "kept"), (3, "y"), (9, "old")]
    none = spark.createDataFrame([], EDITS)
    same, after = edits.apply_edits(rows, none, ledger, "id")
    assert sorted(map(str, same.collect())) == sorted(map(str, rows.collect())) and after.count() == 3
    assert edits.apply_edits(rows.limit(0), spark.createDataFrame(given, EDITS), ledger, "id")[0].count() == 0


def test_removed_tags(spark):
    of = lambda *r: spark.createDataFrame(list(r), "id long, tags array<string>")
    merged, now = of((1, ["a", "b"]), (2, ["a"]), (3, ["a"])), of((1, ["b", "z"]), (2, []), (3, None))
    ledger = spark.createDataFrame([(2, "q"), (2, "q")], "id long, tag string")
    removed = edits.removed_tags(merged, now, ledger, "id")
    assert pairs(removed) == [(1, "a"), (2, "q")]
    assert pairs(edits.removed_tags(merged, now, ledger, "id", refresh="labels")) == [(2, "q")]
    assert pairs(edits.removed_tags(merged, now, ledger, "id", refresh="source")) == []
    with pytest.raises(ValueError):
        edits.removed_tags(merged, now, ledger, "id", refresh="all")
    left = edits.without_removed(of((1, ["c", "a", "d"]), (2, ["q"]), (4, None)), removed, "id")
    assert {r.id: r.tags for r in left.collect()} == {1: ["c", "d"], 2: [], 4: None}


def test_answers(spark):
    given = [(1, '{"framing": "Close_Up, from side", "people": "1girl,, solo", "other": "x"}'), (2, "broken"), (3, None), (4, "{}")]
    e = edits.answer_edits(spark.createDataFrame(given, "id long, answer string"), "id", ["people", "framing"])
    rows = spark.createDataFrame([(i, ["solo"]) for i in range(1, 5)], "id long, tags array<string>")
    out, _ = edits.apply_edits(rows, e, e.select("id", "tag").limit(0), "id")
    assert {r.id: r.tags for r in out.collect()} == {1: ["solo", "1girl", "close up", "from side"], 2: ["solo"], 3: ["solo"], 4: ["solo"]}


def test_snapshots(spark, tmp_path):
    at = f"file://{tmp_path}/s"
    of = lambda *r: spark.createDataFrame(list(r), "text string, name string, more int")
    first = of(("a", "1", 0), (None, "2", 0))
    assert not snapshots.write_snapshot(first.limit(0), at, "g1") and not snapshots.write_snapshot(first, at, "g1", keep=0)
    assert snapshots.write_snapshot(first, at, "g1", keep=2)
    assert not snapshots.write_snapshot(first, at, "g2", keep=2)  # nothing changed
    assert not snapshots.write_snapshot(of(("a", "1", 5)), at, "g2", keep=2, names=["1"])
    assert snapshots.write_snapshot(of(("b", "1", 0), (None, "2", 0)), at, "g2", keep=2, names=["1"])
    assert {(r.name, r.text) for r in snapshots.restore(spark, at).collect()} == {("1", "b")}
    assert {(r.name, r.text) for r in snapshots.restore(spark, at, ["2"], "g1").collect()} == {("2", None)}
    with pytest.raises(ValueError):
        snapshots.write_snapshot(first, at, "g2")
    assert snapshots.write_snapshot(first, at, "g3", skip_if_same=False) and snapshots.generations(spark, at) == ["g3"]
    assert not snapshots.write_snapshot(first, at, "g4", keep=0) and snapshots.generations(spark, at) == []


def test_parameters(spark):
    def stage(rows: DataFrame, key: str, least: int = 0) -> DataFrame:
        return rows.where(F.col(key) >= least)

    assert params.allowed(stage) == {"key": True, "least": False}
    assert params.run(stage, spark.range(5), key="id", least=3).count() == 2
    with pytest.raises(params.ParameterError, match="unknown most, missing key"):
        params.run(stage, spark.range(5), most=1)
    assert "aliases" not in params.allowed(vocab.resolve) and params.allowed(edits.apply_edits) == {"key": True, "tags": False}


def test_vocabulary_is_built_once(spark, tmp_path):
    import os

    source, calls = tmp_path / "tags.csv", []
    source.write_text("x")

    def build():
        calls.append(1)
        return spark.createDataFrame([("a", len(calls))], "name string, posts long")

    def get():
        return [tuple(r) for r in vocab.compact_vocabulary(spark, f"file://{tmp_path}/v", [f"file://{source}"], build).collect()]

    assert get() == get() == [("a", 1)] and len(calls) == 1
    os.utime(source, (4e9, 4e9))
    assert get() == [("a", 2)]


def test_sources_and_leaves(spark):
    df = spark.createDataFrame([("f", "http://s", "j"), ("", "http://s", "j"), (None, "pixiv", "j"), (None, None, None), ("", "ftp", "")], "f string, s string, j string")
    assert [r[0] for r in df.select(first_source(F.col("f"), F.col("s"), F.col("j"))).collect()] == ["f", "http://s", "j", "", ""]
    given = [(1, '{"a": {"b": {"c": 1, "d": "x"}, "e": [1, {"f": 2}]}, "g": null, "h": {}, "i": "{}"}'), (2, "[1]"), (3, "broken {"), (4, None), (5, "7"), (6, "{}")]
    got = {(r.key, r.path): r.value for r in flatten_leaves(spark.createDataFrame(given, "key long, json string"), "key", "json").collect()}
    assert got == {(1, "a.b.c"): "1", (1, "a.b.d"): "x", (1, "a.e"): '[1,{"f":2}]', (1, "g"): None, (1, "h"): None, (1, "i"): "{}"}
    assert flatten_leaves(spark.createDataFrame([], "key long, json string"), "key", "json").count() == 0
