"""Operators on small literal frames, and every SQL query on the smallest tables."""

import os

import duckdb
import pytest

from tessera.operators import dedup, gate, keyed, ranking, vocab
from tessera.operators.components import connected_components
from tessera.operators.wash import layer_rules
from tessera.plans import registry
from tessera.sources import files
from tessera.streaming.ingest import append_new

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float) or hasattr(v, "is_finite"):
        return float(f"{float(v):.9g}")
    return v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted([tuple(plain(r[c]) for c in cols) for r in df.collect()], key=str)
    if name in registry.ORACLE:
        r = duck.execute(registry.ORACLE[name])
        at = [[d[0] for d in r.description].index(c) for c in cols]
        assert got == sorted([tuple(plain(x[i]) for i in at) for x in r.fetchall()], key=str)
    else:
        assert got


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(300)] + [(7, 7), (None, 3), (60, 61), (61, 60)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert {got[i] for i in range(51)} == {0} and got[499] == got[100] == 100 and got[61] == 60 and 3 in got
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_gate_cannot_be_passed(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["Fine"], False), (2, ["'Marked_Term'."], False), (3, ["other name"], False), (4, ["ok"], True), (5, ["ok"], None), (6, [], False), (7, None, False), (8, ["marked***"], False)], "id long, tags array<string>, flag boolean")
    terms = spark.createDataFrame([("marked term",), ("marked",)], "term string")
    aliases = spark.createDataFrame([("other name", "marked term")], "alias string, canonical string")
    kept, held = gate.protect(rows, terms, aliases, policy="flag")
    assert sorted(r.id for r in kept.collect()) == [1, 6] and sorted(r.id for r in held.collect()) == [2, 3, 4, 5, 7, 8] and held.columns == ["id", "rule"]
    gate.write_training(rows, f"{tmp_path}/out", f"{tmp_path}/held", terms, aliases, policy="flag")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 6]
    assert {(r.id, r.rule) for r in spark.read.parquet(f"{tmp_path}/held").collect()} >= {(4, "policy"), (7, "unreadable"), (8, "term:marked")}
    for write in (lambda: gate.protect(rows, terms.limit(0)), lambda: gate.write_training(rows, f"{tmp_path}/no", f"{tmp_path}/held", terms.limit(0))):
        with pytest.raises(gate.GateError):
            write()


def test_take_and_spread(spark):
    df = spark.range(6).selectExpr("id", "1 AS g")
    pick = lambda t: sorted(r.id for r in ranking.spread_pick(df, "g", ["id"], t).collect())
    assert pick("3") == [0, 2, 5] and pick("1") == [0] and pick("99") == list(range(6)) and pick("max(2, n//2)") == [0, 2, 5]
    assert pick("__import__('os')") == pick("2") == pick("2**3") == pick("1//0") == pick("n(2)") == pick("") == [0, 5]
    assert pick("7/2") == pick("3") and pick("0-n") == [0] and pick("n/0") == pick("2") and pick("min(3, n*9)") == pick("3") and pick("-n+9") == pick("3")
    assert pick("2+(1-n)//2+4") == pick("3")


def test_names_are_repaired():
    from tessera.functions.text import repaired_name

    wrong = lambda name, code: name.encode(code).decode("cp437")
    for name in ("\u65b0\u56fe01.png", "\u98ce\u666f.zip"):
        assert repaired_name(wrong(name, "gbk")) == name
    for name in ("d\u00e9tail", "plain.png", "", None, "\u65b0\u56fe.png", "\u00fcber alles", "caf\u00e9 noir"):
        assert repaired_name(name) == name


def test_snapshot_diff(spark):
    from tessera.operators.diff import snapshot_diff

    kind = "id long, items array<string>"
    a = spark.createDataFrame([(1, ["x", "y", "y"]), (2, ["x"]), (3, ["x"]), (4, ["x"]), (5, None)], kind)
    b = spark.createDataFrame([(1, ["x", "z"]), (2, []), (3, ["x"]), (5, []), (6, ["q"])], kind)
    got = {tuple(r) for r in snapshot_diff(a, b, "id", "items").collect()}
    assert got == {(1, 3, 2, 1, 2, "changed"), (2, 1, 0, 0, 1, "emptied"), (4, 1, 0, 0, 1, "gone"), (6, 0, 1, 1, 0, "new")}
    assert snapshot_diff(a.limit(0), b.limit(0), "id", "items").count() == 0


def test_aliases_and_roots(spark):
    a = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")], "alias string, canonical string")
    got = {r.alias: r.canonical for r in vocab.flatten_aliases(a).collect()}
    assert got == {"a": "c", "b": "c", "x": "y", "y": "x"}
    n = spark.createDataFrame([(100, None), (101, 100), (102, 101), (5, 6), (6, 5), (9, 77)], "id long, up long")
    assert {r.node: r.root for r in vocab.chain_roots(n, "id", "up").collect()} == {100: 100, 101: 100, 102: 100, 5: 5, 6: 5, 9: 9}


def test_merges(spark):
    old = spark.createDataFrame([(None, 1), (1, 1)], "k long, v long")
    new = spark.createDataFrame([(None, 2), (2, 2)], "k long, v long")
    assert sorted(map(tuple, keyed.insert_unseen(old, new, ["k"]).collect()), key=str) == [(1, 1), (2, 2), (None, 1)]
    assert sorted(map(tuple, keyed.replace_keyed(old, new, ["k"]).collect()), key=str) == [(1, 1), (2, 2), (None, 2)]


def test_hamming_is_exact(spark):
    import random

    rng = random.Random(3)
    codes = [rng.getrandbits(63) for _ in range(60)]
    codes += [c ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for c in codes]
    df = spark.createDataFrame(list(enumerate(codes)), "id long, code long")
    want = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if (codes[i] ^ codes[j]).bit_count() <= 3}
    assert {(r.a, r.b) for r in dedup.hamming_pairs(df, "id", "code", 3).collect()} == want


def test_rule_layers():
    out = layer_rules(("defaults", {"a": [1], "m": {"x": 1}, "s": 1}), ("call", {"a": [2], "m": {"y": 2}, "s": 0}))
    assert out == {"rules": {"a": [1, 2], "m": {"x": 1, "y": 2}, "s": 0}, "origin": {"a": "call", "m": "call", "s": "call"}}


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", ["x"], ""), (2, "a", ["y", "z"], "u"), (1, "b", None, "v")], "seq long, filename string, tags array<string>, url string")
    files.write_log(rows, f"{tmp_path}/log")
    got = {r.filename: (r.seq, r.tags, r.url) for r in files.read_log(spark, f"{tmp_path}/log").collect()}
    assert got == {"a": (2, ["y", "z"], "u"), "b": (1, None, "v")}
    files.write_report(rows, f"{tmp_path}/report", ["filename", "tags"])
    back = spark.read.option("header", True).csv(f"{tmp_path}/report")
    assert back.columns == ["filename", "tags"] and {r.tags for r in back.collect()} == {"x", "y|z", None}
    os.makedirs(f"{tmp_path}/d/one")
    for n in ("a.PNG", "a.txt", "b.md"):
        with open(f"{tmp_path}/d/one/{n}", "w") as f:
            f.write("tag one, two\n")
    assert [(r.bucket, r.stem, r.ext, r.length) for r in files.list_assets(spark, f"{tmp_path}/d").collect()] == [("one", "a", "png", 13)]
    assert [(r.bucket, r.stem) for r in files.read_captions(spark, f"{tmp_path}/d").collect()] == [("one", "a")]


def test_stream_append(spark, tmp_path):
    for part in ([(1, 5), (2, 1), (1, 6)], [(1, 9), (3, 7)]):
        spark.createDataFrame(part, "k long, seq long").write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("k long, seq long").parquet(f"{tmp_path}/in")
        append_new(stream, f"{tmp_path}/table", f"{tmp_path}/check", "k", "seq", floor=2).awaitTermination(120)
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/table").collect())) == [(1, 5), (3, 7)]


def test_edges_of_a_hub_are_joined_by_broadcast(spark, monkeypatch):
    from tessera.operators import components

    monkeypatch.setattr(components, "HUB_EDGES", 20)
    edges = [(0, i) for i in range(1, 60)] + [(5000, i) for i in range(100, 160)] + [(i, i + 1) for i in range(200, 230)] + [(1, 100)]
    rows = spark.createDataFrame(edges, "src long, dst long").repartition(3)
    got = {r.node: r.component for r in components.connected_components(rows).collect()}
    assert got == {**{i: 0 for i in [*range(60), *range(100, 160), 5000]}, **{i: 200 for i in range(200, 231)}}


def test_signature_passes_over_long_vectors_a_few_times(spark):
    import time

    from pyspark.sql import functions as F

    from tessera.operators.dedup import signature

    rows = [(i, [float((i * k) % 7) for k in range(n)]) for i, n in enumerate((1, 3, 64, 1500))] + [(9, [2.0] * 5), (10, None), (11, []), (12, [1.0, None])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    began = time.time()
    got = {r.id: r.s for r in df.select("id", signature(F.col("v")).alias("s")).collect()}
    assert time.time() - began < 60  # cubic in the length, 1,500 elements take hours
    for i, v in rows[:5]:
        m = sum(v) / len(v)
        n = sum((x - m) ** 2 for x in v) ** 0.5
        assert got[i] == [(x - m) / n if n else 0.0 for x in v] or max(abs(a - (x - m) / n) for a, x in zip(got[i], v, strict=True)) < 1e-12
    assert got[10] is None and got[11] == [] and got[12] == [0.0, 0.0]
