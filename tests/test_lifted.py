"""Operators on the caller's own tables: nulls, empty tables, ties, hot keys, other columns."""

import random

from pyspark.sql import functions as F

from tessera.operators import captions, lookup, numbering, reports, screening, tagstats, vocab
from tessera.operators.wash import Rules, wash


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_numbers_over_many_ranges(spark):
    """A group that holds half of the rows lies in several ranges; another is null."""
    rng = random.Random(4)
    data = [(i, rng.choice(["hot", "hot", f"g{i % 9}", None]), rng.randrange(10**6)) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.createDataFrame(data, "id long, g string, __extra long").repartition(4)
        got = numbering.number_within(df, ["g"], ["__extra", "id"], "n")
        assert got.columns == ["id", "g", "__extra", "n"]
        got = {r.id: r.n for r in got.collect()}
        everywhere = {r.id: r.n for r in numbering.number_all(df, ["__extra", "id"], "n").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, seen = {}, {}
    order = sorted(data, key=lambda r: (r[2], r[0]))
    for i, g, _ in order:
        want[i] = seen[g] = seen.get(g, 0) + 1
    assert got == want and everywhere == {r[0]: n for n, r in enumerate(order, 1)}
    assert numbering.number_within(df.limit(0), ["g"], ["id"]).count() == 0 == numbering.number_all(df.limit(0), ["id"]).count()


def test_names_and_ranks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "a"), (5, None), (6, "b")], "id long, name string")
    got = numbering.distinct_names(df, "name", ["id"], lambda n, i: numbering.serial(n, i, " (", ")"))
    assert rows(got, "id", "name") == [(1, "a"), (2, "a (2)"), (3, None), (4, "a (3)"), (5, None), (6, "b")]
    assert rows(numbering.bucket_ranks(df, "name"), "id", "rank") == [(1, 1), (2, 1), (3, None), (4, 1), (5, None), (6, 2)]


def test_pairs_and_origins(spark):
    a = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id long")
    c = spark.createDataFrame([(1, "x"), (2, ""), (3, None), (9, "y"), (None, "z")], "id long, text string")
    assert rows(lookup.pair_status(a, c, "id", F.col("text") == ""), "id", "status") == [(1, "ok"), (2, "empty"), (3, "ok"), (9, "orphan"), (None, "missing"), (None, "orphan")]
    assert rows(lookup.attach(a, c, "id", "text", "-"), "id", "text") == [(1, "x"), (2, ""), (3, "-"), (None, "-")]
    f = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "f long, p long")
    p = spark.createDataFrame([(10,)], "q long")
    assert rows(lookup.trace_origin(a, "id", f, "f", "p", p, "q"), "id", "origin") == [(1, "A+"), (2, "A"), (3, "A"), (None, "none")]
    assert lookup.pair_status(a.limit(0), c.limit(0), "id", F.col("text") == "").count() == 0


def test_cascade_stops_at_the_first_key_that_is_known(spark):
    catalog = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "b", "y"), (4, None, "z")], "ref long, h string, g string")
    asked = spark.createDataFrame([("p", "a", "x"), ("q", "b", "y"), ("r", "c", "y"), ("s", "c", "x"), ("t", None, "z"), ("u", None, None)], "id string, h string, g string")
    got = lookup.cascade_match(asked, catalog.withColumnRenamed("ref", "doc"), "doc", [("md5", "h"), ("near", "g")])
    assert rows(got, "id", "by", "ref") == [("p", "md5", 1), ("q", "ambiguous", None), ("r", "near", 3), ("s", "ambiguous", None), ("t", "near", 4), ("u", "none", None)]
    got = lookup.fallback_match(asked, catalog, catalog, ("h", "g"), "ref")
    assert rows(got, "id", "match", "by_second") == [("p", 1, False), ("q", 2, False), ("r", 3, True), ("s", 1, True), ("t", 4, True), ("u", None, True)]


def test_names_plans_and_differences(spark):
    e = spark.createDataFrame([("new", ["old", "older"]), ("other", ["old"]), ("bare", None)], "n string, former array<string>")
    asked = spark.createDataFrame([("new",), ("old",), ("older",), ("none",), (None,)], "name string")
    assert rows(lookup.current_name(asked, "name", e, "n", "former"), "name", "current") == [("new", "new"), ("none", None), ("old", "new"), ("older", "new"), (None, None)]
    log = spark.createDataFrame([(1, 2, "keep"), (1, None, "patch"), (5, 6, None)], "a long, b long, d string")
    assert rows(lookup.processed_keys(log, [F.col("a"), F.col("b")], F.col("d")), "k", "decision") == [(1, "keep"), (1, "patch"), (2, "keep")]
    src = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 5)], "k long, at long")
    made = spark.createDataFrame([(1, 6), (2, 4), (3, None), (8, 9)], "k long, built long")
    assert rows(lookup.artifact_plan(src, made, "k", F.col("built") >= F.col("at")), "k", "plan") == [(1, "skip"), (2, "rebuild"), (3, "rebuild"), (4, "build"), (8, "prune")]
    x = spark.createDataFrame([("a", "1"), ("b", None), ("c", "1"), ("d", "2")], "k string, v string")
    y = spark.createDataFrame([("a", "1"), ("b", None), ("d", None), ("e", None)], "k string, v string")
    assert rows(lookup.value_diff(x, y, "k", "v"), "k", "op") == [("c", "-"), ("d", "changed"), ("e", "+")]
    assert rows(lookup.clashing(x.select("v"), y.select("v"), "v"), "v") == [("1",)]
    t = spark.createDataFrame([("a 2024-01-01", "a 2023-05-05"), ("a", "b"), (None, None), (None, "a")], "a string, b string")
    assert [r[0] for r in t.select(lookup.equal_but(F.col("a"), F.col("b"), "[0-9]{4}-[0-9]{2}-[0-9]{2}")).collect()] == [True, False, True, False]


def test_screens(spark):
    t = spark.createDataFrame([(1, ["a", "b"], 5), (2, ["a", "b", "ok"], None), (3, [], 50), (4, None, 500)], "id long, tags array<string>, n long")
    found = screening.reasons({"small": F.col("n") < 10, "big": F.col("n") > 100})
    assert rows(t.select("id", found.alias("f"), screening.decide(found).alias("d")), "id", "f", "d") == [(1, ["small"], "small"), (2, [], "keep"), (3, [], "keep"), (4, ["big"], "big")]
    families = {"ab": (["a", "b"], ["ok"]), "plain": (["a", "b"], [])}
    c = screening.conflicts(F.col("tags"), families)
    assert rows(t.select("id", c.alias("c")), "id", "c") == [(1, ["ab", "plain"]), (2, ["plain"]), (3, []), (4, [])]
    assert rows(screening.family_counts(t, "id", c), "family", "rows") == [("ab", 1), ("plain", 2)]
    assert rows(t.select("id", screening.gaps(F.col("tags"), {"x": ["b", "c"]}).alias("g")), "id", "g") == [(1, []), (2, []), (3, ["x"]), (4, [])]
    i = spark.createDataFrame([(1, "s", ["too-few(3)", "odd"]), (2, "s", ["odd"]), (3, "t", [])], "id long, src string, issues array<string>")
    assert rows(i.select("id", screening.severity(F.col("issues"), ["too-few"]).alias("s")), "id", "s") == [(1, "error"), (2, "warn"), (3, "")]
    assert rows(screening.issue_kinds(i, "issues"), "kind", "n") == [("odd", 2), ("too-few", 1)]
    assert rows(screening.verify_report(i, "src", "issues", ["too-few"]), "src", "severity", "n", "issues") == [("s", "error", 1, 2), ("s", "warn", 1, 1), ("t", "", 1, 0)]
    side = spark.createDataFrame([(1, "x", "A"), (1, "y", "B"), (1, "z", None), (2, "x", "B"), (3, "x", None)], "id long, tag string, side string")
    assert rows(screening.prefer_side(side, "id", "side", "A"), "id", "tag") == [(1, "x"), (1, "z"), (2, "x"), (3, "x")]
    assert rows(screening.residue(side, "id", "tag", F.col("tag") >= "x", 2), "id", "residue") == [(1, "x|y|+1"), (2, "x"), (3, "x")]
    v = spark.createDataFrame([("very long hair",), ("hair",), ("red",), (None,)], "t string")
    got = [r[0] for r in v.select(screening.downgrade_value(F.col("t"), {"long hair": "long", "hair": "any"}, F.lit("?"))).collect()]
    assert got == ["long", "any", "?", "?"]


def test_captions(spark):
    t = spark.createDataFrame([(" , a b,, c , one two three four five six, d",), ("",), (None,)], "text string")
    tags, prose = captions.split_caption(F.col("text"))
    got = t.select(tags.alias("t"), prose.alias("p"), captions.assemble_line(tags, prose).alias("l")).collect()
    assert [(r.t, r.p, r.l) for r in got] == [(["a b", "c", "d"], ["one two three four five six"], "a b, c, d. one two three four five six"), ([], [], ""), (None, None, None)]
    s = spark.createDataFrame([("The end. A NATION here. fine. then",), ("",)], "text string")
    assert [r[0] for r in s.select(captions.prose_kept(F.col("text"), ["tion"], ["the "])).collect()] == [["fine", "then"], [""]]


def test_reports(spark):
    d = spark.createDataFrame([(1, "s", "x", 10), (2, "s", "x", 10), (3, "t", "x", 20), (4, "t", None, None), (5, None, None, 3), (6, "t", "y", 9)], "id long, src string, text string, n long")
    assert rows(reports.exact_groups(d, "id", "text"), "first", "n") == [(1, 3)] and rows(reports.later_copies(d, "id", "text"), "id", "first") == [(2, 1), (3, 1)]
    assert rows(reports.unique_by_bucket(d, "src", "id", ["text"]), "src", "uniq", "dup") == [("s", 1, 1), ("t", 1, 2), (None, 1, 0)]
    assert rows(reports.bucket_counts(d, ["src"], F.col("src") == "s", short=F.col("n") < 10), "src", "n", "short") == [("t", 3, 1), (None, 1, 1)]
    assert rows(reports.caption_health(d, "src", "n", F.col("text").isNotNull(), 10), "src", "n", "missing", "low", "high", "mean", "under") == [("s", 2, 0, 10, 10, 10.0, 0), ("t", 3, 1, 9, 20, 14.5, 1), (None, 1, 1, 3, 3, 3.0, 1)]
    assert rows(reports.pool_tags(d, "id", "text", "src"), "keeper", "pooled") == [(1, "s,t")]
    assert rows(reports.majority_gap(d, "src", F.col("text").isNotNull(), 0.5), "id") == [(4,)]
    assert rows(reports.balance_plan(d, "src", F.col("src") == "s", [(2, 5), (9, 2)], 8), "src", "n", "repeats") == [("s", 2, 2), ("t", 3, 1), (None, 1, 1)]
    assert rows(reports.hit_rates(d, "src", "id", F.col("n") >= 10, ["s", "t", "never"]), "src", "queried", "rate") == [("never", 0, 0.0), ("s", 2, 1.0), ("t", 3, 1 / 3)]
    assert reports.balance_plan(d.limit(0), "src", F.col("src") == "s", [(2, 5)], 8).count() == 0 == reports.exact_groups(d.limit(0), "id", "text").count()


def test_tag_counts(spark):
    t = spark.createDataFrame([(1, "a"), (1, "a"), (1, "zz"), (2, "a"), (2, "cats"), (2, "9x"), (3, None)], "id long, tag string")
    v = spark.createDataFrame([("a", 4, 30, None), ("cat", 0, 5, None), ("zz", 1, 1, "a")], "name string, category int, posts long, parent string")
    assert rows(tagstats.drop_rare(t, "id", "tag", 2), "id", "n", "dropped") == [(1, 3, 1), (2, 3, 2), (3, 1, 0)]
    assert rows(tagstats.residue_top(t.where("tag IS NOT NULL"), "tag", v, "name", 1), "tag", "n") == [("9x", 1)]
    assert rows(tagstats.vocabulary_audit(t.where("tag IS NOT NULL"), "tag", v, 2), "distinct_tags", "unknown", "rare") == [(4, 2, 1)]
    assert rows(tagstats.kept_by_category(t, "id", "tag", v, [4], []), "id", "kept") == [(1, 1), (2, 2), (3, 1)]
    assert rows(tagstats.gated_drops(t, "id", "tag", v, "^z", "[0-9]"), "id", "tag", "n") == [(1, "zz", 1), (2, "9x", 1)]
    assert rows(tagstats.canonical_forms(t, "tag", v, [lambda x: F.regexp_replace(x, "s$", "")]), "tag", "canonical") == [("cats", "cat")]
    assert rows(tagstats.implied_present(t, "id", "tag", v), "id", "folded") == [(1, 1)]


def test_alias_chains_of_any_length(spark):
    links = [(f"n{i}", f"n{i + 1}") for i in range(14)] + [("x", "y"), ("y", "x"), ("self", "self"), (None, "a"), ("b", None)]
    a = spark.createDataFrame(links, "alias string, canonical string")
    got = {r.alias: r.canonical for r in vocab.flatten_aliases(a).collect()}
    assert got == {f"n{i}": "n14" for i in range(14)} | {"x": "y", "y": "x", "self": "self"}
    assert vocab.flatten_aliases(a.limit(0)).count() == 0
    v = spark.createDataFrame([("n14", 0, 9, None), ("other", 0, 9, None)], "name string, category int, posts long, parent string")
    t = spark.createDataFrame([(1, ["N3", "other", "n9"]), (2, []), (3, None)], "id long, tags array<string>")
    lines, dropped = wash(t, "id", F.col("tags"), v, a, Rules(), F.col("category"))
    assert rows(lines, "id", "n_tags", "line") == [(1, 2, "n14, other")] and dropped.count() == 0
