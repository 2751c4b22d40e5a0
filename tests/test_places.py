"""Words folded inside rows, and the join that broadcasts frequent ones."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_against_sql import same
from tessera.functions import text as T
from tessera.operators.places import join_common, word_counts, word_places
from tessera.operators.wash import Rules, lines_of

DOCS = "doc_id long, text string, source string, n_chars long"


def odd_documents():
    rng = random.Random(3)
    words = ["und", "the", "this", "that", "is", "it", "wordone", "wordon", "doc", "wor", "12", '"', "_wor_", "Wordone,", "thon", "x-y", "no way"] + [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(60)]
    # two rows of one document, in which a word's first place differs from its place among the different words
    return [(i, t, "s", 5) for i, t in enumerate(texts)] + [(3, "the the the the is", "s", 5), (3, "this it that wor", "s", 5), (90, None, "s", 0), (91, "", "s", 0), (92, " \n\t ", "s", 0)]


def test_words_of_a_row_once(spark):
    rows = [(1, "b a b\nc b"), (1, "c"), (2, None), (3, ""), (4, "A a")]
    got = [tuple(r) for r in word_places(spark.createDataFrame(rows, "id long, t string").coalesce(1), "id", T.words(F.col("t"))).collect()]
    assert sorted(got) == [(1, "a", 1, 1), (1, "b", 0, 3), (1, "c", 0, 1), (1, "c", 3, 1), (4, "a", 0, 2)]


@pytest.mark.parametrize("most_bytes", [0, 2_000, 10_000, 1 << 25])
def test_common_values_are_broadcast_and_no_row_is_lost(spark, most_bytes):
    words = [f"w{min(i % 200, i % 7)}" if i % 3 else f"r{i}" for i in range(900)] + [None, "r3x"]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, w string")
    table = spark.createDataFrame([(w, n, k) for w, n in Counter(words[:900]).items() for k in range(1 + n % 2)] + [("r3x", None, 7)], "w string, n long, k int")
    got = join_common(rows, table, "w", "n", most_bytes)
    assert sorted(map(str, got.select("id", "w", "n", "k").collect())) == sorted(map(str, rows.join(table, "w").select("id", "w", "n", "k").collect()))


@pytest.mark.parametrize("name", ["wash", "wash_drops", "vocab_lookup", "lowfreq_drop", "category_drop", "dict_check", "alias_resolve"])
def test_equal_to_sql(spark, tmp_path, name):
    assert same(spark, tmp_path, name, documents=(odd_documents(), DOCS))


def test_a_long_row_is_not_compared_tag_by_tag(spark):
    n = 60_000
    t = spark.range(n).select(F.lit(1).alias("id"), F.col("id").cast("int").alias("pos"), F.lit(0).alias("sub"), F.concat(F.lit("t"), "id").alias("tag"), F.concat(F.lit("t"), F.col("id") * 2).alias("parent"), F.lit(0).alias("slot"), F.lit(None).cast("string").alias("reason"))
    began = time.time()
    (line,) = lines_of(t, "id", Rules()).collect()
    assert line.n_tags == n // 2 and line.line.startswith("t1, t3, t5") and time.time() - began < 15


def test_slots_are_ordered_in_place(spark, tmp_path):
    import __spark_entry__ as entry

    rows = [r for r in odd_documents() if r[0] != 3] + [(None, "aa b", "s", 1)]
    got = same(spark, tmp_path, "slot_order", documents=(rows, DOCS))
    assert len(got) > 50
    plan = entry.queries()["slot_order"](spark, str(tmp_path))
    assert "collect_list" not in plan.where("doc_id IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString().split("Union")[0]
    spark.createDataFrame([(3, "a bb b", "s", 5), (3, "ccc zz c_c", "s", 5), (4, "x", "s", 5), (5, None, "s", 0)], DOCS).write.parquet(f"{tmp_path}/two/documents.parquet")
    two = sorted((r.doc_id, r.ordered) for r in entry.queries()["slot_order"](spark, f"{tmp_path}/two").collect())
    assert two == [(3, "a b bb zz ccc c c"), (4, "x")]


def test_word_counts(spark):
    texts = ["a\tB\n\nb  c", " A\r\fa ", None, "", " ", "\n", "ΟΔΟΣ\tΣ ΟΔΟΣ. İ", "x\x0by z x", "ΟΔΟΣ"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    want = {r.w: r.n for r in rows.select(F.explode(T.words(F.col("text"))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    got = [tuple(r) for r in word_counts(rows, "text").collect()]
    assert len(got) == len(want) and dict(got) == want and want["a"] == 3 and "" not in want
