"""Spellings, suffix families and alias chains against plain versions."""

import random
from difflib import SequenceMatcher
from itertools import combinations
from threading import Timer

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import spelling, vocab
from tests.test_whole import distance


@pytest.mark.parametrize("most", [1, 2, 3])
def test_every_near_pair(spark, most):
    rng = random.Random(most)
    letters = "abéß字"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(0, 9))) for _ in range(160)})
    terms, names = words[::2] + words[:3], words[1::2] + words[:9]
    rows = lambda w, c: spark.createDataFrame([(x,) for x in w] + [(None,)], f"{c} string").withColumn("seg", F.lit(1)).withColumn("lt", F.lit(2))
    got = [tuple(r) for r in spelling.near_spellings(rows(terms, "w"), "w", rows(names, "w"), "w", most).collect()]
    want = {(t, n, distance(t, n)) for t in terms for n in names if t != n and distance(t, n) <= most}
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("most", [1, 2, 3, 4])
def test_near_pairs_of_short_and_long_names(spark, most):
    """Names of 9 to 17 letters, terms by up to ``most`` + 1 edits from them."""
    rng = random.Random(most)
    names = sorted({"".join(rng.choice("abé𝒳") for _ in range(rng.randrange(9, 18))) for _ in range(60)})
    terms = set()
    for w in names:
        for _ in range(rng.randrange(most + 2)):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice("aé𝒳") + w[i:], w[:i] + w[i + 1 :], w[:i] + "b" + w[i + 1 :]])
        terms.add(w)
    rows = lambda w: spark.createDataFrame([(x,) for x in w], "w string")
    got = [tuple(r) for r in spelling.near_spellings(rows(sorted(terms)), "w", rows(names), "w", most).collect()]
    want = {(t, n, distance(t, n)) for t in terms for n in names if t != n and distance(t, n) <= most}
    assert len(got) == len(set(got)) and set(got) == want and {len(n) > spelling.SHORT for _, n, _ in want} == {True, False}


@pytest.mark.parametrize("size", [0, 1, 2, 5])
def test_left_over(size):
    rng = random.Random(size)
    words = ["".join(rng.choice("ab字") for _ in range(size)) for _ in range(30)]
    keys = spelling.left_over(np.array([[*map(ord, w)] for w in words], np.uint32).reshape(30, size), 2)
    left = [["".join(c for i, c in enumerate(w) if i not in out) for m in range(min(2, size) + 1) for out in combinations(range(size), m)] for w in words]
    pairs = {(k, s) for row, strings in zip(keys.tolist(), left, strict=True) for k, s in zip(row, strings, strict=True)}
    assert len(pairs) == len({k for k, _ in pairs}) == len({s for _, s in pairs})


def test_names_of_one_beginning(spark):
    """3.6 billion pairs share a third of a name, most of them letters too; each term is one letter off its name."""
    rest = "substring(translate(md5(cast(id AS string)), '0123456789abcdef', 'klmnopqrklmnopqr'), 1, 8)"
    n = spark.range(60_000).selectExpr(f"concat('begi', {rest}) AS name", f"concat('begi', {rest}, 'x') AS term")
    late = Timer(90, spark.sparkContext.cancelAllJobs)
    late.start()
    try:
        near = spelling.near_spellings(n, "term", n, "name", 2)
        found = near.agg(F.count_if(F.expr("distance = 1 AND term = concat(name, 'x')"))).first()[0]  # a filter would become a key of the join
        assert found == n.distinct().count()
    finally:
        late.cancel()


def test_suggestions_by_ratio(spark):
    names = [("straightforward", 90), ("strange", 80), ("stranger", 80), ("orange", 70), ("rare", 1)]
    v = spark.createDataFrame(names, "name string, posts long")
    t = spark.createDataFrame([("strangr",), ("oranges",), ("xyz",)], "term string")
    got = spelling.suggestions(t, v, 50, 2, 2, least_ratio=0.6).collect()
    for r in got:
        assert r.ratio == pytest.approx(SequenceMatcher(None, r.term, r.name).ratio())
    assert sorted((r.term, r.r, r.name) for r in got) == [("oranges", 1, "orange"), ("strangr", 1, "stranger"), ("strangr", 2, "strange")]


def test_suffix_families(spark):
    v = spark.createDataFrame([("red long coat", 90), ("blue coat", 80), ("raincoat", 99), ("rain-coat", 70), ("coat", 99), ("old coat", 5), ("red long coat", 3)], "name string, posts long")
    h = spark.createDataFrame([("red coat",), ("blue coat",), ("coat",), (None,), ("a very long coat",), ("red coat",)], "head string")
    got = sorted(tuple(r) for r in spelling.suffix_families(h, v, 50, 2).collect())
    assert got == [("blue coat", "rain-coat", 70, 2), ("blue coat", "red long coat", 90, 1), ("red coat", "blue coat", 80, 2), ("red coat", "red long coat", 90, 1)]


@pytest.mark.parametrize("letters", [0, 2, 3])
def test_suffix_families_of_a_common_suffix(spark, letters):
    rng = random.Random(letters)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(0, 5)))
    posts = {f"{word()}{rng.choice(' -')}{rng.choice(['x', 'x', 'x y', 'ab'])}": rng.randrange(20) for _ in range(300)}
    tails = lambda w: [w[i + 1:] for i, c in enumerate(w) if c in " -" and w[i + 1:]]
    want = set()
    for h in posts:
        names = [n for n in posts if n != h and posts[n] > 8 and tails(h) and tails(h)[0] in tails(n)]
        names.sort(key=lambda n: (h[:letters] not in n, -posts[n], n))
        want |= {(h, n, posts[n], i) for i, n in enumerate(names[:3], 1)}
    v = spark.createDataFrame(list(posts.items()), "name string, posts long")
    got = [tuple(r) for r in spelling.suffix_families(v, v, 8, 3, "name", letters).collect()]
    assert len(got) == len(want) and set(got) == want


def test_suffix_families_of_one_suffix_fit_a_disk(spark):
    """3.6 billion pairs of a word and a name, if they were made."""
    v = spark.range(60_000).selectExpr("concat('w', id, ' x') AS name", "9 + id % 7 AS posts")
    h = spark.range(60_000).selectExpr("concat('h', id, ' x') AS head")
    out = spelling.suffix_families(h, v, 8)
    assert out.agg(F.count("*"), F.min("name"), F.max("name"), F.max("r")).first()[:] == (300_000, "w1000 x", "w10023 x", 5)


def plain_aliases(links):
    out = {}
    for a in links:
        path = [a, links[a]]
        while path[-1] in links and links[path[-1]] not in path:
            path.append(links[path[-1]])
        out[a] = path[-1]
    return out


def test_alias_chains(spark):
    rng = random.Random(8)
    links = {f"c{i}": f"c{i + 1}" for i in range(1000)}
    links |= {f"x{i}": f"x{rng.randrange(60)}" for i in range(60)}
    links |= {"self": "self", "p": "q", "q": "p", "into": "self", "far": "into"}
    frame = spark.createDataFrame([*links.items(), ("n", None), (None, "n")], "alias string, canonical string")
    got = [tuple(r) for r in vocab.flatten_aliases(frame).collect()]
    assert len(got) == len(links) and dict(got) == plain_aliases(links)


def test_resolve_follows_chains(spark):
    names = spark.createDataFrame([("end", 1)], "name string, posts long")
    links = spark.createDataFrame([("a", "b"), ("b", "end"), ("c", "gone")], "alias string, canonical string")
    tags = spark.createDataFrame([("a",), ("c",), ("end",), ("no",)], "tag string")
    got = lambda **k: sorted((r.tag, r.canonical, r.kind) for r in vocab.resolve(tags, "tag", names, links, **k).collect())
    assert got(chains=True) == [("a", "end", "alias"), ("c", None, "deprecated"), ("end", "end", "exact"), ("no", None, "missing")]
    assert got()[0] == ("a", None, "deprecated")
