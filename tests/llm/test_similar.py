"""Similarity joins and the pipeline against brute force."""

import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tessera.llm import embedding_dedup, jaccard
from tessera.llm.queries import QUERIES
from tests.llm.test_formats import ODD, brute_quality, check_packing, rows


def components(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {i: find(i) for i in ids}


def brute_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words)} if 0 < len(words) < size else {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_components(texts, size, percent):
    sets = {k: brute_set(t, size) for k, t in texts.items()}
    at = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            at[x].append(k)
    common = defaultdict(int)
    for ks in at.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                common[a, b] += 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    own = components(texts, links)
    return {(k, len(s), own[k]) for k, s in sets.items()}


def family(rng, n, words, edits):
    base = [f"w{x}" for x in rng.integers(0, 3000, words)]
    out = []
    for _ in range(n):
        own = list(base)
        for p in rng.integers(0, words, rng.integers(0, edits + 1)):
            own[p] = f"e{rng.integers(0, 10**6)}"
        out.append(" ".join(own[: words - rng.integers(0, edits + 1)]))
    return out


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_shingle_components(spark, size, percent):
    rng = np.random.default_rng(size)
    texts = ODD + ["A b", "a B", "a b c", "A\tb\nc", "x", "x y"] * 2
    for n, words, edits in ((40, 200, 4), (40, 60, 3), (30, 12, 1), (20, 1500, 40), (30, 400, 25)):
        texts += family(rng, n, words, edits)
    texts = dict(enumerate(texts))
    df = spark.createDataFrame([(k, t, "c", "d") for k, t in texts.items()], "doc_id long, text string, key string, digest string").repartition(4)
    got = {tuple(r) for r in jaccard.shingle_components(df, size, percent).collect()}
    assert got == brute_components(texts, size, percent)
    assert jaccard.shingle_components(df.limit(0), size, percent).count() == 0
    kept = jaccard.keep_one(df.union(df.where("doc_id < 5")), size, percent)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in got}) and kept.columns == df.columns


def test_clusters_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    texts = dict(enumerate(family(rng, 90, 150, 6) + family(rng, 40, 150, 1)))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    assert {tuple(r) for r in jaccard.shingle_components(df, 3, 90).collect()} == brute_components(texts, 3, 90)


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (2, "a b c d"), (3, "a b c d"), (3, "other words entirely here"), (1, "Other words entirely here")], "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard.shingle_components(df, 3, 90).collect()), key=str)
    assert got == sorted([(None, 2, None)] * 2 + [(2, 2, 1), (3, 2, 1), (3, 2, 1), (1, 2, 1)], key=str)
    assert [r.doc_id for r in jaccard.keep_one(df, 3, 90).orderBy("doc_id").collect()] == [None, None, 1]


def test_size_groups_cover_all_pairs():
    for percent in (80, 90, 50):
        groups = jaccard.geometry(percent)
        for n in [*range(1, 400), 1000, 99999]:
            g = next(i for i, x in enumerate(groups) if x[0] <= n <= x[1])
            for m in {n, n * 100 // percent}:
                h = next(i for i, x in enumerate(groups) if x[0] <= m <= x[1])
                assert h == g or h == g + 1 and n * 100 // percent >= groups[g + 1][0]
                assert groups[h][2] >= (100 - percent) * (n + m) // (100 + percent) and groups[h][3] > groups[h][2]


def test_jaccard_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {tuple(r) for r in QUERIES["op9_jaccard"](spark, sf).collect()} == brute_components(texts, 3, 90)


def brute_vectors(data, t=0.9):
    ok = {}
    for n, (k, v) in enumerate(data):
        if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[n] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    links = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b]) and float(ok[a] @ ok[b]) >= t]
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    own = components(range(len(data)), links)
    least = defaultdict(list)
    for n, (k, _) in enumerate(data):
        if k is not None:
            least[own[n]].append(k)
    return sorted(((k, count[n], min(least[own[n]]) if k is not None else None, k is not None and k == min(least[own[n]])) for n, (k, _) in enumerate(data)), key=str)


def test_near_vectors(spark):
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.normal(size=12)]) for i in range(300)]
    for c in range(6):
        base = rng.normal(size=12)
        data += [(1000 * (c + 1) + i, [float(x) for x in base * rng.uniform(0.1, 50) + rng.normal(size=12) * 0.25 * np.linalg.norm(base) / 3.5]) for i in range(60)]
    data += [(9000 + i, data[7][1]) for i in range(40)] + [(9100, None), (9101, []), (9102, [0.0] * 12), (9103, [float("nan")] * 12), (9104, [None] + [1.0] * 11), (9105, [float("inf")] + [1.0] * 11), (None, data[7][1]), (9106, [1.0, 2.0]), (9107, [2.0, 4.0]), (7, data[7][1]), (9108, [-0.0] + [1.0] * 11), (9109, [0.0] + [1.0] * 11)]
    df = spark.createDataFrame([(k, v, 1) for k, v in data], "vec_id long, embedding array<double>, rep int").repartition(5)
    for block in (64, 4096):
        got = embedding_dedup.near_duplicates(df, 0.9, block_rows=block).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute_vectors(data)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_vector_query(spark, sf):
    data = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = QUERIES["op4_embedding_dedup"](spark, sf).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_vectors(data)


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    state, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = stage(spark, state, sf)
        assert state.columns == docs.columns
        seen[name] = {r.doc_id: r.text for r in state.collect()}
    good = {k for k, t in texts.items() if not brute_quality(t)[5]}
    assert seen["quality_rules"].keys() <= good and len(seen["quality_rules"]) > 0.9 * len(good)
    own = brute_components(seen["quality_rules"], 5, 80)
    assert seen["ngram_jaccard"].keys() == {c for _, _, c in own}
    assert seen["pii"].keys() == seen["ngram_jaccard"].keys()
    check_packing(seen["pii"], rows(corpus_pipeline.run(spark, sf)))
