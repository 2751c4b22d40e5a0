import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tessera.llm.periodic_runs import CHUNK, collapse, find_runs, periodic_runs
from tessera.llm.queries import QUERIES


def plain_runs(w):
    """Every period is tried at every word."""
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and w[e] == w[e + q]:
                e += 1
            if e > s and e + q - s >= max(24, 3 * q):
                out.append((s, e + q - s, q))
            s = max(e, s + 1)
    smallest = lambda s, n, q: not any(all(w[s + i] == w[s + i + p] for i in range(n - p)) for p in range(1, q))
    return sorted((r for r in out if smallest(*r)), key=lambda r: (r[0], r[2]))


def some_words(rng):
    n = rng.choice([0, 1, 23, 24, 25, 70, 150, 230])
    w = [str(rng.randrange(rng.choice([1, 2, 3, 60]))) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 30:
            s, q = rng.randrange(n - 25), rng.randrange(1, 40)
            for i in range(s + q, min(n, s + rng.randrange(20, 130))):
                w[i] = w[i - q]
    return w


@pytest.mark.parametrize("seed", range(6))
def test_against_every_period(seed):
    rng = random.Random(seed)
    for _ in range(150):
        w = some_words(rng)
        want = plain_runs(w)
        for chunk in (1, rng.randrange(2, 60), CHUNK):
            assert find_runs(w, chunk) == want


def test_periods_inside_periods():
    w = ([str(i % 7) for i in range(100)] + ["x"]) * 50
    assert find_runs(w) == sorted([(0, 5050, 101), *((101 * k, 100, 7) for k in range(50))], key=lambda r: (r[0], r[2]))
    assert find_runs(["a"] * 100_000) == [(0, 100_000, 1)]
    a, b = ["a"], ["a", "b"]
    while len(b) < 400:
        a, b = b, b + a
    assert find_runs(b) == plain_runs(b)


def test_collapse():
    w = ["x"] + ["a", "b", "c"] * 10 + ["y"]
    assert find_runs(w) == [(1, 30, 3)]
    assert collapse(w, [(1, 30, 3)]) == ["x", "a", "b", "c", "y"]
    assert collapse(["a"], []) == ["a"]


def test_frames(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "w  " * 24, 0), (4, "w  " * 24, 0), (None, "é " * 30 + "z", 0), (7, "a b " * 11 + "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect())
    assert got == sorted([(1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 24, 1)], "w "), (4, [(0, 24, 1)], "w "), (0, [(0, 30, 1)], "é z"), (7, [], "a b " * 11 + "a")])
    assert periodic_runs(docs.where("false")).collect() == []


def test_query(spark, sf):
    """The query against a plain reading of its contract."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where(F.length("text") < 12000)
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    seen = 0
    for doc_id, text in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        runs = plain_runs(w) if h % 10 == 0 or n < 300 else find_runs(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
        drop = {i for s, m, q in runs for i in range(s + q, s + m)}
        r = got[doc_id]
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest()
        seen += len(runs)
    assert seen > 5
