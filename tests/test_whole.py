"""Queries over all of their rows, held against brute force on small tables."""

import pytest

from tessera.plans import registry


def union_find(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def table(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def lines(spark, folder):
    """A chain of 40 orders, a hub part and two loose edges."""
    edges = [(i, i + d) for i in range(40) for d in (0, 1)] + [(100 + i, 500) for i in range(60)] + [(7000, 900), (20_000_000, 901)]
    table(spark.createDataFrame([(a, b, 0.01, 0.01) for a, b in edges], "l_orderkey long, l_partkey long, l_discount double, l_tax double"), folder, "lineitem")
    return str(folder)


@pytest.mark.parametrize("given", [True, False])
def test_components_all(spark, sf, tmp_path, given):
    folder = sf if given else lines(spark, tmp_path)
    edges = [(2 * r.l_orderkey, 2 * r.l_partkey + 1) for r in spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_partkey").collect()]
    got = [tuple(r) for r in registry.QUERIES["components_all"](spark, folder).select("node", "component").collect()]
    assert len(got) == len(set(got)) and dict(got) == union_find(edges)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("name", ["near_terms", "near_terms_all"])
def test_near_terms(spark, tmp_path, name):
    often = {"straße": 60, "strasse": 50, "straßen": 70, "niño": 55, "слово": 50, "internationalisation": 80, "stra": 51, "über": 90}
    rare = {"straßee": 1, "straß": 49, "strasze": 2, "niños": 3, "словa": 1, "internationalizatiom": 1, "stràße": 1, "überr": 2, "ni": 4, "lonely": 2}
    posts = often | rare
    text = " ".join(" ".join([w] * n) for w, n in posts.items())
    table(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string"), tmp_path, "documents")
    want = set()
    for t in rare:
        near = sorted((distance(t, n), -posts[n], n) for n in often if (n[:3] == t[:3] or name == "near_terms_all") and distance(t, n) <= 2)
        want |= {(t, n, d, r) for r, (d, _, n) in enumerate(near[:3], 1)}
    got = [tuple(r) for r in registry.QUERIES[name](spark, str(tmp_path)).select("term", "name", "distance", "r").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {"straßee", "straß", "niños", "словa", "internationalizatiom", "überr"} <= {t for t, *_ in want}


def vectors(spark, folder, label=0):
    """Seven given vectors: 1, 2 equal; 3, 4 a tenth of an element apart; 6, 7 apart by one changed sign; ids no million apart."""
    base = [[((i * 37 + k * 11) % 23 - 11.5) / 60 for i in range(64)] for k in range(4)]
    change = lambda v, i, x: [*v[:i], x, *v[i + 1 :]]
    rows = [base[0], base[0], base[1], change(base[1], 5, base[1][5] * 0.9), base[2], base[3], change(base[3], 9, -base[3][9])]
    table(spark.createDataFrame([(i, v, label) for i, v in zip((1, 2, 3, 4, 6, 7, 8), rows, strict=True)], "vec_id long, embedding array<float>, label int"), folder, "embeddings")
    return str(folder)


def brute_pairs(rows):
    """{(a, b): (distance, ssim, mean, max, block)} of pairs within four sign bits; a row is (id, elements)."""
    import numpy as np

    at = {k: np.array(v, float) for k, v in rows}
    out = {}
    for a in at:
        for b in at:
            d = int(((at[a] > 0) != (at[b] > 0)).sum())
            if a < b and d <= 4:
                x, y = at[a] * 127 + 128, at[b] * 127 + 128
                c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
                cov = ((x - x.mean()) * (y - y.mean())).mean()
                s = (2 * x.mean() * y.mean() + c1) * (2 * cov + c2) / ((x.mean() ** 2 + y.mean() ** 2 + c1) * (x.var() + y.var() + c2))
                diff = abs(x - y)
                out[a, b] = d, s, diff.mean(), diff.max(), diff.reshape(8, 8).mean(1).max()
    return out


def planted_rows(spark, folder):
    from tessera.plans.assets import planted

    return [(r.vec_id, tuple(r.e)) for r in planted(lambda t: spark.read.parquet(f"{folder}/{t}.parquet")).collect()]


@pytest.mark.parametrize("given", [True, False])
def test_dedup_tiers(spark, sf, tmp_path, given):
    folder = sf if given else vectors(spark, tmp_path)
    rows = planted_rows(spark, folder)
    first = {}
    for k, v in sorted(rows):
        first.setdefault(v, k)
    want = {("exact", "drop", first[v], k) for k, v in rows if first[v] != k}
    pairs = brute_pairs([(k, v) for v, k in first.items()])
    roots = union_find([p for p, x in pairs.items() if x[1] >= 0.995])
    want |= {("near", "drop", c, k) for k, c in roots.items() if k != c}
    want |= {("similar", "review", *p) for p, x in pairs.items() if 0.97 <= x[1] < 0.995}
    got = [(r.tier, r.decision, r.keeper, r.dropped) for r in registry.QUERIES["dedup_tiers"](spark, folder).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {t for t, *_ in want} >= {"exact", "similar" if given else "near"}


def is_same(x):
    return x[0] <= 4 and x[1] >= 0.995 and x[2] <= 2 and x[3] <= 24 and x[4] <= 8


@pytest.mark.parametrize("given", [True, False])
def test_same_pairs(spark, sf, tmp_path, given):
    folder = sf if given else vectors(spark, tmp_path)
    rows = planted_rows(spark, folder)
    first, n = {}, {}
    for k, v in sorted(rows):
        k = first.setdefault(v, k)
        n[k] = n.get(k, 0) + 1
    want = brute_pairs([(k, v) for v, k in first.items()])
    got = {(r.a, r.b): r for r in registry.QUERIES["same_pairs"](spark, folder).collect()}
    assert set(got) == set(want)
    for p, r in got.items():
        assert (r.distance, r.ssim, r.mean, r.most, r.block) == pytest.approx(want[p]) and r.same == is_same(want[p])
        assert (r.na, r.nb) == (n[p[0]], n[p[1]])
    assert {(r.vec_id, r.rep) for r in registry.QUERIES["same_members"](spark, folder).collect()} == {(k, first[v]) for k, v in rows}
    assert given or n[1] > 1 and is_same(want[3, 4]) and not got[7, 8].same


@pytest.mark.parametrize("given", [True, False])
def test_greedy_dedup(spark, sf, tmp_path, given):
    folder = sf if given else vectors(spark, tmp_path)
    same = {p for p, x in brute_pairs(planted_rows(spark, folder)).items() if is_same(x)}
    label = {r.vec_id % 1000000: r.label for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    kept, want = [], set()
    for k, _ in sorted(planted_rows(spark, folder)):
        by = [x for x in kept if (x, k) in same and label[x % 1000000] == label[k % 1000000]]
        want |= {(k, by[0])} if by else set()
        kept += [] if by else [k]
    assert {(r.dropped, r.of) for r in registry.QUERIES["greedy_dedup"](spark, folder).collect()} == want


@pytest.mark.parametrize("given", [True, False])
def test_content_dedup(spark, sf, tmp_path, given):
    folder = sf if given else vectors(spark, tmp_path)
    rows = planted_rows(spark, folder)
    same = {p for p, x in brute_pairs(rows).items() if is_same(x)}
    label = {r.vec_id % 1000000: r.label for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    at = sorted((label[k % 1000000], k) for k, _ in rows)
    kept = []
    for b, k in at:
        if not any((min(x, k), max(x, k)) in same for _, x in kept):
            kept.append((b, k))
    want = {(b, sum(x == b for x, _ in kept), sum(x == b for x, _ in at) - sum(x == b for x, _ in kept)) for b, _ in kept}
    assert {(r.label, r.uniq, r.dup) for r in registry.QUERIES["content_dedup"](spark, folder).collect()} == want
