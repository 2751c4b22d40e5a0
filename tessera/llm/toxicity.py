"""Toxic passages: maximal scoring segments over token log-odds, judged by extreme-value statistics.

A token is the first ``STEM`` code points of a lower-cased word, so that inflected and compound forms share their evidence.
Its log-odds between toxic and clean training texts are those of Monroe, Colaresi and Quinn (2008): counts with a Dirichlet
prior in proportion to the token's count over all documents, divided by their standard error for a z-score. A token whose
log-odds are large, significant and seen after several different words (copies of one passage always repeat the same word
before it) scores its rounded log-odds; all other tokens cost one. A linear scan (Ruzzo and Tompa 1999) finds all maximal
scoring segments of a text. Under clean text the best segment score of n words follows an extreme-value law with
E = K n exp(-lambda S) (Karlin and Altschul 1990): lambda solves the moment equation of the word scores of the clean
training texts, K is the maximum likelihood over the same texts. A document's segments are combined by the sum statistic
(Karlin and Altschul 1993), and a logistic curve over the training rows turns that into a score.

Counts and the scan cover all whole texts; the classifier is fitted on at most about ``MOST_LABELS`` labelled rows, chosen
by a hash of their id, and keeps at most ``MOST_TOKENS`` tokens. Only texts are inputs of a score.

Null and empty texts have no words and get the score of a text without segments. A ``doc_id`` that is null is never
labelled nor held out. Of several labels of one id the largest counts; null labels do not. Repeated rows are scored each.
Without any label all scores are 0. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.memory import release
from tessera.storage import discard, materialize

STEM = 5
#: The prior counts this share of each token's occurrences once more.
PRIOR = 0.1
#: Evidence that a token needs: log-odds, their z-score, and different words before it (of 63 hashed places).
LEAST_ODDS, LEAST_Z, LEAST_CONTEXTS = 1.5, 2.33, 3
MOST_LABELS, MOST_TOKENS = 500_000, 200_000
#: Distinct tokens after which a task hands on its counts.
FLUSH = 200_000
#: A passage is significant if so many as strong ones are expected in a clean text of its length.
MOST_EXPECTED = 0.05
SEGMENTS = "array<struct<first: bigint, last: bigint, score: bigint>>"
find_words = re.compile(r"\w+").findall


@dataclass(frozen=True)
class Model:
    weights: dict[str, int]
    decay: float = 1.0  # lambda
    k: float = 0.1
    base: float = -math.inf  # of the logistic curve
    slope: float = 0.0


def tokens(text: str | None) -> list[str]:
    return [w[:STEM] for w in find_words((text or "").lower())]


def maximal_segments(scored: list[tuple[int, int]], n: int, cost: int = 1) -> list[tuple[int, int, int]]:
    """All maximal scoring segments (first, last, score) of ``n`` words, of which those not in ``scored`` (position, score) cost ``cost``.

    Each candidate keeps a link to the last earlier one that began lower, so that the scan is linear.
    """
    first, last, low, high, link = [], [], [], [], []
    total, done = 0, 0
    for at, score in scored:
        total -= cost * (at - done)
        done = at + 1
        if score > 0:
            begin, start, end = at, total, total + score
            j = len(low) - 1
            while True:
                while j >= 0 and low[j] >= start:
                    j = link[j]
                if j < 0 or high[j] >= end:
                    break
                begin, start = first[j], low[j]
                for x in (first, last, low, high, link):
                    del x[j:]
                j = len(low) - 1
            for x, value in zip((first, last, low, high, link), (begin, at, start, end, j), strict=True):
                x.append(value)
        total += score
    return [(a, b, y - x) for a, b, x, y in zip(first, last, low, high, strict=True)]


def scan(docs: DataFrame, model: Model, text: str = "text", *keep: str) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``n`` (words), ``hits`` (scores of words with evidence and how many words have them)
    and ``segments`` (first and last word, from 0, and score)."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)  # at most MOST_TOKENS short strings

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = weights.value.get
        for b in batches:
            n, hits, found = [], [], []
            for t in b.pop("__text"):
                every = tokens(t)
                scored = [(i, s) for i, s in enumerate(map(get, every)) if s]
                n.append(len(every))
                hits.append([{"score": s, "words": k} for s, k in Counter(s for _, s in scored).items()])
                found.append([{"first": i, "last": j, "score": s} for i, j, s in maximal_segments(scored, len(every))])
            yield b.assign(n=np.array(n, np.int64), hits=hits, segments=found)
        release()

    rows = docs.select(*keep, F.col(text).alias("__text"))
    return rows.mapInPandas(run, ", ".join([*(f"{c} {t}" for c, t in rows.dtypes[:-1]), "n bigint", "hits array<struct<score: bigint, words: bigint>>", f"segments {SEGMENTS}"]))


def token_counts(docs: DataFrame, text: str, toxic: str) -> DataFrame:
    """``(token, n, bad, good, contexts)``: occurrences in all texts, in toxic and in clean ones, and a bit set of the words before it in toxic ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> pd.DataFrame:
            out = [(t, n, bad[t], good[t], contexts.get(t, 0)) for t, n in every.items()]
            for x in (every, bad, good, contexts):
                x.clear()
            return pd.DataFrame(out, columns=["token", "n", "bad", "good", "contexts"])

        every, bad, good, contexts = Counter(), Counter(), Counter(), {}
        for b in batches:
            for t, y in zip(b["t"], b["y"], strict=True):
                of = tokens(t)
                every.update(of)
                if y == 1:
                    bad.update(of)
                    for before, token in zip(["", *of], of, strict=False):
                        contexts[token] = contexts.get(token, 0) | 1 << zlib.crc32(before.encode("utf-8", "surrogatepass")) % 63
                elif y == 0:
                    good.update(of)
                if len(every) >= FLUSH:
                    yield rows()
        yield rows()
        release()

    parts = docs.select(F.col(text).alias("t"), F.col(toxic).cast("double").alias("y")).mapInPandas(run, "token string, n bigint, bad bigint, good bigint, contexts bigint")
    return parts.groupBy("token").agg(*(F.sum(c).alias(c) for c in ("n", "bad", "good")), F.expr("bit_or(contexts)").alias("contexts"))


def fit_tokens(docs: DataFrame, text: str = "text", toxic: str = "y") -> Model:
    """The scores of tokens with evidence."""
    counts = materialize(token_counts(docs, text, toxic), "toxic-tokens")
    total = counts.agg(*(F.sum(c).cast("double").alias(c) for c in ("n", "bad", "good"))).first()
    weights = {}
    if total.bad and total.good:
        bad, good = F.col("bad") + F.col("n") * PRIOR, F.col("good") + F.col("n") * PRIOR
        odds = F.log(bad / (total.bad + total.n * PRIOR - bad)) - F.log(good / (total.good + total.n * PRIOR - good))
        judged = counts.where((F.col("bad") > 0) & (F.bit_count("contexts") >= LEAST_CONTEXTS))
        judged = judged.select("token", odds.alias("odds"), (odds / F.sqrt(1 / bad + 1 / good)).alias("z"))
        strong = judged.where((F.col("odds") >= LEAST_ODDS) & (F.col("z") >= LEAST_Z)).orderBy(F.desc("z"), "token").limit(MOST_TOKENS)
        weights = {r.token: round(r.odds) for r in strong.collect()}
    discard(counts)
    return Model(weights)


def decay(mass: dict[int, float], cost: int = 1) -> float:
    """The positive root of sum p(s) exp(x s) = 1 over word scores in clean text; what ``mass`` leaves over scores -cost."""
    scores = {**mass, -cost: mass.get(-cost, 0.0) + max(0.0, 1 - sum(mass.values()))}
    if not any(s > 0 for s in scores):
        return 1.0
    excess = lambda x: sum(p * math.expm1(x * s) for s, p in scores.items())
    low, high = 1e-6, 1e-6
    while excess(high) < 0:
        low, high = high, high * 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def evidence(n: int, scores: np.ndarray, model: Model) -> float:
    """Minus the log of the chance that a clean text of ``n`` words has segments like these, by the sum statistic."""
    if not len(scores):
        return 0.0
    normal = np.sort(model.decay * np.asarray(scores, float))[::-1] - math.log(model.k * n)
    top = float(normal[0])
    best = top if top > 30 else -math.log(-math.expm1(-math.exp(-top))) if top > -3 else 0.0
    sums = np.cumsum(normal)
    r = np.arange(1, len(sums) + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log(r))])  # of factorials
    fit = sums > np.maximum(r, 1)
    more = sums[fit] - (r[fit] - 1) * np.log(sums[fit]) + logs[r[fit]] + logs[r[fit] - 1] - (r[fit] - 1) * math.log(2)
    return float(max([best, *more]))


def with_evidence(scanned: DataFrame, model: Model) -> DataFrame:
    """``scanned`` with ``x``, the log of one more than its evidence."""

    @F.pandas_udf("double")
    def x(n: pd.Series, scores: pd.Series) -> pd.Series:
        return pd.Series([math.log1p(evidence(a, s, model)) for a, s in zip(n, scores, strict=True)], dtype=float)

    return scanned.withColumn("x", x("n", F.transform("segments", lambda s: s["score"])))


def calibrate(scanned: DataFrame, model: Model, toxic: str = "y") -> Model:
    """The model with its lambda, its K and its logistic curve, from the rows with a label; a few hundred sums reach the driver."""
    clean = scanned.where(f"{toxic} = 0")
    n = clean.agg(F.sum("n")).first()[0] or 0
    mass = dict.fromkeys(model.weights.values(), 0.5 / (n + 1))
    for r in clean.select(F.explode("hits").alias("h")).groupBy("h.score").agg(F.sum("h.words").alias("words")).collect():
        mass[r.score] += r.words / (n + 1)
    model = replace(model, decay=decay(mass))
    top = F.coalesce(F.array_max(F.transform("segments", lambda s: s["score"])), F.lit(0))
    t = clean.agg(F.sum(F.when(top > 0, 1.0).otherwise(0.0)).alias("some"), F.sum(F.col("n") * F.exp(-model.decay * top)).alias("weight")).first()
    model = replace(model, k=((t.some or 0) + 0.5) / ((t.weight or 0) + 1))
    table = with_evidence(scanned.where(F.col(toxic).isNotNull()), model).groupBy((F.round(F.col("x") * 20) / 20).alias("x")).agg(F.sum(F.col(toxic).cast("double")).alias("bad"), F.count("*").alias("n")).collect()
    if not table:
        return model
    x, bad, n = (np.array([r[k] for r in table], float) for k in ("x", "bad", "n"))
    base, slope = logistic(x, bad, n)
    return replace(model, base=base, slope=slope)


def logistic(x: np.ndarray, bad: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Platt's curve: targets are drawn in by a pseudocount, so that the curve stays finite where classes part cleanly."""
    high, low = (bad.sum() + 1) / (bad.sum() + 2), 1 / ((n - bad).sum() + 2)
    target = bad * high + (n - bad) * low
    c = np.array([math.log((target.sum()) / (n.sum() - target.sum())), 0.0])
    design = np.stack([np.ones_like(x), x], 1)
    loss = lambda c: float(np.sum(n * np.logaddexp(0, design @ c) - target * (design @ c)) + 5e-4 * c[1] ** 2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-design @ c))
        gradient = design.T @ (n * p - target) + np.array([0, 1e-3 * c[1]])
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag([1e-9, 1e-3])
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(c - size * step) > loss(c):
            size /= 2
        c = c - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(c[0]), float(max(c[1], 0.0))


def with_labels(docs: DataFrame, labels: DataFrame, doc_id: str, toxic: str) -> DataFrame:
    """``docs`` with ``y``, the label or null; at most about MOST_LABELS labels, by hash of their id, are broadcast."""
    rows = labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.max(toxic).cast("int").alias("y"))
    share = min(1.0, MOST_LABELS / max(1, rows.count()))
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    return docs.join(F.broadcast(rows), docs[doc_id] == F.col("__id"), "left").drop("__id")


def significant(segments: str, n: str, model: Model) -> Column:
    """Those of ``segments`` that a clean text of ``n`` words would hold MOST_EXPECTED times or less."""
    return F.filter(segments, lambda s: F.log(F.lit(model.k) * F.col(n)) - model.decay * s["score"] <= math.log(MOST_EXPECTED))


def score(docs: DataFrame, labels: DataFrame, held_out: Column, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic") -> DataFrame:
    """``(doc_id, held_out, score, n, passages)`` of every row; ``labels`` of rows where ``held_out`` holds are not used.

    ``passages`` are the significant toxic segments: first and last word, counted from 0, and score.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(toxic).alias("toxic")).where(~F.coalesce(held_out, F.lit(False)))
    rows = with_labels(rows, known, "doc_id", "toxic")
    model = fit_tokens(rows)
    scanned = materialize(scan(rows, model, "text", "doc_id", "held_out", "y"), "toxic-segments")
    model = calibrate(scanned, model)
    chance = F.lit(0.0) if model.base == -math.inf else 1 / (1 + F.exp(-(model.base + model.slope * F.col("x"))))
    out = with_evidence(scanned, model)
    return out.select("doc_id", "held_out", chance.alias("score"), "n", significant("segments", "n", model).alias("passages"))
