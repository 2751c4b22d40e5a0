"""Periodic runs of words, found online by catchers over dyadic blocks.

A run is a stretch of words with smallest period q, of at least ``max(SHORTEST, TIMES * q)`` words, that neither
neighbouring word extends. Words are appended in chunks of any size. For each power of two L a catcher holds the block of
L words completed last at a multiple of L; each appended word advances the suffix of L words that ends there, and the two
are compared by a prefix hash. The distances between that block and the suffixes compared with it are L to 2 L - 1, so
each period has one catcher; periods under ``LEAST`` share the blocks of ``LEAST`` words. A match is a square or the core
of one: it is held against the words themselves, widened to the stretch that keeps its period, and joined to the stretch
already known for that period. Stretches that reach the last word stay open and grow with the next chunk.

A match that lies inside a stretch of a smaller period is a multiple of that one (Fine and Wilf) and needs no work. Memory
is in proportion to the longest text; nothing depends on how words are cut into chunks.

Null and empty texts and texts without words have no runs. Repeated rows give repeated results; a null ``doc_id`` stays
null. Only the two named columns are read, so that other columns do not matter. Empty tables give empty tables.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.memory import release

SHORTEST, TIMES = 24, 3
#: Words of the smallest block; any run of SHORTEST words with a period below holds such a block and its copy.
LEAST = 8
#: Words appended at a time.
CHUNK = 1 << 14
BASE = np.uint64(0x9E3779B97F4A7C15)
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def same_until(words: np.ndarray, x: int, y: int, end: int) -> int:
    """How many words from ``x`` on equal those from ``y`` > ``x`` on, before ``end``; looks at twice as many each time."""
    done, step = 0, 64
    while y + done < end:
        to = min(step, end - y - done)
        other = words[x + done : x + done + to] != words[y + done : y + done + to]
        if other.any():
            return done + int(other.argmax())
        done, step = done + to, step * 2
    return done


def same_before(words: np.ndarray, x: int, y: int) -> int:
    """How many words before ``x`` equal those before ``y`` > ``x``."""
    done, step = 0, 64
    while done < x:
        to = min(step, x - done)
        other = words[x - done - to : x - done] != words[y - done - to : y - done]
        if other.any():
            return done + int(other[::-1].argmax())
        done, step = done + to, step * 2
    return done


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, BASE)]), dtype=np.uint64)


class Catchers:
    """The words so far, their prefix hash, and the stretches of each period in the order of their starts."""

    def __init__(self, room: int = CHUNK):
        self.n = 0
        self.stretches: dict[int, list[tuple[int, int]]] = {}
        self._grow(max(room, LEAST))

    def _grow(self, room: int) -> None:
        words, sums = np.empty(room, np.int64), np.zeros(room + 1, np.uint64)
        if self.n:
            words[: self.n], sums[: self.n + 1] = self.words[: self.n], self.sums[: self.n + 1]
        self.words, self.sums, self.powers = words, sums, _powers(1 << max(16, room.bit_length()))

    def append(self, more: np.ndarray) -> None:
        """Words ``more``, as integers that are equal where the words are."""
        was, n = self.n, self.n + len(more)
        if n > len(self.words):
            self._grow(max(n, 2 * len(self.words)))
        self.words[was:n] = more
        mixed = (more.astype(np.uint64) + np.uint64(1)) * BASE  # the hash only proposes: matches are held against the words
        mixed ^= mixed >> np.uint64(29)
        self.sums[was + 1 : n + 1] = self.sums[was] + np.cumsum(mixed * self.powers[was:n], dtype=np.uint64)
        self.n = n
        for q, own in self.stretches.items():
            if own[-1][1] == was:
                own[-1] = (own[-1][0], was + same_until(self.words, was - q, was, n))
        self._shorter(was)
        size = LEAST
        while 2 * size <= n:
            self._catch(size, was)
            size *= 2

    def _hash(self, at: np.ndarray, size: int) -> np.ndarray:
        return self.sums[at + size] - self.sums[at]

    def _shorter(self, was: int) -> None:
        """Periods below LEAST: aligned blocks against the suffixes that began less than a block later."""
        for q in range(1, LEAST):
            block = np.arange(max(0, -(-(was + 1 - LEAST - q) // LEAST)), (self.n - LEAST - q) // LEAST + 1) * LEAST
            if len(block):
                for b in block[self._hash(block, LEAST) * self.powers[q] == self._hash(block + q, LEAST)].tolist():
                    self._meet(b, q, LEAST)

    def _catch(self, size: int, was: int) -> None:
        """The suffixes of ``size`` words that ended since ``was``, each against the block that it can square with."""
        i = np.arange(max(size, was + 1 - size), self.n - size + 1)
        b = (i // size - 1) * size
        hit = np.flatnonzero(self._hash(b, size) * self.powers[i - b] == self._hash(i, size))
        if len(hit):
            i, b = i[hit], b[hit]
            free = ~self._covered(b, i + size, size)
            for at, to in zip(b[free].tolist(), i[free].tolist(), strict=True):
                self._meet(at, to - at, size)

    def _covered(self, start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
        """Whether a known stretch of a period up to ``size`` holds [start, end)."""
        return inside(start, end, [x for q, own in self.stretches.items() if q <= size for x in own])

    def _meet(self, b: int, q: int, size: int) -> None:
        """Widen the match of the block at ``b`` with the words ``q`` later, unless its stretch is known."""
        own = self.stretches.get(q)
        if own and b + q + size <= own[-1][1]:
            return
        right = same_until(self.words, b, b + q, self.n)
        if right >= size:  # else only the hashes were equal
            self.stretches.setdefault(q, []).append((b - same_before(self.words, b, b + q), b + q + right))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of every run of the words so far, by start, then period."""
        out: list[tuple[int, int, int]] = []
        for q in sorted(self.stretches):
            long = [x for x in self.stretches[q] if x[1] - x[0] >= max(SHORTEST, TIMES * q)]
            if long:  # a stretch inside one of a smaller period has that period
                within = inside(*np.array(long).T, [(s, s + n) for s, n, _ in out])
                out += [(s, e - s, q) for (s, e), shorter in zip(long, within, strict=True) if not shorter]
        return sorted(out, key=lambda r: (r[0], r[2]))


def inside(start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether one of ``spans`` holds [start, end), for each of many."""
    if not spans:
        return np.zeros(len(start), bool)
    starts, ends = np.array(sorted(spans)).T
    at = np.searchsorted(starts, start, "right") - 1
    return (at >= 0) & (np.maximum.accumulate(ends)[at] >= end)


def find_runs(words: list, chunk: int = CHUNK) -> list[tuple[int, int, int]]:
    """The runs of ``words`` as (start, length, period)."""
    if len(words) < SHORTEST:
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    catchers = Catchers(len(ids))
    for at in range(0, len(ids), chunk):
        catchers.append(ids[at : at + chunk])
    return catchers.runs()


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that some run repeats: of each run its first period stays, unless another run drops it."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    start, length, period = np.array(runs).T
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, runs, collapsed)`` of every row: its runs by start, then period, and its kept words joined by one space."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs, texts = [], []
            for text in batch["text"]:
                words = (text or "").encode("utf-8", "surrogatepass").split()  # cuts at exactly the six ASCII blanks
                found = find_runs(words)
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                texts.append(b" ".join(collapse(words, found)).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "runs": runs, "collapsed": texts})
        release()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInPandas(run, f"doc_id {kind}, runs {RUNS}, collapsed string")


def repeated_from(words: Column, start: Column, period: Column) -> Column:
    """Array ``words`` whose part from ``start`` (counted from 0) on is replaced by repeats of its first ``period`` words."""
    rest = F.transform(F.sequence(start, F.size(words) - 1), lambda i: F.get(words, start + (i - start) % period))
    return F.concat(F.slice(words, F.lit(1), start), rest)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, the first of equal ones; null if there is none."""
    better = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    return F.aggregate(runs, F.lit(None).cast(RUNS[6:-1]), better)
