"""Quality rules with host verdicts: rule failures by host, shrunk by an empirical beta prior, joined back.

Null text counts as a text without words (and fails). A null host has no host verdict. Repeated rows count as often
as they occur. Texts are processed whole; a document's counts need memory in proportion to that document only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.memory import release

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
#: A host whose shrunk failure rate is above this is rejected.
MAX_HOST_RATE = 0.6
SYMBOLS, BLANKS = b"#*$%&|<>", b" \t\n\r\x0b\x0c"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words which occurs twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code = ids[:n]
    for k in range(1, window):  # exact: each prefix of a window is renumbered before the next word joins it
        _, code = np.unique(code * len(number) + ids[k : k + n], return_inverse=True)
    starts = np.flatnonzero(np.bincount(code)[code] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def text_features(text: str | None) -> tuple[int, int, int, int, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() cuts at exactly the six ASCII blanks
    lines = [x for x in raw.split(b"\n") if x.strip(BLANKS)]
    chars = len(text or "") - (len(raw) - len(raw.translate(None, BLANKS)))
    return len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def features(text: str | Column) -> Column:
    """A struct of the base counts of ``text``."""

    @F.pandas_udf(FEATURES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([text_features(x) for x in texts], columns=[c.split()[0] for c in FEATURES.split(", ")], dtype="int64")
        release()

    return run(text)


def base_failed(f: str) -> Column:
    """Whether the counts in struct column ``f`` fail the base rules."""
    n = F.col(f"{f}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{f}.n_repeat_words") > REPEAT_PERCENT * n)


def host_rates(rows: DataFrame, host: str, failed: str) -> DataFrame:
    """``(host, n, failures, rate)``: the failure rate of each host shrunk towards the corpus.

    The prior's mean is the corpus rate; its strength comes from the spread of host rates beyond what sampling
    explains (method of moments). Only one row of totals reaches the driver.
    """
    by_host = rows.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("failures"))
    t = by_host.agg(F.sum("n"), F.sum("failures"), F.count("*"), F.sum(F.col("failures") * F.col("failures") / F.col("n"))).first()
    n, bad, hosts, squares = (float(x or 0) for x in t)
    mean = bad / n if n else 0.0
    spread = (squares / n - mean * mean if n else 0.0) - (mean * (1 - mean) * hosts / n if n else 0.0)
    strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 1000.0) if spread > 0 else 1000.0
    rate = (F.col("failures") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return by_host.withColumn("rate", rate)


def with_verdicts(rows: DataFrame, rejected: DataFrame, host: str, failed: str) -> DataFrame:
    """``rows`` with ``kept``; ``rejected(host)`` is joined back (an equi-join that Spark broadcasts or splits by size)."""
    bad = rejected.select(F.col("host").alias("__bad_host"))
    joined = rows.join(bad, F.col(host) == F.col("__bad_host"), "left")
    return joined.withColumn("kept", ~F.col(failed) & F.col("__bad_host").isNull()).drop("__bad_host")


def score(docs: DataFrame, save, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Every row's counts, ``base_failed`` and ``kept``; keeps ``doc_id`` and the host only.

    ``save`` writes the counts, which serve both the host rates and the result.
    """
    rows = docs.select("doc_id", F.col(host).alias("host"), features(text).alias("f"))
    rows = save(rows.select("doc_id", "host", "f.*", base_failed("f").alias("base_failed")))
    bad = host_rates(rows, "host", "base_failed").where(F.col("rate") > max_rate)
    return with_verdicts(rows, bad, "host", "base_failed").drop("host")


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that pass, with its columns. Counts are made twice so that texts are never shuffled."""
    columns = [F.col(f"d.{c}") for c in docs.columns]
    judged = docs.select(F.struct(*docs.columns).alias("d"), F.col(host).alias("h"), features(text).alias("f")).withColumn("bad", base_failed("f"))
    rejected = host_rates(judged.select("h", "bad"), "h", "bad").where(F.col("rate") > max_rate)
    return with_verdicts(judged, rejected, "h", "bad").where("kept").select(*columns)
