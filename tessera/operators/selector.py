"""Selection of rows by a table of tokens: names, numeric ranges ``a-b`` and globs, from text or from list files of any length.

Every kind of token is an equi-join: names by their lower-cased full name and stem, ranges by the dyadic intervals that they are
made of, globs by the literal at their start or end, whichever is longer; the pattern itself is verified after that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.numbering import number_all
from tessera.sources.lines import read_lines

#: Numbers of ranges have at most 18 digits, so 60 levels of intervals hold them.
LEVELS = 60
STEM, DIGITS = r"^(.+?)(?:\.[^.]*)?$", "([0-9]{1,18})$"


class SelectorError(ValueError):
    """A list of names that names nothing."""


def _tokens(lines: DataFrame, place: list) -> DataFrame:
    each = lines.select(*place, F.posexplode(F.split("line", ",", -1)).alias("sub", "t")).select(*place, "sub", F.trim("t").alias("token")).where("token <> ''")
    first = each.groupBy("token").agg(F.min(F.struct(*place, "sub")).alias("at"))
    return number_all(first, ["at"], "place").select("token", "place")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """``(token, place)`` of a list file: a token a line or several between commas, ``#`` lines are comments, a token counts where it comes first.

    A byte order mark and white space around tokens are dropped. A missing file and one without a token raise.
    """
    lines = read_lines(spark, path).withColumn("line", F.trim(F.regexp_replace("line", r"^\s+|\s+$", ""))).where("NOT startswith(line, '#')")
    out = _tokens(lines, ["file", "at"])
    if out.isEmpty():
        raise SelectorError(f"no name in the list {path}")
    return out


def parse(spark: SparkSession, text: str) -> DataFrame:
    """``(token, place)`` of tokens between commas; ``@path`` reads a list file."""
    text = text.strip()
    if text.startswith("@"):
        path = text[1:].strip().strip("\"'")
        if not path:
            raise SelectorError("@ must be followed by the path of a list")
        return read_list(spark, path)
    return _tokens(spark.createDataFrame([(text,)], "line string").withColumn("at", F.lit(0)), ["at"])


def _dyadic(low: Column, high: Column) -> Column:
    """The dyadic intervals ``(level, block)`` that make up ``[low, high]``: at most two a level."""
    one = F.lit(1).cast("long")
    up = lambda x, i: F.call_function("shiftright", x, i)
    first = lambda i: up(low + F.call_function("shiftleft", one, i) - one, i)
    last = lambda i: up(high + one, i) - one
    left = lambda i: F.when((first(i) <= last(i)) & (first(i) % 2 == 1), F.struct(i.alias("level"), first(i).alias("block")))
    right = lambda i: F.when((first(i) <= last(i)) & (last(i) % 2 == 0), F.struct(i.alias("level"), last(i).alias("block")))
    # a block of level i holds 2^i numbers, so none of a higher level than the length's logarithm fits
    top = F.char_length(F.bin(F.greatest(one, high - low + 1))) - 1
    levels = F.sequence(F.lit(0), F.least(top, F.lit(LEVELS - 1)))
    return F.array_distinct(F.array_compact(F.concat(F.transform(levels, left), F.transform(levels, right))))


def select(rows: DataFrame, key: str, name: str, tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(matches, unmatched)``: ``(key, place)`` of every row that a token fits, with the first such token, and the tokens that fit none.

    ``key`` is that of one row. A range holds the number at the end of a stem, a glob (``*`` and ``?``) fits the whole name or stem, and so does
    a plain token; case does not matter. A range also counts as a plain name. Null names match nothing.
    """
    stem = F.regexp_extract(F.lower(name), STEM, 1)
    named = rows.where(F.col(name).isNotNull()).select(F.col(key).alias("k"), F.explode(F.array_distinct(F.array(F.lower(name), stem))).alias("name"))
    numbers = rows.select(F.col(key).alias("k"), F.regexp_extract(stem, DIGITS, 1).try_cast("long").alias("x")).where("x IS NOT NULL")
    t = tokens.select(F.lower("token").alias("token"), "place")
    glob = F.col("token").rlike(r"[*?]")
    plain = named.join(t.where(~glob).withColumnRenamed("token", "name"), "name").select("k", "place")

    ends = F.regexp_extract_all("token", F.lit(r"[0-9]{1,18}"), 0)
    ranges = t.where(F.col("token").rlike(r"^[0-9]{1,18}-[0-9]{1,18}$")).select("place", F.get(ends, 0).cast("long").alias("low"), F.get(ends, 1).cast("long").alias("high"))
    pieces = ranges.select("place", F.inline(_dyadic(F.col("low"), F.col("high"))))
    # at most LEVELS rows; a number is copied only to the levels that a range is made of
    used = sorted(r.level for r in pieces.select("level").distinct().collect())
    level = [F.struct(F.lit(i).alias("level"), F.call_function("shiftright", F.col("x"), F.lit(i)).alias("block")) for i in used]
    inside = numbers.select("k", F.inline(F.array(*level))).join(pieces, ["level", "block"]).select("k", "place") if used else plain.limit(0)

    start, end = F.regexp_extract("token", r"^[^*?]*", 0), F.regexp_extract("token", r"[^*?]*$", 0)
    front = F.length(start) >= F.length(end)
    pattern = F.regexp_replace("token", r"([\\^$.|+()\[\]{}])", r"\\$1")
    pattern = F.concat(F.lit("(?s)^"), F.replace(F.replace(pattern, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))
    globs = t.where(glob).select("place", front.alias("front"), F.when(front, start).otherwise(end).alias("part"), pattern.alias("pattern"))
    # as many rows as literals have lengths
    forms = [(r.front, r.n) for r in globs.select("front", F.length("part").alias("n")).distinct().collect()]
    cut = [F.when(F.length("name") >= n, F.struct(F.lit(f).alias("front"), (F.substring("name", 1, n) if f else F.right("name", F.lit(n))).alias("part"))) for f, n in forms]
    fits = plain.union(inside)
    if cut:
        parts = named.select("k", "name", F.inline(F.array_compact(F.array(*cut))))
        fits = fits.union(parts.join(globs, ["front", "part"]).where(F.regexp_like("name", F.col("pattern"))).select("k", "place"))
    matches = fits.groupBy("k").agg(F.min("place").alias("place")).select(F.col("k").alias(key), "place")
    return matches, tokens.join(fits.select("place").distinct(), "place", "left_anti").select("token", "place")
