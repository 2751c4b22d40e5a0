"""Column functions for names, dates, urls and tags."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGES = ("jpg", "jpeg", "png", "webp", "gif", "html")


def post_date(value: Column) -> Column:
    """An epoch number or an ISO prefix as a date string, else the first ten characters, null as empty."""
    number = F.when(value.rlike(r"^[0-9]{9,11}$"), value.cast("long"))
    iso = F.regexp_extract(value, r"^([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    return F.coalesce(F.date_format(F.timestamp_seconds(number), "yyyy-MM-dd"), F.when(iso != "", iso), F.substring(value, 1, 10), F.lit(""))


def url_ext(url: Column, fallback: str = "jpg") -> Column:
    """The lower-case extension of a url without query and fragment if it is a known one, else ``fallback``."""
    ext = F.lower(F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"\.([A-Za-z0-9]+)/?$", 1))
    return F.when(ext.isin(*IMAGES), ext).otherwise(fallback)


def safe_name(name: Column, most: int = 80) -> Column:
    """Illegal characters to underscores, white space folded, length capped."""
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(name, r'[\\/:*?"<>|#]', "_"), r"\s+", " ")), 1, most)


def words(text: Column) -> Column:
    """Lower-case words of a whole text."""
    return F.filter(F.split(F.lower(text), r"[ \t\n\r\f]+", -1), lambda w: w != "")


def normalize_tag(tag: Column) -> Column:
    """Quotes and trailing punctuation off, underscores to blanks, folded, lower case; tags without a letter or digit stay."""
    bare = F.regexp_replace(F.regexp_replace(tag, r"^[\"']+|[\"']+$", ""), r"^[.,;:]+|[.,;:]+$", "")
    folded = F.trim(F.regexp_replace(F.replace(bare, F.lit("_"), F.lit(" ")), r" +", " "))
    return F.when(~tag.rlike(r"[\p{L}\p{N}]"), tag).otherwise(F.lower(folded))


def lookup_key(tag: Column) -> Column:
    """Without backslashes, blanks as underscores."""
    return F.replace(F.replace(tag, F.lit("\\"), F.lit("")), F.lit(" "), F.lit("_"))


def short_digest(value: Column) -> Column:
    """The first twelve hexadecimal digits of SHA-1."""
    return F.substring(F.sha1(value.cast("binary")), 1, 12)


def human_bytes(n: Column) -> Column:
    """A size in B, KB, MB or GB with one decimal."""
    unit = F.when(n >= 1 << 30, "GB").when(n >= 1 << 20, "MB").when(n >= 1 << 10, "KB").otherwise("B")
    size = F.when(n >= 1 << 30, n / (1 << 30)).when(n >= 1 << 20, n / (1 << 20)).when(n >= 1 << 10, n / (1 << 10)).otherwise(n)
    return F.concat(F.round(size, 1).cast("string"), F.lit(" "), unit)


#: An East Asian character beside an ASCII letter: a sign that accented Latin was taken for half of one.
MIXED = re.compile(r"[A-Za-z][\u2e80-\ud7ff\uf900-\ufaff]|[\u2e80-\ud7ff\uf900-\ufaff][A-Za-z]")


def repaired_name(name: str | None) -> str | None:
    """A file name whose bytes were read as code page 437, read again as GBK, GB 18030 or UTF-8, whichever fits first.

    Names that are plain ASCII, that code page 437 cannot hold, that fit none of the three, or whose reading mixes East
    Asian characters into Latin words stay as they are.
    """
    if not name or name.isascii():
        return name
    try:
        raw = name.encode("cp437")
    except UnicodeEncodeError:
        return name
    for code in ("gbk", "gb18030", "utf-8"):
        try:
            out = raw.decode(code)
        except UnicodeDecodeError:
            continue
        return name if MIXED.search(out) else out
    return name


def repair_name(name: Column) -> Column:
    """``repaired_name`` of a column of names; Spark's own decoders lack these code pages."""

    @F.pandas_udf("string")
    def run(names: pd.Series) -> pd.Series:
        return names.map(repaired_name, na_action="ignore")

    return run(name)


def first_source(file: Column, source: Column, *others: Column) -> Column:
    """The first url that is there: the file's, the source if it is an http url, then ``others``; else empty."""
    there = lambda c: F.when(c != "", c)
    return F.coalesce(there(file), F.when(source.startswith("http"), source), *map(there, others), F.lit(""))
