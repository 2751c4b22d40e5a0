"""Captions: tags and prose of a line, and the line made of them again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_caption(text: Column, prose_words: int = 6) -> tuple[Column, Column]:
    """``(tags, prose)``: the parts between commas, trimmed, without empty ones; a part of ``prose_words`` words is prose.

    A null text has null parts.
    """
    bare = F.regexp_replace(text, r"^[ \t\n\f\r,]+", "")
    parts = F.filter(F.transform(F.split(bare, ",", -1), lambda x: F.trim(x)), lambda x: x != "")
    n = lambda x: F.size(F.split(x, " ", -1))
    return F.filter(parts, lambda x: n(x) < prose_words), F.filter(parts, lambda x: n(x) >= prose_words)


def assemble_line(tags: Column, prose: Column, sentences: int = 3) -> Column:
    """Tags by commas, then the first ``sentences`` of the prose (the bound is the format's)."""
    tail = F.when(F.size(prose) > 0, F.concat(F.lit(". "), F.array_join(F.slice(prose, 1, sentences), ". "))).otherwise("")
    return F.concat(F.array_join(tags, ", "), tail)


def prose_kept(text: Column, within: list[str], openings: list[str]) -> Column:
    """The sentences that neither hold a term of ``within`` nor begin with one of ``openings``, whatever their case."""

    def clean(s: Column) -> Column:
        ok = F.lit(True)
        for t in within:
            ok = ok & ~F.contains(F.lower(s), F.lit(t))
        for t in openings:
            ok = ok & ~F.startswith(F.lower(s), F.lit(t))
        return ok

    return F.filter(F.split(text, r"\. ", -1), clean)
