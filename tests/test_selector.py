"""Selection by tokens against plain matching."""

import fnmatch
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import selector

NAMES = ["0001.png", "0002.PNG", "0010.jpg", "a_0011.png", "Cat.png", "cat.jpg", "cart.png", "x+y.png", "x.y.tar", "noext", "3-5", "100%", None, "", "0004", "999999999999999999"]


def plain(tokens):
    out = {}
    for i, name in enumerate(NAMES):
        if name is None:
            continue
        low = name.lower()
        stem = low.rpartition(".")[0] or low
        number = re.search("([0-9]{1,18})$", stem)
        for place, t in enumerate(tokens, 1):
            t = t.lower()
            span = re.fullmatch("([0-9]+)-([0-9]+)", t)
            glob = "*" in t or "?" in t
            hit = span and number and int(span[1]) <= int(number[1]) <= int(span[2])
            if hit or (any(fnmatch.fnmatchcase(x, t) for x in (low, stem)) if glob else t in (low, stem)):
                out[i] = place
                break
    return out


@pytest.mark.parametrize("text", ["cat, 0002.png,noext,none", "1-3,0-0,5-4,10-11, 4-999999999999999999", "c*t.png,*.png,?????,x+?,*", "3-5,100%,c?t,*1", "*.y*,a_*"])
def test_select(spark, text):
    rows = spark.createDataFrame(list(enumerate(NAMES)), "k int, name string").repartition(3)
    tokens = [t.strip() for t in text.split(",")]
    matches, unmatched = selector.select(rows, "k", "name", selector.parse(spark, text))
    assert {r.k: r.place for r in matches.collect()} == plain(tokens)
    assert {r.token for r in unmatched.collect()} == {t for t in tokens if not plain([t])}


def test_numbers_go_only_to_levels_of_ranges(spark, monkeypatch):
    made, inline = [], F.inline
    monkeypatch.setattr(F, "inline", lambda c: made.append(c) or inline(c))
    rows = spark.createDataFrame([(i, f"n{i}.png") for i in range(40)], "k int, name string")
    matches, _ = selector.select(rows, "k", "name", selector.parse(spark, "7-10, 8-8, 30-20, 0-3"))
    assert {r.k: r.place for r in matches.collect()} == {0: 4, 1: 4, 2: 4, 3: 4, 7: 1, 8: 1, 9: 1, 10: 1}
    copies = spark.range(1).select(F.lit(5).cast("long").alias("x")).select(F.size(made[1]).alias("n")).first().n
    assert copies == 3  # levels 0, 1 and 2, not all 60


def test_list_file(spark, tmp_path):
    (tmp_path / "l.txt").write_text("﻿# names\r\n\r\n b , a,,\t\r\n  # more\nc\nb,d", newline="")
    (tmp_path / "none.txt").write_text("# only\n\n , ,\n")
    got = sorted((r.place, r.token) for r in selector.parse(spark, f' @"{tmp_path}/l.txt"').collect())
    assert got == [(1, "b"), (2, "a"), (3, "c"), (4, "d")]
    for wrong in (f"@{tmp_path}/none.txt", "@ "):
        with pytest.raises(selector.SelectorError):
            selector.parse(spark, wrong)
    with pytest.raises(Exception, match="FileNotFound"):
        selector.parse(spark, f"@{tmp_path}/missing.txt")
    assert selector.parse(spark, "").count() == 0
