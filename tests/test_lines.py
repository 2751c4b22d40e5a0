"""Lines with their place, and the logs and mappings that are read by it."""

import io
import random

import pytest

from tessera.sources import files, lines


def plain(data: bytes):
    at, out = 0, []
    for part in data.split(b"\n"):
        out.append((at, part))
        at += len(part) + 1
    return out if out[-1][1] else out[:-1]


def test_any_cut_gives_every_line_once():
    rng = random.Random(3)
    for _ in range(200):
        data = bytes(rng.choice(b"ab\n") for _ in range(rng.randint(0, 60))) * rng.randint(1, 2)
        cuts = sorted({0, len(data), *(rng.randint(0, len(data)) for _ in range(4))})
        chunk = rng.randint(1, 9)
        got = [x for lo, hi in zip(cuts, cuts[1:]) for x in lines.lines_in(io.BytesIO(data), lo, hi, chunk)]
        assert got == plain(data)
        lo = rng.choice(cuts)
        assert lines.whole_lines(io.BytesIO(data), lo, len(data), chunk) == max(lo, data.rfind(b"\n") + 1)


def test_ranges_of_files(spark, tmp_path):
    data = {"a": "﻿x\r\n\nlong" + "g" * 500 + "\nlast", "b": "", "c": "é\n" * 300, "_hidden": "no\n"}
    for name, text in data.items():
        (tmp_path / name).write_text(text, newline="")
    want = {(n, at, line.decode().removesuffix("\r").removeprefix("﻿")) for n in "abc" for at, line in plain(data[n].encode())}
    for size in (7, 64, 1 << 20):
        got = lines.read_lines(spark, f"file://{tmp_path}", size).collect()
        assert len(got) == len(want) and {(r.file.rsplit("/", 1)[1], r.at, r.line) for r in got} == want
    assert lines.read_lines(spark, f"{tmp_path}/b").count() == 0
    with pytest.raises(Exception, match="FileNotFound"):
        lines.read_lines(spark, f"{tmp_path}/none").count()


def test_log_without_sequence(spark, tmp_path):
    (tmp_path / "1.jsonl").write_text('{"filename":"a","ext":"png"}\n\n{"filename":"b","ext":"jpg"}\n{"filename":"a","ext":"gif"}\n')
    (tmp_path / "2.jsonl").write_text('{"filename":"b","ext":""}\n{"ext":"x"}\nnot json\n{"filename":"c","ext":"a"}\n{"filename":"c","ext":"b"}')
    got = {(r.filename, r.ext) for r in files.read_log(spark, str(tmp_path), by_place=True).collect()}
    assert got == {("a", "gif"), ("b", None), ("c", "b")}
    with open(tmp_path / "1.jsonl", "a") as f:
        f.write('{"filename":"a","ext":"new"}\n')
    assert ("a", "new") in {(r.filename, r.ext) for r in files.read_log(spark, str(tmp_path), by_place=True).collect()}


def test_mapping_by_place(spark, tmp_path):
    (tmp_path / "1.csv").write_text('﻿new_name,old_name\n"n,1",o1\nn2,o2\n"n,1",o3\n')
    (tmp_path / "2.csv").write_text('new_name,bucket,old_name\nn2,b,"say ""x"""\nn3,b,o5\n\n')
    (tmp_path / "3.csv").write_text("new_name,seq,old_name\nn3,2,first\nn3,1,second\n")
    got = files.read_mapping(spark, str(tmp_path))
    assert {(r.new_name, r.old_name, r.bucket) for r in got.collect()} == {("n,1", "o3", None), ("n2", 'say "x"', "b"), ("n3", "first", None)}
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.csv").write_text("")
    empty = files.read_mapping(spark, f"{tmp_path}/none")
    assert empty.columns == ["new_name", "bucket"] and empty.count() == 0


def test_stream_of_lines(spark, tmp_path):
    log, out, state = tmp_path / "log", tmp_path / "out", tmp_path / "state"
    log.mkdir()

    def step():
        q = lines.stream_lines(spark, str(log), 5).writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(state)).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted((r.file[-1], r.at, r.line) for r in spark.read.parquet(str(out)).collect())

    (log / "a").write_text("one\ntwo\nhal")
    assert step() == [("a", 0, "one"), ("a", 4, "two")]
    with open(log / "a", "a") as f:
        f.write("f\n")
    (log / "b").write_text("new\n")
    assert step() == [("a", 0, "one"), ("a", 4, "two"), ("a", 8, "half"), ("b", 0, "new")]
    assert len(step()) == 4
