"""Queries over small tables of odd rows, against their own SQL in DuckDB."""

import datetime as dt

import duckdb

import __spark_entry__ as entry


def same(spark, folder, name, **tables):
    """The query's rows, after they are found equal to those of its SQL; ``tables`` are (rows, schema)."""
    db = duckdb.connect()
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted((tuple(r) for r in entry.queries()[name](spark, str(folder)).collect()), key=key)
    assert got == sorted(db.execute(entry.oracle_sql()[name]).fetchall(), key=key)
    return got


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def test_dates_round_to_the_second(spark, tmp_path):
    at = [dt.datetime(2024, 1, 1, 23, 59, 59, us) for us in (499_999, 500_000, 700_000)] + [dt.datetime(1970, 1, 2), dt.datetime(1965, 5, 5, 23, 59, 59, 600_000), None]
    rows = [(3 * i + k, t, 1, "click", 1.0) for i, t in enumerate(at) for k in range(3)] + [(99, at[0], 1, None, 1.0), (101, at[0], 1, None, 1.0)]
    got = same(spark, tmp_path, "date_normalise", events=(rows, EVENTS))
    assert [r[2] for r in got[:9:3]] == ["2024-01-01", "2024-01-02", "2024-01-02"]


def test_layers_of_many_events(spark, tmp_path):
    rows = [(5, 1, "error", 1.0), (2_000_005, 1, "view", 2.0), (7, 2, "error", 3.0), (900_007, 2, "click", 4.0), (8, 3, "error", None), (9, 3, "view", 5.0), (1, 4, None, None), (1, 5, "error", 6.0), (2_500_000, 5, "view", 7.0)]
    got = same(spark, tmp_path, "rule_layers", events=([(i, None, u, e, v) for i, u, e, v in rows], EVENTS))
    assert [r[1] for r in got] == [1.0, 3.0, 5.0, None, 7.0]


def test_tags_folded_before_joins(spark, tmp_path):
    text = " ".join(["Wordone," * 1, "wor", "wordone", "_wor_", "the", "The"] * 12 + ["abcdefgh", "abcdefg", "12", '"'])
    rows = [(1, text, "s", 5), (1, text + " la", "s", 5), (2, None, "s", 0), (3, "", "s", 0), (4, "wor wordone", "s", 2)]
    docs = (rows, "doc_id long, text string, source string, n_chars long")
    for name in ("alias_resolve", "implication_fold", "dict_check"):
        (tmp_path / name).mkdir()
        assert same(spark, tmp_path / name, name, documents=docs)


def test_aliases_of_aliases_are_resolved(spark, tmp_path):
    words = {"waters": 3, "waterss": 2, "water": 60, "plants": 30, "plantss": 1, "plant": 4, "rivers": 25, "river": 50, "riverss": 1}
    docs = ([(i, f"{w} " * n, "s", 0) for i, (w, n) in enumerate(words.items())] + [(99, None, "s", 0)], "doc_id long, text string, source string, n_chars long")
    (tmp_path / "all").mkdir()
    (tmp_path / "one").mkdir()
    got = dict(same(spark, tmp_path / "all", "alias_resolve_all", documents=docs))
    one = dict(same(spark, tmp_path / "one", "alias_resolve", documents=docs))
    assert got == {"exact": 165, "alias": 3 + 2 + 1, "deprecated": 1 + 4}
    assert one == {"exact": 165, "alias": 3 + 1 + 1, "deprecated": 2 + 4}
