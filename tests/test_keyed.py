"""Keyed tables: what changes where, beside the plain changes of whole frames."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

from ratingloom.sources import keyed, sinks
from ratingloom.sources.keyed import ConcurrentChange, KeyedTable

RATING = "uid int, mid int, score double, ts long"


def ratings(spark, count=200):
    rows = [(i % 40, i % 17, float(i % 5), i) for i in range(count)] + [(3, 3, 1.0, 900), (3, 3, 2.0, 901), (None, 4, 1.0, 5)]
    return spark.createDataFrame(rows, RATING)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def stored(spark, tmp_path, buckets=8):
    return KeyedTable.create(ratings(spark), f"{tmp_path}/ratings", ("uid", "mid"), ("uid",), buckets)


def files(table):
    """Data files by bucket."""
    found = {}
    for folder, _, names in os.walk(table.path.removeprefix("file:")):
        parts = [p for p in folder.split("/") if p.startswith("bucket=")]
        if parts:
            found.setdefault(int(parts[0][7:]), set()).update((folder, n) for n in names if n.endswith(".parquet"))
    return found


def test_a_deleted_rating_touches_one_bucket(spark, tmp_path):
    table = stored(spark, tmp_path)
    before = files(table)
    key = spark.createDataFrame([(3, 3)], "uid long, mid long")
    table.delete(key)
    after = files(table)
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert all(before[b] <= after[b] for b in before)
    expected = sinks.delete_rating(ratings(spark), key)
    assert rows_of(table.rows()) == rows_of(expected) and expected.count() < ratings(spark).count()
    table.compact()
    table.drop_older()
    folded = files(table)
    assert sum(before[b] != folded[b] for b in before) == 1
    assert rows_of(KeyedTable(spark, table.path).rows()) == rows_of(expected)


def test_changes_equal_those_of_whole_frames(spark, tmp_path):
    table, plain = stored(spark, tmp_path, 4), ratings(spark)
    updates = spark.createDataFrame([(3, 3, 5.0, 1000), (3, 3, 4.0, 999), (77, 1, 1.0, 1), (0, 0, 2.5, 2)], RATING)
    more = spark.createDataFrame([(3, 3, 0.5, 1), (78, 1, 1.0, 1)], RATING)
    for round_ in range(2):
        table.upsert(updates, "ts")
        plain = sinks.upsert_ratings(plain, updates)
        table.append(more)
        plain = plain.unionByName(more)
        assert rows_of(table.rows()) == rows_of(plain)
        gone = spark.createDataFrame([(78, 1), (5, 5), (1000, 1)], "uid int, mid int")
        table.delete(gone)
        plain = sinks.delete_rating(plain, gone)
        table.insert_new(spark.createDataFrame([(78, 1, 3.0, 4), (78, 1, 2.0, 4), (3, 3, 9.0, 9)], RATING))
        plain = plain.unionByName(spark.createDataFrame([(78, 1, 2.0, 4)], RATING))
        assert rows_of(table.rows()) == rows_of(plain)
        if not round_:
            table.compact([1, 3])
            assert rows_of(table.rows()) == rows_of(plain)
            table.drop_older()
    some = spark.createDataFrame([(3,), (78,)], "uid int")
    assert rows_of(table.rows(some)) == rows_of(plain.where("uid in (3, 78)"))
    assert rows_of(table.rows(spark.createDataFrame([(3, 3)], "uid int, mid int"))) == rows_of(plain.where("uid = 3 and mid = 3"))


def test_a_lookup_opens_only_its_buckets(spark, tmp_path):
    table = stored(spark, tmp_path)
    asked = spark.createDataFrame([(3,)], "uid int")
    bucket = asked.select(table.bucket().alias("b")).first().b
    assert table._asked(asked) == [bucket]
    read = table._scan("rows", table.schema, table._state(), [bucket]).select(F.input_file_name().alias("f")).distinct().collect()
    assert {int(r.f.split("bucket=")[1].split("/")[0]) for r in read} == {bucket}
    plan = table.rows(asked)._jdf.queryExecution().executedPlan().toString()
    assert f"(bucket#" in plan and f"= {bucket})" in plan.split("PartitionFilters")[1]


def two_keys(spark, table):
    """Keys of two different buckets."""
    at = {r.b: r.uid for r in spark.range(40).select(F.col("id").cast("int").alias("uid")).select("uid", table.bucket().alias("b")).collect()}
    return list(at.values())[:2]


def test_writers_of_different_buckets_both_succeed(spark, tmp_path, monkeypatch):
    table = stored(spark, tmp_path)
    one, two = (spark.createDataFrame([(u, m) for m in range(17)], "uid int, mid int") for u in two_keys(spark, table))
    # Both see the same state before either has finished.
    state, gate = table._state(), threading.Barrier(2)
    monkeypatch.setattr(KeyedTable, "_state", lambda self: gate.wait(60) and None or state)
    threads = [threading.Thread(target=KeyedTable(spark, table.path).delete, args=(keys,)) for keys in (one, two)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    monkeypatch.undo()
    left = {r.uid for r in table.rows().collect()}
    assert not left & set(two_keys(spark, table)) and len(left) == 39


def test_of_two_writers_of_a_bucket_one_fails_and_leaves_nothing(spark, tmp_path, monkeypatch):
    table = stored(spark, tmp_path)
    one, two = two_keys(spark, table)
    both = spark.createDataFrame([(u, m) for u in (one, two) for m in range(17)], "uid int, mid int")
    state = table._state()
    table.delete(both.where(f"uid = {two}"))
    now, held = rows_of(table.rows()), files(table)
    monkeypatch.setattr(KeyedTable, "_state", lambda self: state)
    with pytest.raises(ConcurrentChange):
        table.delete(both)
    monkeypatch.undo()
    assert rows_of(table.rows()) == now and files(table) == held
    table.delete(both)
    assert not {r.uid for r in table.rows().collect()} & {one, two}


def test_an_unfinished_change_is_not_seen_and_can_be_cleared(spark, tmp_path, monkeypatch):
    table = stored(spark, tmp_path)
    before = rows_of(table.rows())
    real = keyed._create

    def crash(spark_, path, text=""):
        if "/done." in path:
            raise SystemExit
        real(spark_, path, text)

    monkeypatch.setattr(keyed, "_create", crash)
    monkeypatch.setattr(keyed, "forget", lambda *a: None)
    with pytest.raises(SystemExit):
        table.delete(spark.createDataFrame([(3, 3)], "uid int, mid int"))
    monkeypatch.undo()
    assert rows_of(table.rows()) == before
    with pytest.raises(ConcurrentChange):
        table.delete(spark.createDataFrame([(3, 4)], "uid int, mid int"))
    table.drop_older()
    table.delete(spark.createDataFrame([(3, 3)], "uid int, mid int"))
    assert len(rows_of(table.rows())) < len(before)


def test_no_rows_and_no_keys(spark, tmp_path):
    table = KeyedTable.create(spark.createDataFrame([], RATING), f"{tmp_path}/empty", ("uid", "mid"), ("uid",))
    table.delete(spark.createDataFrame([], "uid int, mid int"))
    assert rows_of(table.rows()) == []
    table.append(spark.createDataFrame([(1, 2, 3.0, 4)], RATING))
    assert rows_of(table.rows()) == [(1, 2, 3.0, 4)]
    with pytest.raises(FileExistsError):
        KeyedTable.create(ratings(spark), f"{tmp_path}/empty", ("uid", "mid"))
