"""Bucketed tables: which buckets a lookup opens, and that joins leave the table where it lies."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import lists
from ratingloom.session import scratch
from ratingloom.sources import layout

SCHEMA = "uid int, mid int, score double"


def table(spark, count=4000):
    return spark.createDataFrame([(i % 500, i, i / 7) for i in range(count)] + [(None, 1, 1.0)], SCHEMA)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch(spark, "layout")
    layout.store(table(spark), path, "uid", 16)
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_few_keys_open_their_buckets(spark, stored):
    keys = spark.createDataFrame([(3,), (44,), (None,), (9999,)], "uid long")
    found = layout.lookup(spark, stored, keys)
    assert found.select(F.input_file_name()).distinct().count() <= 2
    # The plan names the chosen buckets where the planner is told to show them.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = plan_of(layout.lookup(spark, stored, keys))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    chosen, of = map(int, re.search(r"SelectedBucketsCount: (\d+) out of (\d+)", plan).groups())
    assert of == 16 and chosen <= 3 and "In(uid" in plan and "Exchange" not in plan
    assert rows(found) == rows(table(spark).where("uid in (3, 44)"))


def test_many_keys_leave_the_table_in_place(spark, stored, monkeypatch):
    monkeypatch.setattr(layout, "FEW_KEYS", 10)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = spark.range(0, 900, 3).selectExpr("cast(id as int) as uid", "'x' as mid")
        found = layout.lookup(spark, stored, keys)
        plan = plan_of(found)
        final = plan.split("Initial Plan")[0]
        # Only the keys are exchanged: the table's branch has none between the join and its scan.
        branch = final[final.index("SortMergeJoin") : final.index("FileScan parquet")]
        assert "Exchange" not in branch and "SelectedBucketsCount: 16 out of 16" in plan, plan
        assert rows(found) == rows(lists.find_by_key(table(spark), keys, "uid"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_two_tables_of_one_layout_join_without_exchange(spark, stored):
    other = scratch(spark, "layout")
    layout.store(table(spark, 700), other, "uid", 16)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = layout.opened(spark, stored).join(layout.opened(spark, other).withColumnRenamed("mid", "other").drop("score"), "uid")
        assert "Exchange" not in plan_of(both) and both.count() == sum(8 * (2 if u < 200 else 1) for u in range(500))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_crowded_bucket_is_read_without_the_layout(spark, monkeypatch):
    monkeypatch.setattr(layout, "SKEW_BYTES", 0)
    path = scratch(spark, "layout")
    hot = spark.range(60_000).selectExpr("cast(if(id % 3 = 0, 7, id % 100) as int) as uid", "cast(id as int) as mid", "rand(3) as score")
    layout.store(hot, path, "uid", 16)
    opened = layout.opened(spark, path)
    assert "Bucketed: true" not in plan_of(opened)
    keys = spark.createDataFrame([(7,)], "uid int")
    assert layout.lookup(spark, path, keys).count() == hot.where("uid = 7").count()


def test_empty_tables_and_missing_layouts(spark):
    path = scratch(spark, "layout")
    layout.store(table(spark).limit(0), path, "uid", 4)
    assert layout.lookup(spark, path, spark.createDataFrame([(1,)], "uid int")).collect() == []
    with pytest.raises(FileNotFoundError):
        layout.opened(spark, scratch(spark, "nothing"))
