"""Large tables are joined and grouped in tasks of bounded rows."""

from __future__ import annotations

import random

import pytest

from ratingloom import session
from ratingloom.operators import factors
from ratingloom.plans import standins


@pytest.fixture
def tables(spark, tmp_path):
    rnd = random.Random(1)
    items = [(rnd.randrange(300), rnd.randrange(40), float(rnd.randrange(1, 51)), "1995-01-01", n) for n in range(1000)]
    frame = spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_quantity double, day string, l_linenumber int")
    frame.selectExpr("* except (day)", "cast(day as date) as l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.createDataFrame([(k, k % 20) for k in range(280)], "o_orderkey long, o_custkey long")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_ratings_take_partitions_by_their_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(standins, "read", lambda s, d, name: s.read.parquet(f"{d}/{name}.parquet").hint("merge"))
    expected = sorted(map(tuple, standins.rating(spark, tables).collect()))
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    rating = standins.rating(spark, tables)
    assert rating.rdd.getNumPartitions() == 10
    assert sorted(map(tuple, rating.collect())) == expected != []
    train, test = factors.split_ratings(rating, ("uid", "mid", "ts", "ok", "ln"))
    assert train.rdd.getNumPartitions() == 10 and train.count() + test.count() == len(expected)


def test_rmse_takes_partitions_by_its_rows(spark, tables):
    rating = standins.rating(spark, tables)
    means = rating.groupBy("mid").avg("score").withColumnRenamed("avg(score)", "mean")
    pred = rating.join(means, "mid").selectExpr("uid", "mid", "mean as score")
    error = factors.rmse(rating, pred, 10)
    assert error.first()["rmse"] == pytest.approx(factors.rmse(rating, pred).first()["rmse"])
    assert error._jdf.queryExecution().executedPlan().toString().count(", 10), REPARTITION_BY_NUM") == 2
