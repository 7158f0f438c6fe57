"""Products of given pairs: beside a plain join, with repeated, missing and odd vectors."""

import pytest
from pyspark.sql import functions as F

from ratingloom.functions.scalars import dot
from ratingloom.operators import als, factors

VECTORS = [(1, [1.0, 2.0]), (1, [0.5, -1.0]), (2, [3.0, None]), (3, None), (4, [2.0]), (5, []), (None, [1.0, 1.0]), (6, [float("nan"), 1.0]), (7, [4.0, 0.25])]
GIVEN = [(a, b) for a in (1, 2, 3, 4, 5, 6, 7, 9, None) for b in (1, 2, 3, 4, 5, 6, 7, 9, None)] + [(1, 7)] * 3


@pytest.mark.parametrize("kind", ["float", "double"])
def test_products_are_those_of_the_join(spark, kind):
    users = spark.createDataFrame(VECTORS, f"uid int, features array<{kind}>")
    items = users.withColumnRenamed("uid", "mid")
    pairs = spark.createDataFrame(GIVEN, "uid int, mid int")
    wanted = pairs.groupBy("uid", "mid").agg(F.count("*").alias("copies"))
    joined = wanted.join(users.withColumnRenamed("features", "a"), "uid").join(items.withColumnRenamed("features", "b"), "mid")
    expected = joined.select("uid", "mid", dot("a", "b").alias("score"), "copies")
    found = factors.score_factors(users, items, pairs)
    assert found.schema.simpleString() == expected.schema.simpleString()
    text = lambda df: sorted(str(r) for r in df.collect())
    assert text(found) == text(expected)


def test_many_blocks_give_every_pair(spark, monkeypatch):
    monkeypatch.setattr(als, "HELD_RATINGS", 100)
    users = spark.range(40).select(F.col("id").cast("int").alias("uid"), F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: i * F.col("id") + 0.5).alias("features"))
    items = users.withColumnRenamed("uid", "mid")
    pairs = users.select("uid").crossJoin(items.select("mid"))
    found = factors.score_factors(users, items, pairs)
    joined = pairs.join(users.withColumnRenamed("features", "a"), "uid").join(items.withColumnRenamed("features", "b"), "mid")
    expected = {(r.uid, r.mid): r.s for r in joined.select("uid", "mid", dot("a", "b").alias("s")).collect()}
    rows = found.collect()
    assert len(rows) == 1600 and all(abs(expected[r.uid, r.mid] - r.score) < 1e-6 for r in rows)
    assert found.rdd.getNumPartitions() >= 16


def test_the_built_in_answers_come_in_parts(spark, monkeypatch):
    rating = spark.createDataFrame([(u, m, float((u + m) % 5 + 1)) for u in range(12) for m in range(9) if (u * m) % 3], "uid int, mid int, score double")
    model = factors.train_als(rating, rank=3, iterations=1)
    pairs = rating.select("uid", "mid").unionByName(spark.createDataFrame([(99, 1), (1, 99)], "uid int, mid int"))
    expected = {(r.uid, r.mid): r.prediction for r in model.transform(pairs).collect()}
    monkeypatch.setattr(factors, "SENT_AT_ONCE", 200)
    found = factors.transformed(model, pairs).collect()
    assert len(found) == len(expected) and {(r.uid, r.mid): r.prediction for r in found} == expected
