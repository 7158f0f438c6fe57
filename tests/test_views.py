"""SQL functions beside the column functions, their plans, and what is read before anything is stored."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ratingloom.functions import scalars
from ratingloom.session import scratch
from ratingloom.sources import sinks, views
from ratingloom.streaming import live

RATING = "uid int, mid int, score double, ts long"


def test_sql_functions_say_what_column_functions_say(spark):
    views.register_functions(spark, "loomtest_")
    rows = [
        (1_600_000_000, 3.2, "A rED b", "Red", [1.0, 2.0], [2.0, -1.0], 7),
        (1_600_000_000_123, 0.0, "", "", [0.0, 0.0], [1.0, 1.0], None),
        (None, None, None, "x", None, [1.0], 0),
        (-86_401, 4.75, "xyz", "Y", [3.0], [4.0], 1000),
    ]
    df = spark.createDataFrame(rows, "ts long, score double, text string, part string, a array<double>, b array<double>, n long")
    pairs = {
        "norm_epoch(ts)": scalars.norm_epoch("ts"),
        "year_month(ts)": scalars.year_month("ts"),
        "half_star_bin(score)": scalars.half_star_bin("score"),
        "contains_ci(text, part)": scalars.contains_ci("text", "part"),
        "dot(a, b)": scalars.dot("a", "b"),
        "cosine(a, b)": scalars.cosine("a", "b"),
        "log10_count(n)": scalars.log10_count("n"),
    }
    for sql, column in pairs.items():
        got = df.select(F.expr(f"loomtest_{sql}").alias("x")).collect()
        assert got == df.select(column.alias("x")).collect(), sql


def test_table_functions_are_inlined_without_python(spark, tmp_path):
    spark.createDataFrame([(1, 2, 3.0, 1_600_000_000), (2, 2, 4.0, 1_600_000_000)], RATING).write.parquet(f"{tmp_path}/rating.parquet")
    spark.createDataFrame([(2, "N", "Red|x")], "mid int, name string, genres string").write.parquet(f"{tmp_path}/movie")
    assert views.register_views(spark, str(tmp_path), "loomtest_") == ["loomtest_movie", "loomtest_rating"]
    views.register_functions(spark, "loomtest_")
    views.register_table_functions(spark, "loomtest_")
    monthly = spark.sql("select * from loomtest_rate_more_recently()")
    assert [tuple(r) for r in monthly.collect()] == [(2, 2, 202009)]
    plan = monthly._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "loomtest_" not in plan and "ReadSchema: struct<mid:int,ts:bigint>" in plan
    assert [tuple(r) for r in spark.sql("select * from loomtest_items_of_genre('rEd')").collect()] == [(2, "N", 3.5)]
    assert spark.sql("select * from loomtest_items_of_genre('blue')").count() == 0


def test_state_before_the_first_batch_is_empty(spark):
    assert live.current_queues(spark, scratch(spark, "nothing")).collect() == []
    assert sinks.current_user_recs(spark, scratch(spark, "nothing")).columns == ["uid", "recs"]
    with pytest.raises(FileNotFoundError):
        sinks.newest_state(spark, scratch(spark, "nothing"))


def test_bucket_counts_are_kept_with_the_table(spark):
    path = scratch(spark, "sim")
    ranked = spark.createDataFrame([(m, 1, m + 1, 0.5) for m in range(50)], "mid int, rank int, sim_mid int, score double")
    sinks.store_similarity(ranked, path, 8)
    asked = spark.createDataFrame([(m,) for m in range(50)], "mid int")
    assert sinks.similar_of(spark, path, asked).count() == 50
    sinks.store_similarity(ranked, path, 32)
    assert sinks.similar_of(spark, path, asked).count() == 50
    with pytest.raises(FileNotFoundError):
        sinks.similar_of(spark, scratch(spark, "nothing"), asked)
    folder = scratch(spark, "store")
    history = spark.createDataFrame([(u, u, 1.0, u) for u in range(50)], RATING)
    live.RatingStore(spark, folder, 16).load_history(history)
    again = live.RatingStore(spark, folder)
    assert again.buckets == 16 and again.ratings_of(history.select("uid")).count() == 50
