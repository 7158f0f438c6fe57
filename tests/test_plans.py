"""What the physical plans have to look like."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as contract
from ratingloom.operators import search, vectors

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

# Streams and text folders have no plan of their own to look at; what they run is covered by name.
LAZY = sorted(
    name
    for name in contract.queries()
    if name not in {"tune_als", "pipeline"}
    and not name.startswith(("stream_", "scan_", "source_", "sink_", "append_", "upsert_user_recs", "rejected_", "op"))
)


def plan(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_product_of_whole_tables(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name", ["genre_top", "user_top", "recent_ratings", "top_candidates", "similar_items_top", "content_similarity", "search"]
)
def test_lists_are_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(spark, name))


@pytest.mark.parametrize("name", ["hot_items", "most_rated_items", "newest_items"])
def test_global_lists_are_cut_in_every_task(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(spark, "rate_more")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


@pytest.mark.parametrize("name", ["genre_top", "rmse", "rating_histogram", "recent_ratings", "batch_recommend", "search", "fuzzy_genre"])
def test_no_python_in_built_in_operators(spark, name):
    text = plan(spark, name)
    assert not re.findall(r"FlatMapGroupsIn\w+|BatchEvalPython|ArrowEvalPython|MapIn\w+", text)


SIMILARITY = ["similar_items", "candidate_x_recent", "sim_lookup", "score_candidates", "batch_recommend", "with_fallback", "view_stream", "hybrid"]


@pytest.mark.parametrize("name", SIMILARITY)
def test_vectors_are_multiplied_once(spark, name, monkeypatch):
    made = []
    for product in ("_all_pairs", "_best"):
        inner = getattr(vectors, product)
        monkeypatch.setattr(vectors, product, lambda *a, inner=inner: made.append(inner(*a)) or made[-1])
    text = plan(spark, name)
    # The content lists of the hybrid are a second product, of other vectors, and read once.
    assert len(made) == (2 if name == "hybrid" else 1)
    assert len(re.findall(r"MapInArrow task|multiply\(|FlatMapGroupsInArrow multiply", text)) <= len(made) - 1


def test_best_products_are_rows_times_k(spark):
    factors_ = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(300)], "uid int, features array<double>")
    best = vectors.best_products(factors_, factors_.withColumnRenamed("uid", "mid"), 5, block_rows=40)
    assert best.count() == 300 * 5


def test_search_scans_the_corpus_once(spark, tmp_path):
    movie = spark.createDataFrame([(i, "red ring", "old red ring") for i in range(20)], "mid int, name string, descri string")
    movie.write.parquet(f"{tmp_path}/corpus")
    corpus = spark.read.parquet(f"{tmp_path}/corpus")
    queries = spark.createDataFrame([(1, "red")], "qid int, text string")
    text = search.search(corpus, queries)._jdf.queryExecution().executedPlan().toString()
    assert f"{tmp_path}/corpus" not in text
    postings, sizes = search._postings_and_sizes(corpus, ("name", "descri"), search.query_terms(queries).select("term"))
    assert {(r.field, r.docs, r.avg_len) for r in sizes.collect()} == {("name", 20, 2.0), ("descri", 20, 3.0)}
    assert {r.term for r in postings.collect()} == {"red"}
