"""Operators against brute force and against each other on random data with hot keys."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratingloom.operators import factors, lists, realtime, vectors
from ratingloom.plans import content
from ratingloom.schemas import RATING


def ratings(spark, n=600, users=15, items=40, seed=1, hot=True):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        uid = 1 if hot and rng.random() < 0.35 else rng.randrange(users)
        mid = 3 if hot and rng.random() < 0.35 else rng.randrange(items)
        data.append((uid, mid, rng.randrange(1, 11) / 2, 1000 + i))
    return spark.createDataFrame(data, RATING), data


def random_vectors(spark, n=230, width=8, seed=2):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, width))
    data[5] = 0.0
    data[7] = data[6]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "mid int, features array<double>"), data


def brute_pairs(data, cut):
    with np.errstate(invalid="ignore", divide="ignore"):
        unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    scores = unit @ unit.T
    return {
        (i, j): scores[i, j] for i in range(len(data)) for j in range(len(data)) if i != j and scores[i, j] > cut
    }


@pytest.mark.parametrize("block_rows", [17, 100, 1000])
def test_blocked_equals_brute_force(spark, block_rows):
    vecs, data = random_vectors(spark)
    found = {(r["mid"], r["sim_mid"]): r["score"] for r in vectors.all_pairs_cosine(vecs, 0.4, block_rows=block_rows).collect()}
    expected = brute_pairs(data, 0.4)
    assert found.keys() == expected.keys()
    assert all(abs(found[p] - expected[p]) < 1e-9 for p in found)
    assert all(abs(found[(j, i)] - s) < 1e-12 for (i, j), s in found.items())


def test_sparse_equals_dense(spark):
    vecs, _ = random_vectors(spark)
    entry = F.transform("features", lambda x, i: F.struct(i.cast("string").alias("term"), x.alias("weight")))
    sparse = vecs.select("mid", F.filter(entry, lambda e: e["weight"] != 0).alias("features"))
    dense = {(r[0], r[1], round(r[2], 9)) for r in vectors.all_pairs_cosine(vecs, 0.4, block_rows=50).collect()}
    assert {(r[0], r[1], round(r[2], 9)) for r in vectors.all_pairs_cosine(sparse, 0.4, sparse=True, block_rows=50).collect()} == dense


def test_cut_inside_the_blocks_loses_nothing(spark):
    vecs, _ = random_vectors(spark)
    whole = lists.similar_items(vectors.all_pairs_cosine(vecs, 0.2, block_rows=40), 4, 0.2)
    cut = lists.similar_items(vectors.all_pairs_cosine(vecs, 0.2, 4, block_rows=40), 4, 0.2)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))


def test_banded_rank_equals_row_number(spark):
    vecs, _ = random_vectors(spark)
    pairs = vectors.all_pairs_cosine(vecs, 0.1).persist()
    banded = lists.similar_items(pairs, None, 0.1).select("mid", "rank", "sim_mid")
    window = Window.partitionBy("mid").orderBy(F.desc("score"), F.asc("sim_mid"))
    plain = pairs.withColumn("rank", F.row_number().over(window)).select("mid", "rank", "sim_mid")
    assert sorted(map(tuple, banded.collect())) == sorted(map(tuple, plain.collect()))


def test_best_products_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    u, v = rng.normal(size=(60, 5)), rng.normal(size=(45, 5))
    users = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(u)], "uid int, features array<double>")
    items = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "mid int, features array<double>")
    best = lists.user_top(vectors.best_products(users, items, 6, block_rows=11), 6)
    found = {(r["uid"], r["rank"]): r["mid"] for r in best.collect()}
    expected = {}
    for i, row in enumerate(u @ v.T):
        positive = [j for j in np.argsort(-row) if row[j] > 0][:6]
        expected.update({(i, rank): int(j) for rank, j in enumerate(positive, 1)})
    assert found == expected


def test_ranks_are_dense_and_scores_fall(spark):
    df, _ = ratings(spark)
    top = lists.top_k(df.groupBy("uid", "mid").agg(F.avg("score").alias("score")), "uid", lists.by_score(), 5)
    by_user = {}
    for r in top.orderBy("uid", "rank").collect():
        by_user.setdefault(r["uid"], []).append((r["rank"], r["score"]))
    for entries in by_user.values():
        assert [rank for rank, _ in entries] == list(range(1, len(entries) + 1))
        assert all(a[1] >= b[1] for a, b in zip(entries, entries[1:]))


def test_split_is_a_disjoint_cover_and_repeats(spark):
    df, data = ratings(spark)
    train, test = factors.split_ratings(df)
    assert sorted(map(tuple, train.unionByName(test).collect())) == sorted(data)
    again, _ = factors.split_ratings(df.repartition(7))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, train.collect()))
    assert 0.7 < train.count() / len(data) < 0.9


def brute_recommend(data, sim, gate, k=20, recent=20):
    """Per user: newest event, candidates, scores; plain Python over the whole tables."""
    out = {}
    table = {}
    for mid, other, score in sim:
        table.setdefault(mid, {})[other] = score
    for uid in {row[0] for row in data}:
        mine = sorted((row for row in data if row[0] == uid), key=lambda r: (r[3], r[1], r[2]), reverse=True)
        rated = {row[1] for row in mine}
        options = sorted(((-s, m) for m, s in table.get(mine[0][1], {}).items() if m not in rated))[:k]
        for _, mid in options:
            hits = [(table.get(mid, {}).get(r[1], 0.0), r[2]) for r in mine[:recent]]
            hits = [(s, score) for s, score in hits if s > gate]
            if hits:
                up = max(1, sum(score > 3 for _, score in hits))
                down = max(1, sum(score <= 3 for _, score in hits))
                out[(uid, mid)] = sum(s * score for s, score in hits) / len(hits) + np.log10(up) - np.log10(down)
    return out


@pytest.mark.parametrize("items", [40, 400])
def test_recommendation_equals_brute_force(spark, items):
    """With 400 items the hot user has rated more than a whole list segment."""
    df, data = ratings(spark, n=900, items=items, hot=True)
    rng = random.Random(5)
    pairs = [(a, b, round(rng.random(), 4)) for a in range(items) for b in range(items) if a != b and rng.random() < 0.6]
    sim = spark.createDataFrame(pairs, "mid int, sim_mid int, score double")
    ranked = lists.similar_items(sim, None, 0.0)
    found = realtime.batch_recommend(df, df, ranked, gate=0.5)
    expected = brute_recommend(data, pairs, 0.5)
    result = {(r["uid"], r["mid"]): r["score"] for r in found.collect()}
    assert result.keys() == expected.keys()
    assert all(abs(result[p] - expected[p]) < 1e-9 for p in result)


@pytest.mark.parametrize("buckets", [None, 50])
def test_content_lists_equal_all_pairs(spark, buckets):
    """A third of the items share one word list."""
    rng = random.Random(6)
    words = ["war", "drama", "comedy", "crime", "music", "family"]
    rows = []
    for mid in range(90):
        genres = "war|drama" if mid % 3 == 0 else "|".join(rng.sample(words, rng.randrange(1, 4)))
        rows.append((mid, "n", genres))
    movie = spark.createDataFrame(rows, "mid int, name string, genres string")
    tokens = content.tokenize(content.project_content(movie))
    if buckets is None:
        entry = F.collect_list(F.struct("term", "weight")).alias("features")
        vecs, sparse = content.tfidf(content.term_counts(tokens), movie).groupBy("mid").agg(entry), True
    else:
        weighted = content.tfidf(content.term_counts(tokens, buckets))
        vecs, sparse = weighted.select("mid", content.vector_to_array("features").alias("features")), False
    pairs = vectors.all_pairs_cosine(vecs, 0.6, sparse=sparse).persist()
    expected = lists.similar_items(pairs, 7, 0.6).select("mid", "rank", "sim_mid")
    found = content.content_similarity(movie, k=7, buckets=buckets).select("mid", "rank", "sim_mid")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    profiles = content.content_profiles(movie)
    whole = content.similar_to(movie, content.profile_similarity(profiles, buckets=buckets), content.profile_members(movie, profiles))
    assert {(r["mid"], r["sim_mid"]) for r in whole.collect()} == {(r["mid"], r["sim_mid"]) for r in pairs.collect()}


def test_factors_beat_the_global_mean(spark):
    rng = np.random.default_rng(3)
    u, v = rng.uniform(0.4, 1.6, size=(40, 2)), rng.uniform(0.4, 1.6, size=(30, 2))
    data = [(i, j, float(u[i] @ v[j])) for i in range(40) for j in range(30) if rng.random() < 0.5]
    rating = spark.createDataFrame(data, "uid int, mid int, score double")
    model = factors.train_als(rating, rank=4, iterations=5)
    error = factors.rmse(rating, factors.predict_pairs(model, rating)).first()["rmse"]
    mean = np.std([s for _, _, s in data])
    assert error < 0.7 * mean
    own = factors.top_products(*factors.factor_tables(model), 5)
    builtin = factors.recommend_users(model, 5)
    close = {(r["uid"], r["rank"]): r["score"] for r in own.collect()}
    assert all(abs(close[(r["uid"], r["rank"])] - r["score"]) < 1e-5 for r in builtin.collect())
    assert len(close) == builtin.count()
    similar = factors.factor_similarity(model, k=5)
    assert similar.where("score <= 0.6 or mid = sim_mid or rank > 5").count() == 0 and similar.count() > 0


def test_tuning_has_one_row_per_cell(spark):
    df, _ = ratings(spark, n=800, hot=False)
    train, test = factors.split_ratings(df)
    grid = factors.tune_als(train, test, ranks=(2, 3), lambdas=(0.1, 1.0), iterations=2)
    assert sorted((r["rank"], r["lambda"]) for r in grid.collect()) == [(2, 0.1), (2, 1.0), (3, 0.1), (3, 1.0)]
    assert factors.best_params(grid).count() == 1
