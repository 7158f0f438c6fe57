"""Operators that pass over what bounds rule out: the same answers, from less work."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ratingloom.operators import blockmax, search, sparse, vectors
from ratingloom.session import materialised


def corpus(spark, seed, count):
    rnd = random.Random(seed)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(3000)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 6))), " ".join(rnd.choices(words, k=rnd.randint(0, 40)))) for i in range(count)]
    queries = [(q, " ".join(rnd.choices(words, k=rnd.randint(1, 5)))) for q in range(25)] + [(90, "absent"), (91, ""), (92, "w1 w1 w2")]
    return spark.createDataFrame(rows, "mid int, name string, descri string"), spark.createDataFrame(queries, "qid int, text string")


@pytest.mark.parametrize("seed, count, block_items, n", [(1, 400, 8, 3), (2, 60, 64, 10), (3, 0, 8, 3)])
def test_search_by_blocks_equals_search(spark, seed, count, block_items, n):
    items, queries = corpus(spark, seed, count)
    index = blockmax.index_blocks(items, block_items=block_items)
    got = blockmax.search_blocks(index, queries, n).collect()
    assert sorted(got) == sorted(search.search(items, queries, n=n).collect())
    assert bool(got) == bool(count)


def test_search_by_blocks_scores_fewer_postings(spark):
    items, queries = corpus(spark, 5, 1500)
    index = blockmax.index_blocks(items, block_items=8)
    terms = materialised(search.query_terms(queries), "terms")
    bounds = materialised(blockmax.block_bounds(index, terms), "bounds")
    first = blockmax.top_k(bounds, "qid", [blockmax.F.desc("bound"), blockmax.F.asc("block")], 2).select("qid", "block")
    hits = blockmax._scored(index, blockmax.asked_postings(index, terms, first))
    more = blockmax.open_blocks(bounds, first, hits, 3)
    scored = sum(blockmax.asked_postings(index, terms, b).count() for b in (first, more))
    every = index.postings.join(terms, "term").count()
    assert scored < 0.6 * every, (scored, every)


def factors_of(spark, seed, users, items, dims=6):
    rnd = np.random.default_rng(seed)
    # Lengths differ much, as those of popular and rare items do; some vectors are equal, some zero.
    long = rnd.normal(size=(items, dims)) * rnd.pareto(1.2, (items, 1))
    long[1::17] = long[0]
    long[5::40] = 0
    short = rnd.normal(size=(users, dims))
    short[3] = 0
    frame = lambda m, key: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{key} int, features array<double>")
    return short, long, frame(short, "uid"), frame(long, "mid")


@pytest.mark.parametrize("k, block_rows", [(1, 10), (5, 16), (400, 50)])
def test_best_products_by_norm(spark, k, block_rows):
    short, long, users, items = factors_of(spark, k, 60, 300)
    expected = []
    for u, row in enumerate(np.round(short @ long.T, 12)):
        best = sorted((-score, m) for m, score in enumerate(row.tolist()) if score > 0)[:k]
        expected += [(u, m, pytest.approx(-score)) for score, m in best]
    got = sorted(map(tuple, vectors.best_products(users, items, k, block_rows).collect()), key=lambda r: (r[0], -round(r[2], 12), r[1]))
    assert got == expected


def test_short_vectors_are_passed_over(spark):
    _, _, users, items = factors_of(spark, 2, 200, 2000)
    rows = vectors.blocks_met(users, items, 3, 50).collect()
    assert all(r.blocks == 40 for r in rows) and sum(r.met for r in rows) < 0.5 * sum(r.blocks for r in rows)


def sparse_vectors(spark, seed, count):
    rnd = random.Random(seed)
    rows = []
    for i in range(count):
        terms = {f"t{int(rnd.paretovariate(0.6))}": rnd.choice([-0.5, 0.5, 1.0, 2.0, 3.5]) for _ in range(rnd.randint(0, 12))}
        if i % 3 == 0:
            terms["everywhere"] = 1.0
        if i % 7 == 0 and rows:
            terms = dict(rows[rnd.randrange(len(rows))][1]) | {"own": 0.3}
        rows.append((i, sorted(terms.items())))
    rows += [(900, [("zero", 0.0)]), (901, [("everywhere", 2.0)]), (902, [("everywhere", 5.0)])]
    return spark.createDataFrame(rows, "mid int, features array<struct<term:string,weight:double>>")


@pytest.mark.parametrize("seed, cut", [(1, 0.3), (2, 0.6), (3, 0.9)])
def test_sparse_cosine_equals_products_of_blocks(spark, seed, cut):
    frame = sparse_vectors(spark, seed, 300)
    plain = {(r[0], r[1], round(r[2], 9)) for r in vectors.all_pairs_cosine(frame, cut, sparse=True).collect()}
    assert {(r[0], r[1], round(r[2], 9)) for r in sparse.sparse_cosine(frame, cut).collect()} == plain and plain


def test_few_pairs_meet_and_a_frequent_term_stays_out(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(600):
        terms = {f"t{t}": rnd.choice([0.5, 1.0, 2.0]) for t in rnd.sample(range(400), 8)}
        if i % 5 == 0 and rows:
            terms = dict(rnd.choice(rows)[1]) | {f"own{i}": 0.5}
        rows.append((i, sorted((terms | ({"everywhere": 0.5} if i % 3 == 0 else {})).items())))
    frame = spark.createDataFrame(rows, "mid int, features array<struct<term:string,weight:double>>")
    prefix = materialised(sparse.prefixes(sparse.ordered_vectors(frame), 0.6), "prefix")
    assert prefix.where("term = 'everywhere'").count() == 0
    met = sparse.candidates(prefix, 0.6).count()
    similar = sparse.sparse_cosine(frame, 0.6).count() // 2
    assert 50 < similar <= met < 0.05 * 600 * 600 / 2, (similar, met)


def test_no_cut_no_prefix(spark):
    with pytest.raises(ValueError):
        sparse.sparse_cosine(sparse_vectors(spark, 1, 3), 0.0)
