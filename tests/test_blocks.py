"""Products of blocks: whole rows from bounded work."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import lists, vectors


def frame_of(spark, seed, count, dims=5):
    rnd = np.random.default_rng(seed)
    matrix = rnd.integers(-3, 4, (count, dims)).astype(float)
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "mid int, features array<double>")


def rounded(df, *cols):
    return sorted((*[r[c] for c in cols], round(r["score"], 9)) for r in df.collect())


@pytest.mark.parametrize("block_rows", [None, 7])
def test_lists_of_asked_items_are_heads_of_whole_lists(spark, block_rows):
    frame = frame_of(spark, 1, 150)
    asked = {3: 1, 4: 10, 50: 400, 77: 64, 999: 5}
    depths = spark.createDataFrame(list(asked.items()), "mid int, depth int")
    whole = lists.similar_items(vectors.all_pairs_cosine(frame, 0.1), None, 0.1).join(depths, "mid").where("rank <= depth")
    cut = lists.similar_items(vectors.all_pairs_cosine(frame, 0.1, depths=depths, block_rows=block_rows), None, 0.1)
    assert rounded(cut, "mid", "rank", "sim_mid") == rounded(whole, "mid", "rank", "sim_mid")
    assert cut.where("mid = 4").count() == 10 and cut.where("mid = 50").count() > 20


def test_pair_cosine_is_the_table_for_the_pairs(spark):
    frame = frame_of(spark, 2, 60)
    pairs = spark.createDataFrame([(a, b) for a in range(0, 70, 3) for b in range(0, 60, 2)] * 2, "mid int, sim_mid int")
    table = vectors.all_pairs_cosine(frame, 0.2).join(pairs.distinct(), ["mid", "sim_mid"])
    assert rounded(vectors.pair_cosine(pairs, frame, 0.2), "mid", "sim_mid") == rounded(table, "mid", "sim_mid") != []


def test_blocks_become_more_with_the_rows(spark):
    """A block of a larger table is larger, but not in proportion."""
    frame = spark.range(40_000).select("id", F.array(F.lit(1.0)).alias("features"))
    assert vectors._blocks(frame, None, False)[1] == 20


def test_only_what_can_enter_a_list_is_sorted_in(monkeypatch):
    sorted_in, inner = [], vectors._first
    monkeypatch.setattr(vectors, "_first", lambda groups, *rest: sorted_in.append(len(groups)) or inner(groups, *rest))
    rnd = np.random.default_rng(4)
    kept = vectors._Lists(np.arange(500), np.full(500, 5), 0.0)
    every = []
    for start in range(0, 20_000, 1000):
        rows = rnd.normal(size=(500, 1000))
        every.append(rows)
        kept.take(0, rows, np.arange(start, start + 1000), False)
    assert sum(sorted_in[1:]) < 0.01 * 500 * 19_000
    ids, others, scores = kept.rows()
    best = np.argsort(-np.concatenate(every, axis=1), axis=1)[:, :5]
    assert (ids == np.repeat(np.arange(500), 5)).all() and (others.reshape(500, 5) == best).all()


def test_a_pair_of_blocks_is_multiplied_once(spark, monkeypatch):
    frame = frame_of(spark, 5, 40)
    made, inner = [], vectors._Dense.products
    monkeypatch.setattr(vectors._Dense, "products", lambda self, other: made.append(1) or inner(self, other))
    table = vectors.pa.table({"id": list(range(40)), "features": [r["features"] for r in frame.orderBy("mid").collect()]})
    payloads = []
    for part in (table.slice(0, 20), table.slice(20)):
        sink = vectors.pa.BufferOutputStream()
        with vectors.pa.ipc.new_stream(sink, part.schema) as writer:
            writer.write_table(part)
        payloads.append(sink.getvalue().to_pybytes())
    batch = vectors.pa.record_batch({"side": [0, 1], "block": [1, 0], "payload": payloads})
    found = [row for out in vectors._pair_kernel(0.2, True, False)(iter([batch])) for row in zip(*out.to_pydict().values())]
    assert len(made) == 1
    across = vectors.all_pairs_cosine(frame, 0.2).where("(mid < 20) <> (sim_mid < 20)")
    assert sorted((a, b, round(s, 9)) for a, b, s in found) == rounded(across, "mid", "sim_mid")
