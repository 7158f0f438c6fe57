"""Candidates and scores need only the similarities that are asked for."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ratingloom.operators import lists, realtime, vectors
from tests.test_blocks import frame_of, rounded


def test_recommendations_need_no_whole_table(spark):
    frame, rnd = frame_of(spark, 3, 300), np.random.default_rng(3)
    rated = [(u, int(m), float(s), t) for u in range(8) for t, (m, s) in enumerate(zip(rnd.integers(0, 300, 5 + 30 * u), rnd.integers(1, 6, 5 + 30 * u)))]
    events = spark.createDataFrame(rated, "uid int, mid int, score double, ts long")
    whole = lists.similar_items(vectors.all_pairs_cosine(frame, 0.1), None, 0.1)
    depths = realtime.list_depths(realtime.latest_event(events), events)
    heads = lists.similar_items(vectors.all_pairs_cosine(frame, 0.1, depths=depths), None, 0.1)
    found = realtime.batch_recommend(events, events, heads, gate=0.3, similar=lambda pairs: vectors.pair_cosine(pairs, frame, 0.1))
    assert rounded(found, "uid", "mid") == rounded(realtime.batch_recommend(events, events, whole, gate=0.3), "uid", "mid") != []
    assert heads.count() <= depths.agg(F.sum("depth")).first()[0] < whole.count()
