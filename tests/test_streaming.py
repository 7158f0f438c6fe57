"""Streams against their batch counterparts, fed at once and in pieces."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import lists, realtime
from ratingloom.schemas import RATING
from ratingloom.session import scratch
from ratingloom.sources import rejects, sinks, streams, versions
from ratingloom.streaming import live, logs


def events(n=500, seed=11):
    rng = random.Random(seed)
    return [(2 if rng.random() < 0.35 else rng.randrange(12), rng.randrange(30), rng.randrange(1, 11) / 2, 10_000 + i) for i in range(n)]


def log_files(spark, data, pieces):
    """Log lines in ``pieces`` files that arrive one after the other."""
    path = scratch(spark, "log")
    size = -(-len(data) // pieces)
    for start in range(0, len(data), size):
        rows = spark.createDataFrame(data[start : start + size], RATING)
        lines = sinks.format_rating_log(rows).select(F.concat(F.lit("INFO - "), "value").alias("value"))
        noise = spark.createDataFrame([("INFO - started",), ("MOVIE_RATING_PREFIX:1|x|2|3",)], "value string")
        lines.unionByName(noise).coalesce(1).write.mode("append").text(path)
    return path


def rating_stream(spark, path, pieces):
    lines = streams.source_log_lines(spark, path, files_per_trigger=1 if pieces > 1 else 100)
    return logs.stream_parse(logs.stream_filter_log(lines))


def test_malformed_events_are_stored_beside_good_ones(spark):
    path, out = log_files(spark, events(30), 3), scratch(spark, "events")
    for _ in range(2):
        logs.sink_events(rating_stream(spark, path, 3), out, scratch(spark, "checkpoint"), available_now=True).awaitTermination()
    stored = logs.stored_events(spark, out)
    assert rejects.good(stored).count() == 30
    assert [r[0] for r in rejects.rejected(stored).collect()] == ["1|x|2|3"] * 3


@pytest.mark.parametrize("pieces", [1, 5])
def test_log_stream_equals_batch(spark, pieces):
    path = log_files(spark, events(), pieces)
    out = scratch(spark, "out")
    lines = streams.source_log_lines(spark, path, files_per_trigger=1)
    logs.sink_filtered_log(logs.stream_filter_log(lines), out, scratch(spark, "checkpoint"), available_now=True).awaitTermination()
    streamed = spark.read.text(out)
    batch = logs.filter_rating_log(spark.read.text(path))
    assert sorted(r[0] for r in streamed.collect()) == sorted(r[0] for r in batch.collect())
    assert rejects.good(logs.parse_rating_event(streamed)).count() == len(events())


@pytest.mark.parametrize("pieces", [1, 5])
def test_queues_equal_recent_ratings(spark, pieces):
    data = events()
    target = scratch(spark, "queues")
    queues = live.stream_recent_state(rejects.good(rating_stream(spark, log_files(spark, data, pieces), pieces)), keep=40)
    live.write_queues(queues, target, scratch(spark, "checkpoint"), available_now=True).awaitTermination()
    found = live.current_queues(spark, target).select("uid", "pos", "mid", "score")
    expected = realtime.recent_ratings(spark.createDataFrame(data, RATING), 40)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def similarity(spark, items=30, seed=12):
    rng = random.Random(seed)
    pairs = [(a, b, round(rng.random(), 4)) for a in range(items) for b in range(items) if a != b]
    return lists.similar_items(spark.createDataFrame(pairs, "mid int, sim_mid int, score double"), None, 0.0)


@pytest.mark.parametrize("pieces", [1, 5])
def test_live_lists_equal_batch(spark, pieces):
    history = [(uid, mid, 4.0, 100 + mid) for uid in range(0, 12, 3) for mid in range(20)]
    data = events(120)
    sim_path, target = scratch(spark, "sim"), scratch(spark, "recs")
    sinks.store_similarity(similarity(spark), sim_path, 64)
    store = live.RatingStore(spark, scratch(spark, "store"), buckets=4)
    store.load_history(spark.createDataFrame(history, RATING))
    stream = rating_stream(spark, log_files(spark, data, pieces), pieces)
    live.stream_recommend(stream, store, sim_path, target, scratch(spark, "checkpoint"), gate=0.3, available_now=True).awaitTermination()
    batch, everything = spark.createDataFrame(data, RATING), spark.createDataFrame(history + data, RATING)
    scored = realtime.batch_recommend(batch, everything, spark.read.parquet(sim_path), gate=0.3)
    expected = realtime.recommendation_lists(batch, scored)
    found = sinks.current_user_recs(spark, target)
    key = lambda r: (r["uid"], [(x["mid"], round(x["score"], 9)) for x in r["recs"]])
    assert sorted(map(key, found.collect())) == sorted(map(key, expected.collect()))


def test_replayed_batch_counts_once(spark):
    store = live.RatingStore(spark, scratch(spark, "store"), buckets=4)
    store.load_history()
    batch = spark.createDataFrame([(1, 2, 3.0, 4), (5, 6, 3.0, 4)], RATING)
    for _ in range(2):
        store.add(batch, 0)
    one = batch.where("uid = 1")
    assert sorted(map(tuple, store.ratings_of(one).collect())) == [(1, 2, 3.0, 4)]
    store.compact()
    store.add(batch, 0)
    store.add(one, 1)
    expected = [(1, 2, 3.0, 4), (1, 2, 3.0, 4), (5, 6, 3.0, 4)]
    assert sorted(map(tuple, store.ratings_of(batch).collect())) == expected
    store.compact()
    versions.drop_older(spark, store.path)
    assert sorted(map(tuple, store.ratings_of(batch).collect())) == expected


def test_running_stream_goes_on_after_a_compaction(spark):
    data, sim_path, target, path = events(80), scratch(spark, "sim"), scratch(spark, "recs"), scratch(spark, "log")
    sinks.store_similarity(similarity(spark), sim_path, 64)
    store = live.RatingStore(spark, scratch(spark, "store"), buckets=4)
    store.load_history()
    feed = lambda part: sinks.format_rating_log(spark.createDataFrame(part, RATING)).coalesce(1).write.mode("append").text(path)
    feed(data[:40])
    query = live.stream_recommend(rating_stream(spark, path, 2), store, sim_path, target, scratch(spark, "checkpoint"), gate=0.3)
    query.processAllAvailable()
    store.compact()
    sinks.compact_state(spark, target)
    feed(data[40:])
    query.processAllAvailable()
    query.stop()
    assert versions.current_version(spark, store.path).number == 1
    everything = spark.createDataFrame(data, RATING)
    last = spark.createDataFrame(data[40:], RATING)
    expected = realtime.recommendation_lists(last, realtime.batch_recommend(last, everything, similarity(spark), gate=0.3))
    key = lambda r: (r["uid"], [(x["mid"], round(x["score"], 9)) for x in r["recs"]])
    found = sinks.current_user_recs(spark, target).join(last.select("uid").distinct(), "uid", "left_semi")
    assert sorted(map(key, found.collect())) == sorted(map(key, expected.collect()))


def test_a_removed_rating_is_gone_until_it_is_given_again(spark):
    store = live.RatingStore(spark, scratch(spark, "store"), buckets=4)
    frame = lambda rows: spark.createDataFrame(rows, RATING)
    rated = lambda: sorted(map(tuple, store.ratings_of(frame([(1, 0, 0.0, 0), (2, 0, 0.0, 0)])).collect()))
    store.load_history(frame([(1, 2, 3.0, 4), (1, 3, 3.0, 4), (2, 2, 1.0, 1)]))
    store.add(frame([(1, 2, 2.0, 9), (1, 5, 2.0, 9)]), 0)
    store.remove(frame([(1, 2, 0.0, 0), (7, 7, 0.0, 0)]))
    left = [(1, 3, 3.0, 4), (1, 5, 2.0, 9), (2, 2, 1.0, 1)]
    assert rated() == left
    store.add(frame([(1, 2, 2.0, 9), (1, 5, 2.0, 9)]), 0)
    assert rated() == left
    store.compact()
    assert rated() == left
    store.add(frame([(1, 2, 4.0, 20)]), 1)
    assert rated() == sorted([*left, (1, 2, 4.0, 20)])
    store.remove(frame([(1, 2, 0.0, 0)]))
    store.add(frame([(1, 2, 5.0, 21)]), 2)
    assert rated() == sorted([*left, (1, 2, 5.0, 21)])


def test_scans_of_a_batch_are_pruned(spark):
    store, sim_path = live.RatingStore(spark, scratch(spark, "store"), buckets=16), scratch(spark, "sim")
    store.load_history(spark.createDataFrame(events(), RATING))
    store.add(spark.createDataFrame(events(60), RATING), 0)
    sinks.store_similarity(similarity(spark), sim_path, 16)
    one = spark.createDataFrame([(3, 4, 1.0, 5)], RATING)
    for frame, scans in ((store.ratings_of(one), 2), (sinks.similar_of(spark, sim_path, one), 1)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"PartitionFilters: \[[^\]]*(?:bucket|part)#", plan)) == scans, plan


def test_interval_trigger_starts_and_stops(spark):
    path = log_files(spark, events(20), 1)
    out = scratch(spark, "out")
    query = logs.sink_filtered_log(logs.stream_filter_log(streams.source_log_lines(spark, path)), out, scratch(spark, "checkpoint"))
    query.processAllAvailable()
    query.stop()
    assert spark.read.text(out).count() == 21
