"""Kept statistics beside the batch operators, and grid cells side by side."""

from __future__ import annotations

import random
import time

import pytest

from ratingloom.operators import factors, stats
from ratingloom.session import scratch
from ratingloom.streaming.counts import StatsStore

RATING = "uid int, mid int, score double, ts long"


def batches(spark, count=3):
    rnd = random.Random(6)
    rows = [[(rnd.randint(0, 9), rnd.randint(0, 5), rnd.randint(1, 10) / 2, rnd.randint(1_500_000_000, 1_520_000_000)) for _ in range(60)] for _ in range(count)]
    return [spark.createDataFrame(r, RATING) for r in rows]


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_kept_statistics_equal_the_batch_operators(spark):
    store, seen = StatsStore(spark, scratch(spark, "stats")), spark.createDataFrame([], RATING)
    assert rows(store.rate_more()) == []
    for number, batch in enumerate(batches(spark)):
        store.add(batch, number)
        store.add(batch, number)
        seen = seen.unionByName(batch)
        assert rows(store.rate_more()) == rows(stats.rate_more(seen))
        assert rows(store.rate_more_recently()) == rows(stats.rate_more_recently(seen))
        assert rows(store.average_score()) == [(m, pytest.approx(a)) for m, a in rows(stats.average_score(seen))]
        if number == 1:
            store.compact()
            # What the version holds is not added again by a replay.
            store.add(batch, number)
            assert rows(store.rate_more()) == rows(stats.rate_more(seen))
    assert store.rate_more_recently().collect() == stats.rate_more_recently(seen).collect()


def test_the_batch_reads_only_itself(spark):
    store = StatsStore(spark, scratch(spark, "stats"))
    store.add(batches(spark)[0], 0)
    plan = store.rate_more()._jdf.queryExecution().executedPlan().toString()
    assert "score" not in plan and plan.count("FileScan parquet") + plan.count("Scan parquet") >= 1


def test_cells_run_side_by_side_and_free_their_own_factors(spark, monkeypatch):
    train, test = batches(spark, 2)
    spans, real = [], factors.train_als

    def timed(*args):
        began = time.monotonic()
        model = real(*args)
        time.sleep(1)
        spans.append((began, time.monotonic(), spark.sparkContext.getLocalProperty("spark.jobGroup.id")))
        return model

    monkeypatch.setattr(factors, "train_als", timed)
    grid = factors.tune_als(train, test, (2, 3), (0.1, 1.0), 2).collect()
    assert [(r["rank"], r["lambda"]) for r in grid] == [(2, 0.1), (2, 1.0), (3, 0.1), (3, 1.0)] and all(r.rmse > 0 for r in grid)
    assert len({g for _, _, g in spans}) == 4
    later = sorted(spans)[1:]
    assert any(a < d and c < b for i, (a, b, _) in enumerate(later) for c, d, _ in later[i + 1 :])
    held = [r.name() for r in spark.sparkContext._jsc.getPersistentRDDs().values()]
    assert "userFactors" not in held and "itemFactors" not in held


def test_a_failed_cell_ends_the_grid(spark, monkeypatch):
    train, test = batches(spark, 2)
    real = factors.train_als

    def failing(data, rank, *rest):
        if rank == 3:
            raise RuntimeError("no memory")
        return real(data, rank, *rest)

    monkeypatch.setattr(factors, "train_als", failing)
    with pytest.raises(RuntimeError, match="no memory"):
        factors.tune_als(train, test, (2, 3), (0.1, 1.0), 2)
