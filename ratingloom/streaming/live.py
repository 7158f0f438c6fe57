"""Stateful queue of recent ratings and the live re-ranking stream."""

from __future__ import annotations

import heapq
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ratingloom.operators import realtime
from ratingloom.schemas import CANDIDATES, QUEUE_LENGTH, RATING, RECENT_RATINGS, SCORING_GATE
from ratingloom.sources import versions
from ratingloom.sources.rejects import MARK, good, rejected
from ratingloom.sources.sinks import asked_buckets, bucket_of, kept_sim_buckets, newest_state, similar_of, store_batch, upsert_user_recs
from ratingloom.streaming.logs import start

# Executors get the task functions by value and need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Folders of a micro-batch's ratings; batches are small, so few.
BATCH_PARTS = 8
QUEUE_ENTRIES = "array<struct<mid:int,score:double,ts:long>>"
QUEUE_OUTPUT = f"uid int, queue {QUEUE_ENTRIES}"
QUEUE_STATE = "mid array<int>, score array<double>, ts array<long>"


def _newest(rows: Iterable[tuple], k: int) -> list[tuple]:
    """The newest ``k`` of (ts, mid, score) rows, newest first."""
    return heapq.nlargest(k, rows)


def newest_of_batches(events: DataFrame, keep: int) -> DataFrame:
    """(uid, mid, score, ts): of every Arrow batch the newest ``keep`` events of each user."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table(batch).sort_by([("uid", "ascending"), ("ts", "descending"), ("mid", "descending"), ("score", "descending")])
            uid = table.column("uid").to_numpy()
            begins = np.flatnonzero(np.concatenate(([True], uid[1:] != uid[:-1]))) if len(uid) else np.empty(0, int)
            sizes = np.diff(np.append(begins, len(uid)))
            nth = np.arange(len(uid)) - np.repeat(begins, sizes)
            yield from table.filter(pa.array(nth < keep)).to_batches()

    columns = events.select("uid", "mid", "score", "ts")
    return columns.mapInArrow(cut, columns.schema)


def stream_recent_state(events: DataFrame, keep: int = QUEUE_LENGTH) -> DataFrame:
    """(uid, queue): the ``keep`` newest ratings, newest first, of each user whose queue changed.

    Every Arrow batch is cut to the newest ``keep`` per user before the shuffle, so a busy user sends
    little to the one task that holds the queue, and the state is bounded. Queues are merged as plain
    tuples; ``events`` are good events, their rejects go through ``sink_events``.
    """

    def push(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mid, score, ts = state.get if state.exists else ((), (), ())
        queue = list(zip(ts, mid, score))
        for batch in batches:
            queue = _newest([*queue, *zip(batch["ts"].tolist(), batch["mid"].tolist(), batch["score"].tolist())], keep)
        ts, mid, score = (list(column) for column in zip(*queue))
        state.update((mid, score, ts))
        yield pd.DataFrame({"uid": [key[0]], "queue": [[{"mid": m, "score": s, "ts": t} for t, m, s in queue]]})

    return (
        newest_of_batches(events, keep)
        .groupBy("uid")
        .applyInPandasWithState(push, QUEUE_OUTPUT, QUEUE_STATE, "update", GroupStateTimeout.NoTimeout)
    )


def write_queues(queues: DataFrame, target: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Store the changed queues of every micro-batch; see ``store_batch``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, target, batch_id)

    return start(queues.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint), available_now)


def current_queues(spark: SparkSession, target: str) -> DataFrame:
    """(uid, pos, mid, score, ts) of every user's newest stored queue."""
    rows = newest_state(spark, target, QUEUE_OUTPUT).select("uid", F.posexplode("queue").alias("pos", "entry"))
    return rows.select("uid", (F.col("pos") + 1).alias("pos"), "entry.*")


class RatingStore:
    """The rating table of the live job, laid out so that a micro-batch reads only its users' share.

    A version holds one folder per hash bucket of the user id, sorted by user. Every micro-batch adds
    one folder of a few parts of these buckets and may be replayed; ``compact`` folds those into a new version,
    which a running stream uses from its next micro-batch on. Choose ``buckets`` by the table's size;
    a stored table keeps the number it was made with.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256):
        self.spark, self.path = spark, path
        self.buckets = versions.kept_buckets(spark, path) or buckets
        versions.keep_buckets(spark, path, self.buckets)

    def _laid_out(self, rating: DataFrame) -> DataFrame:
        return rating.select(*RATING.names, bucket_of("uid", self.buckets).alias("bucket"))

    def load_history(self, rating: DataFrame | None = None, through: int = -1) -> None:
        """Publish the history, or an empty one. Ranges over (bucket, user, item, time) spread a busy
        user over as many tasks as the user's rows need."""
        if rating is None:
            rating = self.spark.createDataFrame([], RATING)
        order = ["bucket", "uid", "mid", "ts"]
        rows = self._laid_out(rating).repartitionByRange(*order).sortWithinPartitions(*order)
        versions.publish(rows, self.path, ("bucket",), through)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Store the batch, unless a version holds it already (a replay after a compaction)."""
        version = versions.current_version(self.spark, self.path)
        if version is None or batch_id > version.through:
            part = (F.col("bucket") % BATCH_PARTS).alias("part")
            rows = self._laid_out(batch).select(*RATING.names, part).repartition(BATCH_PARTS, "part")
            rows.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/batch_id={batch_id}")

    def remove(self, keys: DataFrame) -> None:
        """Take the stored ratings of the given (uid, mid) pairs out; those of later batches count again.
        The keys are stored beside the rows until ``compact`` applies them; neither runs while the
        other does."""
        version = versions.current_version(self.spark, self.path)
        folders = versions.batch_folders(self.spark, self.path, version.through if version else -1)
        after = int(folders[-1].rsplit("=", 1)[1]) if folders else (version.through if version else -1)
        name = f"{version.number if version else -1}.{after}.{uuid.uuid4().hex}"
        gone = keys.select(F.col("uid").cast("int").alias("uid"), F.col("mid").cast("int").alias("mid")).distinct()
        gone.withColumn("after", F.lit(after).cast("long")).write.parquet(f"{self.path}/gone/{name}")

    def _gone(self, version: versions.Version | None) -> DataFrame | None:
        """(uid, mid, after): pairs taken out since the current version, and the last batch they hide."""
        number = version.number if version else -1
        names = [n for n in versions.names_below(self.spark, f"{self.path}/gone") if n.split(".")[0] == str(number)]
        if not names:
            return None
        rows = self.spark.read.schema("uid int, mid int, after long").parquet(*[f"{self.path}/gone/{n}" for n in names])
        return rows.groupBy("uid", "mid").agg(F.max("after").alias("_after"))

    def _stored(self, buckets: list[int] | None = None) -> tuple[DataFrame, int]:
        """The current version and the batches after it, of all users or of those in the given buckets,
        without what was taken out, and the last batch number."""
        version = versions.current_version(self.spark, self.path)
        after = version.through if version else -1
        folders = versions.batch_folders(self.spark, self.path, after)
        parts = []
        if version:
            parts.append(self._folders("bucket", buckets, [version.folder]).withColumn("_at", F.lit(after).cast("long")))
        if folders:
            chosen = buckets and sorted({b % BATCH_PARTS for b in buckets})
            parts.append(self._folders("part", chosen, folders, "batch_id").withColumnRenamed("batch_id", "_at"))
        rows, gone = reduce(DataFrame.unionByName, parts), self._gone(version)
        if gone is not None:
            rows = rows.join(gone, ["uid", "mid"], "left").where("_after is null or _at > _after")
        return rows.select(*RATING.names), int(folders[-1].rsplit("=", 1)[1]) if folders else after

    def _folders(self, column: str, numbers: list[int] | None, paths: list[str], *more: str) -> DataFrame:
        schema = T.StructType([*RATING.fields, T.StructField(column, T.IntegerType()), *[T.StructField(m, T.LongType()) for m in more]])
        rows = self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)
        return (rows if numbers is None else rows.where(F.col(column).isin(numbers))).select(*RATING.names, *more)

    def ratings_of(self, users: DataFrame, buckets: list[int] | None = None) -> DataFrame:
        """All ratings of the given users. Their at most ``buckets`` folder numbers are looked up first,
        unless given, so the scans of history and batches are pruned to them."""
        rows, _ = self._stored(asked_buckets(users, "uid", self.buckets) if buckets is None else buckets)
        return rows.join(users.select("uid").distinct(), "uid", "left_semi")

    def compact(self) -> None:
        """Publish everything stored as the next version."""
        self.load_history(*self._stored())


def stream_recommend(
    events: DataFrame,
    ratings: RatingStore,
    sim_path: str,
    target: str,
    checkpoint: str,
    k: int = CANDIDATES,
    recent: int = RECENT_RATINGS,
    gate: float = SCORING_GATE,
    available_now: bool = False,
    similar: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Re-rank for every user with a new rating and store one list per user.

    The micro-batch enters the rating table before recents and exclusions are read, so the current
    rating counts. ``sim_path`` holds the similarity table as ``store_similarity`` lays it out; a
    batch reads the folders of its event items and of its candidates. It may hold lists to the depth of
    ``list_depths`` if ``similar`` makes the rows of the whole table for given (mid, sim_mid) pairs.
    Malformed events (``_corrupt``) are stored below the rating table's ``rejected`` folder.
    """

    def rerank(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        marked = MARK in batch.columns
        fresh = good(batch) if marked else batch
        # One pass: whether anything is malformed, and the folders of the batch's users and items.
        bad = F.count_if(F.col(MARK).isNotNull()) if marked else F.lit(0)
        folders = batch.agg(
            bad.alias("bad"),
            F.collect_set(bucket_of("uid", ratings.buckets)).alias("users"),
            F.collect_set(bucket_of("mid", kept_sim_buckets(spark, sim_path))).alias("items"),
        ).first()
        if folders["bad"]:
            rejected(batch).write.mode("overwrite").text(f"{ratings.path}/rejected/batch_id={batch_id}")
        ratings.add(fresh, batch_id)
        rated = ratings.ratings_of(fresh, sorted(folders["users"])).persist()
        latest = realtime.latest_event(fresh).persist()
        cand = realtime.top_candidates(latest, similar_of(spark, sim_path, latest, sorted(folders["items"])), rated, k).persist()
        pairs = realtime.candidate_x_recent(cand, realtime.recent_ratings(rated, recent))
        sim = similar_of(spark, sim_path, cand) if similar is None else similar(realtime.looked_up_pairs(pairs))
        scored = realtime.score_candidates(realtime.sim_lookup(pairs, sim), gate)
        upsert_user_recs(realtime.recommendation_lists(fresh, scored, k), target, batch_id)
        for part in (cand, latest, rated, batch):
            part.unpersist()

    return start(events.writeStream.foreachBatch(rerank).option("checkpointLocation", checkpoint), available_now)
