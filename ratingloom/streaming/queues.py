"""Queues of recent ratings that begin from a dump: list state per user, with an initial state."""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ratingloom.schemas import QUEUE_LENGTH
from ratingloom.streaming.live import newest_of_batches, write_queues

# Executors get the processor by value and need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTRY = "mid int, score double, ts long"
QUEUES = "uid int, queue array<struct<mid:int,score:double,ts:long>>"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RecentQueue(StatefulProcessor):
    """The ``keep`` newest ratings of a user, newest first.

    Entries of a dump have no time: they stay behind every event, in the order of the dump.
    """

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.queue = handle.getListState("queue", ENTRY)

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        entries = [(e["mid"], e["score"], None) for e in initialState["entries"]]
        if entries:
            self.queue.put(entries[: self.keep])

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = [tuple(e) for e in self.queue.get()] if self.queue.exists() else []
        timed = [e for e in held if e[2] is not None] + [(r["mid"], r["score"], r["ts"]) for r in rows]
        newest = heapq.nlargest(self.keep, timed, key=lambda e: (e[2], e[0], e[1]))
        queue = (newest + [e for e in held if e[2] is None])[: self.keep]
        self.queue.put(queue)
        yield Row(uid=key[0], queue=[Row(mid=m, score=s, ts=t) for m, s, t in queue])

    def close(self) -> None:
        pass


def queue_entries(dump: DataFrame) -> DataFrame:
    """(uid, entries): one row per user of what ``import_queue`` yields, in the order of the dump. A
    queue is at most as long as its dump entry, so a user's entries are few."""
    entry = F.struct("pos", "mid", "score")
    entries = F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["mid"].alias("mid"), e["score"].alias("score")))
    return dump.groupBy("uid").agg(entries.alias("entries"))


def stream_seeded_queue(events: DataFrame, dump: DataFrame | None = None, keep: int = QUEUE_LENGTH) -> DataFrame:
    """(uid, queue): as ``stream_recent_state``, for users who may have a queue before the stream begins.

    ``dump`` is what ``import_queue`` yields. It is taken in once, with the first micro-batch; a restart
    goes on from the checkpoint. State lies in RocksDB (see ``rocksdb_state``), one list per user, and
    only the users of a micro-batch are read and written.
    """
    seed = None if dump is None else queue_entries(dump).groupBy("uid")
    return newest_of_batches(events, keep).groupBy("uid").transformWithState(RecentQueue(keep), QUEUES, "Update", "None", seed)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which list state needs."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def start_seeded_queues(
    events: DataFrame, target: str, checkpoint: str, dump: DataFrame | None = None, keep: int = QUEUE_LENGTH, available_now: bool = False
) -> StreamingQuery:
    """Run ``stream_seeded_queue`` and store the changed queues; ``current_queues`` reads them.

    Users of the dump who have no event yet have no row there: their queue is what the dump says.
    """
    with rocksdb_state(events.sparkSession):
        return write_queues(stream_seeded_queue(events, dump, keep), target, checkpoint, available_now)
