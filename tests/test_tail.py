"""The growing-file source and seeded queues: what is read, once, over restarts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import realtime
from ratingloom.sources.tail import LogTailReader, source_log_tail
from ratingloom.streaming.live import current_queues
from ratingloom.streaming.queues import start_seeded_queues

EVENT = "uid int, mid int, score double, ts long"


def append(path, data):
    with open(path, "ab") as log:
        log.write(data)


def drain(spark, folder, out, name, **options):
    lines = source_log_tail(spark, str(folder), start=f"{out}/{name}-start", **options)
    writer = lines.writeStream.format("parquet").option("path", f"{out}/{name}").option("checkpointLocation", f"{out}/{name}-checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return sorted(r.value for r in spark.read.schema("value string").parquet(f"{out}/{name}").collect())


def test_only_lines_after_the_start_and_each_once(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    append(logs / "a.log", b"old 1\nold 2\nhalf")
    assert drain(spark, logs, tmp_path, "late") == []
    append(logs / "a.log", b" done\nnew 1\n")
    append(logs / "b.log", "new 2\r\n\nübrig\nopen".encode())
    expected = ["", "half done", "new 1", "new 2", "übrig"]
    assert drain(spark, logs, tmp_path, "late") == expected
    assert drain(spark, logs, tmp_path, "late") == expected
    append(logs / "b.log", b" end\n")
    assert drain(spark, logs, tmp_path, "late", split_bytes=3) == sorted([*expected, "open end"])
    assert drain(spark, logs, tmp_path, "all", starting="earliest") == sorted([*expected, "old 1", "old 2", "open end"])


@pytest.mark.parametrize("split", [1, 2, 7, 64, 10_000])
def test_stretches_hold_every_line_once(tmp_path, split):
    rnd = random.Random(split)
    lines = ["x" * rnd.randint(0, 40) + str(i) for i in range(60)] + [""] * 3
    append(tmp_path / "a", ("\n".join(lines) + "\nunfinished").encode())
    reader = LogTailReader({"path": str(tmp_path), "startingOffsets": "earliest", "splitBytes": str(split)})
    end = reader.latestOffset()
    assert [v for p in reader.partitions({}, end) for v, _ in reader.read(p)] == lines
    middle = {"a": len("\n".join(lines[:20])) + 1}
    assert [v for p in reader.partitions(middle, end) for v, _ in reader.read(p)] == lines[20:]


def test_a_failed_first_batch_begins_where_it_began(tmp_path):
    append(tmp_path / "a", b"old\n")
    options = {"path": str(tmp_path), "start": f"{tmp_path}/kept/start.json"}
    assert LogTailReader(options).initialOffset() == {"a": 4}
    append(tmp_path / "a", b"new\n")
    assert LogTailReader(options).initialOffset() == {"a": 4}


def test_a_shrunk_file_and_a_wrong_start_are_errors(tmp_path):
    with pytest.raises(ValueError):
        LogTailReader({"path": str(tmp_path)}).partitions({"a": 9}, {"a": 3})
    with pytest.raises(ValueError):
        LogTailReader({"path": str(tmp_path), "startingOffsets": "soon"})


def test_seeded_queues_equal_the_newest_of_dump_and_events(spark, tmp_path):
    rnd = random.Random(4)
    old = [(u, rnd.randint(0, 9), float(rnd.randint(1, 5)), t) for u in range(6) for t in range(rnd.randint(0, 9))]
    new = [[(u, rnd.randint(0, 9), float(rnd.randint(1, 5)), 100 * b + t) for u in range(2, 8) for t in range(rnd.randint(0, 5))] for b in (1, 2)]
    frame = lambda rows: spark.createDataFrame(rows, EVENT)
    dump = realtime.recent_ratings(frame(old), 5).select("uid", "pos", "mid", "score")
    events = tmp_path / "events"
    for part in new:
        # The second run starts from the checkpoint of the first, and is given the dump again.
        frame(part).coalesce(1).write.mode("append").parquet(str(events))
        stream = spark.readStream.schema(EVENT).parquet(str(events))
        start_seeded_queues(stream, f"{tmp_path}/queues", f"{tmp_path}/checkpoint", dump, 5, available_now=True).awaitTermination()
    got = current_queues(spark, f"{tmp_path}/queues").select("uid", "pos", "mid", "score")
    asked = {r[0] for part in new for r in part}
    expected = realtime.recent_ratings(frame(old + new[0] + new[1]), 5).where(F.col("uid").isin(sorted(asked)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert any(r.ts is None for r in current_queues(spark, f"{tmp_path}/queues").collect())
