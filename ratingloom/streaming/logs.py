"""Log lines to rating events: the same projections for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ratingloom.functions.scalars import norm_epoch, trimmed
from ratingloom.schemas import FORWARD_KEY, LOG_PREFIX, RATING, RATING_TOPIC, STREAM_INTERVAL
from ratingloom.sources.rejects import MARK, store_split


def filter_rating_log(lines: DataFrame, prefix: str = LOG_PREFIX) -> DataFrame:
    """The rating text of every line that holds the prefix: what lies between the first prefix and a
    second one or the end. Where nothing lies there the text is empty, and parsing sets it apart."""
    piece = trimmed(F.get(F.split(F.col("value"), rf"\Q{prefix}\E"), F.lit(1)))
    return lines.where(F.contains("value", F.lit(prefix))).select(piece.alias("value"))


def parse_rating_event(values: DataFrame) -> DataFrame:
    """(uid, mid, score, ts, _corrupt) from ``uid|mid|score|timestamp``; malformed events have their
    text in ``_corrupt``. Split the result with ``sources.rejects``, or ``sink_events`` in a stream."""
    parts = F.split(F.col("value"), r"\|")
    fields = [trimmed(F.get(parts, F.lit(position))) for position in range(4)]
    rows = values.select(
        fields[0].try_cast("int").alias("uid"),
        fields[1].try_cast("int").alias("mid"),
        fields[2].try_cast("double").alias("score"),
        norm_epoch(fields[3].try_cast("long")).alias("ts"),
        F.coalesce("value", F.lit("")).alias("_corrupt"),
    )
    complete = F.col("uid").isNotNull() & F.col("mid").isNotNull() & F.col("score").isNotNull() & F.col("ts").isNotNull()
    return rows.withColumn("_corrupt", F.when(~complete, F.col("_corrupt")))


def stream_filter_log(lines: DataFrame, prefix: str = LOG_PREFIX) -> DataFrame:
    return filter_rating_log(lines, prefix)


def stream_parse(values: DataFrame) -> DataFrame:
    return parse_rating_event(values)


def sink_events(parsed: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Store parsed events, good and rejected apart, one folder per micro-batch that a replay
    overwrites; every batch counts its rejects (``store_split``)."""

    def store(batch: DataFrame, batch_id: int) -> None:
        store_split(batch, f"{out}/batch_id={batch_id}")

    return start(parsed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint), available_now)


def stored_events(spark: SparkSession, out: str) -> DataFrame:
    """What ``sink_events`` stored, rejects marked in ``_corrupt``."""
    schema = T.StructType([*RATING.fields, T.StructField(MARK, T.StringType())])
    return spark.read.schema(schema).option("basePath", out).parquet(f"{out}/batch_id=*").select(*schema.names)


def start(writer, available_now: bool, interval: str = STREAM_INTERVAL) -> StreamingQuery:
    """Start a stream writer at the fixed interval, or once over what is there."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def sink_filtered_log(
    stream: DataFrame,
    out: str | None,
    checkpoint: str,
    kafka: dict[str, str] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Forward rating texts to text files, or to Kafka under one constant key."""
    if kafka is None:
        writer = stream.select("value").writeStream.format("text").option("path", out)
    else:
        keyed = stream.select(F.lit(FORWARD_KEY).alias("key"), "value")
        writer = keyed.writeStream.format("kafka").options(**{"topic": RATING_TOPIC, **kafka})
    return start(writer.option("checkpointLocation", checkpoint), available_now)
