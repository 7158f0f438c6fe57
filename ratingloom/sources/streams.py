"""Streaming sources: a folder of text files, or a Kafka topic where the connector is present."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.schemas import LOG_TOPIC, RATING_TOPIC


def _text_stream(spark: SparkSession, path: str | None, kafka: dict[str, str] | None, files_per_trigger: int) -> DataFrame:
    if kafka is not None:
        stream = spark.readStream.format("kafka").option("startingOffsets", "latest").options(**kafka).load()
        return stream.select(F.col("value").cast("string").alias("value"))
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def source_log_lines(
    spark: SparkSession, path: str | None = None, kafka: dict[str, str] | None = None, files_per_trigger: int = 100
) -> DataFrame:
    """Log lines, one ``value`` each. ``kafka`` takes at least ``kafka.bootstrap.servers``."""
    options = None if kafka is None else {"subscribe": LOG_TOPIC, **kafka}
    return _text_stream(spark, path, options, files_per_trigger)


def source_rating_events(
    spark: SparkSession, path: str | None = None, kafka: dict[str, str] | None = None, files_per_trigger: int = 100
) -> DataFrame:
    """Rating events ``uid|mid|score|timestamp``; only events after the start are read from Kafka."""
    options = None if kafka is None else {"subscribe": RATING_TOPIC, **kafka}
    return _text_stream(spark, path, options, files_per_trigger)
