"""Statistics that are kept up to date: counts and sums per item and month that batches add to.

Every micro-batch stores what it adds, one row per item and month, in a folder of its own; a replay
overwrites it. Readers add the parts up. ``compact`` folds batches into a version laid out by month;
what it holds already is passed over when it is replayed. A batch reads its own rows and nothing else,
and the statistics read the parts, never the ratings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratingloom.functions.scalars import year_month
from ratingloom.sources import versions
from ratingloom.streaming.logs import start

PARTS = "mid int, yearmonth int, n long, total double"


class StatsStore:
    """Partial counts and sums below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, ratings: DataFrame, batch_id: int) -> None:
        """Store what a batch of (mid, score, ts) adds, unless a version holds that batch."""
        version = versions.current_version(self.spark, self.path)
        if version is None or batch_id > version.through:
            parts = ratings.groupBy("mid", year_month("ts").alias("yearmonth")).agg(
                F.count("*").alias("n"), F.sum("score").cast("double").alias("total")
            )
            parts.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def parts(self) -> DataFrame:
        """(mid, yearmonth, n, total), one row per item and month."""
        version = versions.current_version(self.spark, self.path)
        folders = versions.batch_folders(self.spark, self.path, version.through if version else -1)
        rows = self.spark.createDataFrame([], PARTS)
        if folders:
            rows = self.spark.read.schema(PARTS).parquet(*folders)
        if version:
            rows = rows.unionByName(self.spark.read.schema(PARTS).parquet(version.folder))
        return rows.groupBy("mid", "yearmonth").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

    def compact(self) -> None:
        """Fold all batches into the next version, one folder per month, sorted by item."""
        version = versions.current_version(self.spark, self.path)
        folders = versions.batch_folders(self.spark, self.path, version.through if version else -1)
        if folders:
            rows = self.parts().repartitionByRange("yearmonth", "mid").sortWithinPartitions("yearmonth", "mid")
            versions.publish(rows, self.path, ("yearmonth",), int(folders[-1].rsplit("=", 1)[1]))

    def rate_more(self) -> DataFrame:
        return self.parts().groupBy("mid").agg(F.sum("n").alias("count"))

    def rate_more_recently(self, ordered: bool = True) -> DataFrame:
        monthly = self.parts().select("mid", F.col("n").alias("num"), "yearmonth")
        return monthly.orderBy(F.desc("yearmonth"), F.desc("num"), "mid") if ordered else monthly

    def average_score(self) -> DataFrame:
        return self.parts().groupBy("mid").agg((F.sum("total") / F.sum("n")).alias("avg"))


def stream_statistics(events: DataFrame, store: StatsStore, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Add every micro-batch of rating events to ``store``."""
    return start(events.writeStream.foreachBatch(store.add).option("checkpointLocation", checkpoint), available_now)
