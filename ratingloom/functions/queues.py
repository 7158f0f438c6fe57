"""Dumped per-user rating queues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.scalars import trimmed


def import_queue(dump: DataFrame) -> DataFrame:
    """(uid, pos, mid, score, _corrupt) from rows (key = ``uid:<uid>``, entries = array of ``mid:score``),
    newest first. An entry that cannot be read has its key and text in ``_corrupt``; a dump without
    entries is such a row too. Split the result with ``sources.rejects``."""
    uid = trimmed(F.get(F.split("key", ":"), F.lit(1))).try_cast("int")
    parts = F.split(F.col("entry"), ":")
    rows = dump.select("key", uid.alias("uid"), F.posexplode_outer("entries").alias("pos", "entry")).select(
        "uid",
        (F.col("pos") + 1).alias("pos"),
        trimmed(F.get(parts, F.lit(0))).try_cast("int").alias("mid"),
        trimmed(F.get(parts, F.lit(1))).try_cast("double").alias("score"),
        F.concat_ws(" ", "key", "entry").alias("_corrupt"),
    )
    complete = F.col("uid").isNotNull() & F.col("mid").isNotNull() & F.col("score").isNotNull()
    return rows.withColumn("_corrupt", F.when(~complete, F.col("_corrupt")))
