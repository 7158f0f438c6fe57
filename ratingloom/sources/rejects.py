"""Rows that could not be read: kept, counted and stored beside the good ones in one pass.

Parsers mark such rows with their raw text in ``_corrupt`` and never drop them.
"""

from __future__ import annotations

import logging
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

MARK = "_corrupt"


class Split(NamedTuple):
    """Stored good rows and raw rejected texts (``value``), with their numbers."""

    rows: DataFrame
    rejected: DataFrame
    n_rows: int
    n_rejected: int


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(MARK).isNull()).drop(MARK)


def rejected(parsed: DataFrame) -> DataFrame:
    """(value): the raw text of what could not be read."""
    return parsed.where(F.col(MARK).isNotNull()).select(F.col(MARK).alias("value"))


def or_fail(parsed: DataFrame) -> DataFrame:
    """The good rows; reading a malformed one fails the job."""
    checked = F.when(F.col(MARK).isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("malformed: "), F.col(MARK))))
    return parsed.where(checked).drop(MARK)


def store_split(parsed: DataFrame, path: str) -> Split:
    """Write good rows and rejected texts below ``path`` and count both, in one pass over the input."""
    counts = Observation()
    bad = F.col(MARK).isNotNull()
    counted = parsed.observe(counts, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"))
    counted.withColumn("rejected", bad.cast("int")).write.mode("overwrite").partitionBy("rejected").parquet(path)
    numbers = counts.get
    if numbers["rejected"]:
        log.warning("%s of %s rows are malformed; see %s/rejected=1", numbers["rejected"], sum(numbers.values()), path)
    stored = read_split(parsed, path)
    return Split(good(stored), rejected(stored), numbers["rows"], numbers["rejected"])


def read_split(parsed: DataFrame, path: str) -> DataFrame:
    """What ``store_split`` wrote of a frame like ``parsed``, marks included."""
    schema = T.StructType([*parsed.schema.fields, T.StructField("rejected", T.IntegerType())])
    return parsed.sparkSession.read.schema(schema).parquet(path).drop("rejected")
