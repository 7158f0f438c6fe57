"""Delimited text and stored tables in, typed DataFrames out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom import schemas
from ratingloom.functions.scalars import norm_epoch, trimmed
from ratingloom.session import scratch
from ratingloom.sources.rejects import MARK, or_fail, rejected, store_split


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str, exact: bool) -> DataFrame:
    """Split each line by ``sep`` into the fields of ``schema`` plus ``_corrupt``.

    ``_corrupt`` holds the raw line when the field count or a number is wrong, else null. With
    ``exact`` surplus fields count as wrong too; without it they are ignored.
    """
    width = len(schema.fields)
    parts = F.split(F.col("value"), rf"\Q{sep}\E")
    count = F.size(parts)
    columns: list[Column] = []
    bad = count != width if exact else count < width
    for position, field in enumerate(schema.fields):
        raw = trimmed(F.get(parts, F.lit(position)))
        if isinstance(field.dataType, T.StringType):
            columns.append(raw.alias(field.name))
            continue
        typed = raw.try_cast(field.dataType)
        bad = bad | typed.isNull()
        columns.append(typed.alias(field.name))
    return lines.select(*columns, F.when(bad, F.col("value")).alias("_corrupt"))


def _scan(
    spark: SparkSession, path: str, schema: T.StructType, sep: str, exact: bool, on_error: str, rejects: str | None
) -> DataFrame:
    parsed = parse_lines(spark.read.text(path), schema, sep, exact)
    if on_error == "fail":
        return or_fail(parsed)
    if on_error == "keep":
        return parsed
    if on_error == "quarantine":
        return store_split(parsed, rejects or scratch(spark, "scan")).rows
    raise ValueError(f"on_error must be quarantine, keep or fail, not {on_error!r}")


def scan_items(spark: SparkSession, path: str, sep: str = "^", on_error: str = "quarantine", rejects: str | None = None) -> DataFrame:
    """Ten-field item lines; a blank last field is kept.

    All scans treat lines they cannot read, blank ones too, alike: ``quarantine`` stores and counts
    them below ``rejects`` (see ``rejected_lines``) and returns the stored good rows, ``keep`` marks
    them in ``_corrupt``, ``fail`` stops the job.
    """
    return _scan(spark, path, schemas.MOVIE, sep, False, on_error, rejects)


def scan_ratings(
    spark: SparkSession, path: str, sep: str = ",", score_scale: float = 1.0, on_error: str = "quarantine", rejects: str | None = None
) -> DataFrame:
    """``uid,mid,score,timestamp`` lines; ``score_scale=0.5`` brings a 1..10 scale to half stars."""
    rows = _scan(spark, path, schemas.RATING, sep, False, on_error, rejects)
    return rows.withColumns({"score": F.col("score") * F.lit(score_scale), "ts": norm_epoch("ts")})


def scan_tags(spark: SparkSession, path: str, sep: str = ",", on_error: str = "quarantine", rejects: str | None = None) -> DataFrame:
    rows = _scan(spark, path, schemas.TAG, sep, True, on_error, rejects)
    return rows.withColumn("ts", norm_epoch("ts"))


def rejected_lines(spark: SparkSession, rejects: str) -> DataFrame:
    """(value): the lines that a scan set apart below ``rejects``."""
    stored = spark.read.schema(f"{MARK} string, rejected int").parquet(rejects)
    return rejected(stored.where("rejected = 1"))


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored parquet table narrowed to the columns and types of ``schema``."""
    table = spark.read.parquet(path)
    if schema is None:
        return table
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
