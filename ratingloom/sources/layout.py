"""Tables laid out for lookups by one key: bucketed and sorted files, and reads that use the layout.

A table is stored in ``buckets`` buckets of its key, sorted by key inside. ``lookup`` takes rows by
key: for a few keys it opens their buckets alone and skips the row groups of other keys; for many it
joins in the table's own layout, so that only the keys are shuffled. The number of buckets and the
key are kept in a file beside the rows.

A bucket is read by one task. Where one holds far more than its share (a key with very many rows),
``opened`` reads the files without their layout and adaptive execution splits the join instead.
"""

from __future__ import annotations

import hashlib
import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.sources.versions import file_system, read_text, write_text

#: Keys that are looked up as literals; more are joined.
FEW_KEYS = 1_000
#: A bucket over so many times the mean, and over so many bytes, is not read as one.
SKEW, SKEW_BYTES = 4, 64 << 20
_MARK = "_layout.json"


class Layout(NamedTuple):
    buckets: int
    key: str
    schema: T.StructType


def store(table: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Store ``table`` below ``path``, bucketed and sorted by ``key``. Choose the buckets by the table's
    size, and no fewer than a query's shuffle partitions: about one file of usual size each."""
    spark, name = table.sparkSession, _name(f"{path}#write")
    # Ranges over bucket and key write few files a bucket, and several where a key has very many rows.
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    dealt = table.repartitionByRange(bucket, F.col(key), F.rand(7))
    dealt.write.mode("errorifexists").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"drop table {name}")
    write_text(spark, f"{path}/{_MARK}", json.dumps({"buckets": buckets, "key": key, "schema": table.schema.jsonValue()}))


def layout_of(spark: SparkSession, path: str) -> Layout:
    made = json.loads(read_text(spark, f"{path}/{_MARK}"))
    return Layout(made["buckets"], made["key"], T.StructType.fromJson(made["schema"]))


def opened(spark: SparkSession, path: str) -> DataFrame:
    """The stored table with its layout, or without it where a bucket is far over its share."""
    layout = layout_of(spark, path)
    if _skewed(spark, path, layout.buckets):
        return spark.read.schema(layout.schema).parquet(path)
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout.schema.fields)
        by = f"clustered by (`{layout.key}`) sorted by (`{layout.key}`) into {layout.buckets} buckets"
        spark.sql(f"create table {name} ({columns}) using parquet {by} location '{path}'")
    return spark.table(name)


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The rows whose key occurs in ``keys``."""
    layout, table = layout_of(spark, path), opened(spark, path)
    kind = table.schema[layout.key].dataType
    asked = keys.select(F.col(layout.key).cast(kind).alias(layout.key)).where(F.col(layout.key).isNotNull()).distinct()
    some = [row[0] for row in asked.limit(FEW_KEYS + 1).collect()]
    if len(some) <= FEW_KEYS:
        return table.where(F.col(layout.key).isin(some))
    return table.join(asked, layout.key, "left_semi").select(*table.columns)


def _name(path: str) -> str:
    """A table name for a path."""
    return f"ratingloom_{hashlib.md5(path.encode()).hexdigest()}"


def _skewed(spark: SparkSession, path: str, buckets: int) -> bool:
    fs, target = file_system(spark, path)
    sizes = [0] * buckets
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if name.startswith("part-"):
            # A file of a bucket has the bucket's number before its first dot.
            sizes[int(name.split(".")[0].rsplit("_", 1)[1])] += status.getLen()
    return max(sizes) > max(SKEW_BYTES, SKEW * sum(sizes) / buckets)
