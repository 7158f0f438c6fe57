"""Stored tables that change: a version folder per rewrite, a marker file that makes it current.

A version is written whole before its marker appears, and a marker is created once and never
changed, so readers see one version or the next and of two writers one fails. Rows that arrive in
between lie in batch folders, which a later version takes in (``through``).
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ratingloom.session import forget


class Version(NamedTuple):
    number: int
    folder: str
    through: int


def file_system(spark: SparkSession, path: str):
    """The file system that a path is in, and the path as it takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names_below(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none where there is no folder."""
    fs, target = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The newest version, from the names of the marker files."""
    markers = [n.removeprefix("_version.").split(".") for n in names_below(spark, path) if n.startswith("_version.")]
    if not markers:
        return None
    number, through, folder = max(markers, key=lambda m: int(m[0]))
    return Version(int(number), f"{path}/{folder}", int(through))


def publish(table: DataFrame, path: str, partition_by: tuple[str, ...] = (), through: int = -1) -> Version:
    """Write ``table`` as the next version of the table at ``path``; it may be read from there."""
    spark = table.sparkSession
    last = current_version(spark, path)
    number = last.number + 1 if last else 0
    name = f"v{number}-{uuid.uuid4().hex}"
    table.write.partitionBy(*partition_by).parquet(f"{path}/{name}")
    # One file per number, whoever writes it: a second writer of the same number fails here.
    fs, lock = file_system(spark, f"{path}/_number.{number}")
    try:
        fs.create(lock, False).close()
    except Py4JJavaError as error:
        raise RuntimeError(f"version {number} of {path} was published by another writer") from error
    fs.create(file_system(spark, f"{path}/_version.{number}.{through}.{name}")[1], False).close()
    return Version(number, f"{path}/{name}", through)


def read_current(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The newest version of a table."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no version of {path} is published")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(version.folder)


def batch_folders(spark: SparkSession, path: str, after: int) -> list[str]:
    """Batch folders ``batch_id=n`` with n above ``after``."""
    ids = [int(n.removeprefix("batch_id=")) for n in names_below(spark, path) if n.startswith("batch_id=")]
    return [f"{path}/batch_id={i}" for i in sorted(ids) if i > after]


def drop_older(spark: SparkSession, path: str) -> None:
    """Delete versions and batches that the current version has replaced. Call it when no reader of
    an older version is left."""
    current = current_version(spark, path)
    if current is None:
        return
    keep = current.folder.rsplit("/", 1)[1]
    old = [n for n in names_below(spark, path) if n.startswith("v") and n != keep]
    taken = [n for n in names_below(spark, path) if n.startswith("batch_id=") and int(n.removeprefix("batch_id=")) <= current.through]
    forget(spark, *[f"{path}/{n}" for n in old + taken])


def keep_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """Store the number of buckets that a table is laid out in, beside its rows."""
    if kept_buckets(spark, path) != buckets:
        fs, marker = file_system(spark, f"{path}/_buckets.{buckets}")
        fs.create(marker, False).close()


def kept_buckets(spark: SparkSession, path: str) -> int | None:
    """The number of buckets that a table was laid out in."""
    found = [int(n.removeprefix("_buckets.")) for n in names_below(spark, path) if n.startswith("_buckets.")]
    return found[0] if found else None


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file; Spark's readers pass over those whose name begins with an underscore."""
    fs, target = file_system(spark, path)
    out = fs.create(target, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        raise FileNotFoundError(path)
    opened = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()
