"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows of a task of a wide join or aggregation over a whole table; see ``parts_for``.
TASK_ROWS = 1_000_000


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("ratingloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    There is no fallback: whoever starts the session names a folder (see ``ensure_shared_dir``).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = spark.sparkContext.getCheckpointDir()
    if configured and not active:
        spark.sparkContext.setCheckpointDir(configured)
    if not (configured or active):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return configured or active


def ensure_shared_dir(spark: SparkSession, path: str | None = None) -> None:
    """Name a shared folder where the session has none: ``path``, or a folder beside the tables of
    the session's warehouse. A warehouse on a machine's own disk will do for a local session only."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    own = warehouse.startswith(("/", "file:"))
    local = spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")
    if path is None and own and not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share; the warehouse is a local one")
    spark.sparkContext.setCheckpointDir(path or f"{warehouse}/_ratingloom")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/ratingloom/{purpose}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """``df`` written once below the shared folder, for plans that read it more than once."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(spark: SparkSession, rows: int) -> int | None:
    """The partitions that this many rows need so that what a task sorts or groups does not grow with the
    table; None where the session's shuffle partitions are enough."""
    parts = math.ceil(rows / TASK_ROWS)
    return parts if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by the keys over ``parts`` partitions, which a join or grouping by them keeps."""
    return df if parts is None else df.repartition(parts, *keys)


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete scratch paths whose rows are no longer needed."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
