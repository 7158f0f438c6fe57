"""Stored-table writes: overwrite, append, delete, upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.functions.scalars import norm_epoch, user_id_of
from ratingloom.schemas import LOG_PREFIX
from ratingloom.sources import versions


def overwrite_table(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").parquet(path)


def append_ratings(ratings: DataFrame, path: str) -> None:
    """Add ratings as new rows; a repeated (uid, mid) is kept as a further row."""
    ratings.withColumn("ts", norm_epoch("ts")).write.mode("append").parquet(path)


def append_tags(tags: DataFrame, path: str) -> None:
    tags.withColumn("ts", norm_epoch("ts")).write.mode("append").parquet(path)


def rating_log_line(prefix: str = LOG_PREFIX) -> Column:
    fields = F.concat_ws("|", F.col("uid"), F.col("mid"), F.col("score"), norm_epoch("ts"))
    return F.concat(F.lit(prefix), fields)


def format_rating_log(ratings: DataFrame, prefix: str = LOG_PREFIX) -> DataFrame:
    """One log line ``PREFIX:uid|mid|score|seconds`` per rating."""
    return ratings.select(rating_log_line(prefix).alias("value"))


def _without(table: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return table.join(keys.select(*on).distinct(), on, "left_anti")


def delete_rating(rating: DataFrame, keys: DataFrame) -> DataFrame:
    return _without(rating, keys, ["uid", "mid"])


def delete_items(movie: DataFrame, mids: DataFrame) -> DataFrame:
    return _without(movie, mids, ["mid"])


def delete_users(user: DataFrame, usernames: DataFrame) -> DataFrame:
    return _without(user, usernames, ["username"])


def register_users(user: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """``user`` plus one fresh account per username in ``new`` that is not taken yet."""
    fresh = new_users(_without(new, user, ["username"]), now)
    return user.select(*fresh.columns).unionByName(fresh)


def new_users(names: DataFrame, now: Column | None = None) -> DataFrame:
    """A fresh account per username."""
    stamp = F.unix_timestamp() if now is None else now
    return names.select("username").distinct().select(
        user_id_of("username").alias("uid"),
        "username",
        F.lit(True).alias("first"),
        stamp.cast("long").alias("ts"),
        F.array().cast("array<string>").alias("prefGenres"),
    )


def _replace(table: DataFrame, updates: DataFrame, on: list[str], order: Column | str | None) -> DataFrame:
    """Rows of ``table`` whose key occurs in ``updates`` give way to the newest update of that key."""
    rest = F.struct(*[c for c in table.columns if c not in on])
    newest = updates.groupBy(*on).agg(F.max_by(rest, rest if order is None else order).alias("_row"))
    chosen = newest.select(*on, "_row.*").select(*table.columns)
    return _without(table, updates, on).unionByName(chosen)


def upsert_ratings(
    rating: DataFrame, updates: DataFrame, on: tuple[str, ...] = ("uid", "mid"), order: Column | str | None = "ts"
) -> DataFrame:
    """``rating`` with one row per updated key: the update that is greatest by ``order``."""
    return _replace(rating, updates, list(on), order)


def upsert_users(
    user: DataFrame, updates: DataFrame, on: tuple[str, ...] = ("username",), order: Column | str | None = "ts"
) -> DataFrame:
    return _replace(user, updates, list(on), order)


def rewrite_table(table: DataFrame, path: str) -> None:
    """Store ``table`` as the next version of the table at ``path``, from which it may be derived."""
    versions.publish(table, path)


def current_table(spark: SparkSession, path: str) -> DataFrame:
    return versions.read_current(spark, path)


def store_batch(rows: DataFrame, target: str, batch_id: int) -> None:
    """Store one row per uid as the newest state of those users.

    Every batch owns one folder, so a replayed batch overwrites itself and the work per batch grows
    with the batch, not with the table.
    """
    rows.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")


def newest_state(spark: SparkSession, target: str, schema: str | None = None) -> DataFrame:
    """The newest stored row of every user: the compacted version and the batches after it. Before
    anything is stored there are no rows, of the given ``schema``."""
    version = versions.current_version(spark, target)
    folders = versions.batch_folders(spark, target, version.through if version else -1)
    parts = [spark.read.parquet(*folders).withColumn("_batch", _batch_of())] if folders else []
    if version:
        parts.append(spark.read.parquet(version.folder).withColumn("_batch", F.lit(-1).cast("long")))
    if not parts:
        if schema is None:
            raise FileNotFoundError(f"nothing is stored in {target}")
        return spark.createDataFrame([], schema)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    state = F.struct(*[c for c in rows.columns if c not in ("uid", "_batch")])
    newest = F.max_by(state, "_batch").alias("_state")
    return rows.groupBy("uid").agg(newest).select("uid", "_state.*")


def _batch_of() -> Column:
    return F.regexp_extract(F.input_file_name(), r"batch_id=(\d+)", 1).cast("long")


def compact_state(spark: SparkSession, target: str) -> None:
    """Fold all batches into a new version of ``target``. Readers and a running stream go on with it:
    later batches are read beside it, replayed ones that it holds are passed over."""
    version = versions.current_version(spark, target)
    folders = versions.batch_folders(spark, target, version.through if version else -1)
    if folders:
        versions.publish(newest_state(spark, target), target, through=int(folders[-1].rsplit("=", 1)[1]))


def upsert_user_recs(lists: DataFrame, target: str, batch_id: int) -> None:
    """Replace the lists of the users in ``lists`` (uid, recs), empty lists too."""
    store_batch(lists.select("uid", "recs"), target, batch_id)


def current_user_recs(spark: SparkSession, target: str) -> DataFrame:
    """(uid, recs): the newest stored list of every user."""
    return newest_state(spark, target, "uid int, recs array<struct<mid:int,score:double>>")


def bucket_of(key: str, buckets: int) -> Column:
    """The folder number of a key in tables stored by key."""
    return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(buckets)).cast("int")


def asked_buckets(keys: DataFrame, key: str, buckets: int) -> list[int]:
    """The folder numbers of the given keys: at most ``buckets`` numbers, whatever the keys."""
    return [row["b"] for row in keys.select(bucket_of(key, buckets).alias("b")).distinct().collect()]


def store_similarity(ranked: DataFrame, path: str, buckets: int = 64) -> None:
    """Store a ranked (mid, rank, sim_mid, score) table by hash bucket of the item, sorted by item and
    rank inside, so that readers of some items open their folders and skip the row groups of others.
    Choose the buckets by the table's size: about one file of usual size each."""
    kept = ranked.select("mid", "rank", "sim_mid", "score", bucket_of("mid", buckets).alias("bucket"))
    # A salt by segment of the list spreads an item that is similar to very many.
    spread = kept.repartition("bucket", F.floor(F.col("rank") / 100_000)).sortWithinPartitions("bucket", "mid", "rank")
    spread.write.mode("overwrite").partitionBy("bucket").parquet(path)
    versions.keep_buckets(spread.sparkSession, path, buckets)


def kept_sim_buckets(spark: SparkSession, path: str) -> int:
    """The buckets that a stored similarity table was laid out in."""
    buckets = versions.kept_buckets(spark, path)
    if buckets is None:
        raise FileNotFoundError(f"no similarity table is stored in {path}")
    return buckets


def similar_of(spark: SparkSession, path: str, mids: DataFrame, folders: list[int] | None = None) -> DataFrame:
    """The stored lists of the given items and of no others' folders; ``folders`` are those of the items
    where the caller knows them."""
    asked = asked_buckets(mids, "mid", kept_sim_buckets(spark, path)) if folders is None else folders
    stored = spark.read.schema("mid int, rank int, sim_mid int, score double, bucket int").parquet(path)
    return stored.where(F.col("bucket").isin(asked)).drop("bucket")
