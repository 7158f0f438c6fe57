"""Popularity, recency, quality and per-category statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.scalars import half_star_bin, split_prefs, split_values, year_month
from ratingloom.operators.lists import top_k
from ratingloom.schemas import CATEGORIES, CATEGORY_LIST_LENGTH


def rate_more(rating: DataFrame) -> DataFrame:
    """Ratings per item over all time."""
    return rating.groupBy("mid").agg(F.count("*").alias("count"))


def rate_more_recently(rating: DataFrame, ordered: bool = True, offset_seconds: int = 0) -> DataFrame:
    """Ratings per month and item, newest month first, then most rated."""
    monthly = (
        rating.groupBy(year_month("ts", offset_seconds).alias("yearmonth"), "mid")
        .agg(F.count("*").alias("num"))
        .select("mid", "num", "yearmonth")
    )
    return monthly.orderBy(F.desc("yearmonth"), F.desc("num"), "mid") if ordered else monthly


def average_score(rating: DataFrame) -> DataFrame:
    return rating.groupBy("mid").agg(F.avg("score").alias("avg"))


def tags_per_item(tag: DataFrame) -> DataFrame:
    """The distinct tags of an item as one sorted ``|``-joined string."""
    distinct = tag.select("mid", "tag").where(F.col("tag").isNotNull()).distinct()
    return distinct.groupBy("mid").agg(F.array_join(F.array_sort(F.collect_list("tag")), "|").alias("tags"))


def distinct_ids(rating: DataFrame, col: str) -> DataFrame:
    return rating.select(col).distinct()


def items_with_tags(movie: DataFrame, tag: DataFrame) -> DataFrame:
    """Every item with its joined tags; null where it has none."""
    return movie.join(tags_per_item(tag), "mid", "left")


def items_with_avg(movie: DataFrame, avg: DataFrame) -> DataFrame:
    """Rated items with their mean score."""
    return movie.join(avg, "mid")


def genre_match(movie: DataFrame, genres: Sequence[str] = CATEGORIES) -> DataFrame:
    """One row per item and category whose name occurs anywhere in the item's genres, ignoring case.

    The categories are a short literal list, so the match is a projection and needs no join.
    """
    text = F.col("_text")
    hits = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(g.lower())), F.lit(g)) for g in genres]))
    return movie.withColumn("_text", F.lower("genres")).withColumn("category", F.explode(hits)).drop("_text")


def genre_top(
    movie: DataFrame,
    rating: DataFrame,
    genres: Sequence[str] = CATEGORIES,
    k: int = CATEGORY_LIST_LENGTH,
) -> DataFrame:
    """The ``k`` best-rated items of every category."""
    scored = items_with_avg(movie.select("mid", "genres"), average_score(rating))
    matched = genre_match(scored, genres).select(F.col("category").alias("genres"), "mid", "avg")
    return top_k(matched, "genres", [F.desc("avg"), F.asc("mid")], k).select("genres", "rank", "mid", "avg")


def rating_histogram(rating: DataFrame) -> DataFrame:
    """Ratings per user in each of the ten half-star bins, zeros included."""
    bins = [step / 2 for step in range(1, 11)]
    counts = rating.withColumn("bin", half_star_bin("score")).groupBy("uid").agg(
        *[F.count_if(F.col("bin") == b).alias(f"n{i}") for i, b in enumerate(bins)]
    )
    slots = F.array(*[F.struct(F.lit(b).alias("bin"), F.col(f"n{i}").alias("n")) for i, b in enumerate(bins)])
    return counts.select("uid", F.inline(slots))


def explode_genres(movie: DataFrame, col: str = "genres") -> DataFrame:
    """One row per item and token of a ``|``-joined column."""
    return movie.select("mid", F.explode(split_values(col)).alias("genre"))


def append_prefs(user: DataFrame, updates: DataFrame) -> DataFrame:
    """Add comma-separated categories to the users' lists and clear their ``first`` flag.

    ``updates`` has (username, genres) rows; several of one user are added in the order of their
    text. Repeats inside a list are kept, and a user without a list gets one.
    """
    known = updates.where("genres is not null").groupBy("username").agg(F.array_sort(F.collect_list("genres")).alias("_all"))
    added = known.select("username", F.flatten(F.transform("_all", split_prefs)).alias("_added"))
    changed = F.col("_added").isNotNull()
    listed = F.coalesce("prefGenres", F.array().cast("array<string>"))
    prefs = F.when(changed, F.concat(listed, "_added")).otherwise(F.col("prefGenres"))
    return (
        user.join(added, "username", "left")
        .withColumns({"prefGenres": prefs, "first": F.when(changed, F.lit(False)).otherwise(F.col("first"))})
        .drop("_added")
    )


def hot_items(monthly: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` monthly rows, newest month first."""
    return _listed(monthly.orderBy(F.desc("yearmonth"), F.desc("num"), "mid").limit(k))


def most_rated_items(monthly: DataFrame, k: int = 10, all_time: bool = False) -> DataFrame:
    """The ``k`` monthly rows with most ratings; ``all_time`` takes ``rate_more`` output instead."""
    if all_time:
        return _listed(monthly.orderBy(F.desc("count"), "mid").limit(k))
    return _listed(monthly.orderBy(F.desc("num"), F.desc("yearmonth"), "mid").limit(k))


def _listed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("score", F.lit(0.0))


def newest_items(movie: DataFrame, k: int = 10, by: str = "text") -> DataFrame:
    """The ``k`` items with the greatest issue, compared as text or, with ``by='date'``, as dates."""
    newest = F.desc("issue") if by == "text" else F.desc_nulls_last(F.try_to_date(F.col("issue"), "MMMM d, yyyy"))
    return movie.orderBy(newest, "mid").limit(k)
