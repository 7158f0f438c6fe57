"""What the pages show, computed for all users or items at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.scalars import first_word, stable
from ratingloom.operators.lists import find_by_key, find_items_in, top_k
from ratingloom.schemas import HYBRID_WEIGHTS


def hybrid(
    cf: DataFrame,
    cb: DataFrame,
    sr: DataFrame,
    n: int,
    weights: Sequence[float] = HYBRID_WEIGHTS,
    key: str = "uid",
    fuse: str = "append",
) -> DataFrame:
    """(key, rank, mid, score) from three ranked lists per key.

    The first ``n`` of each list are weighted by source. ``append`` lines the sources up one after
    the other without removing repeats and keeps the first ``n``; ``sum`` adds the scores of an item
    and sorts by them.
    """
    parts = [
        rows.where(F.col("rank") <= n).select(
            key, F.lit(source).alias("source"), "rank", "mid", (F.col("score") * weight).alias("score")
        )
        for source, (rows, weight) in enumerate(zip((cf, cb, sr), weights))
    ]
    lined_up = parts[0].unionByName(parts[1]).unionByName(parts[2])
    if fuse == "append":
        return top_k(lined_up.withColumnRenamed("rank", "_r"), key, [F.asc("source"), F.asc("_r")], n).select(
            key, "rank", "mid", "score"
        )
    if fuse != "sum":
        raise ValueError(f"fuse must be append or sum, not {fuse!r}")
    summed = lined_up.groupBy(key, "mid").agg(stable(F.sum("score")).alias("score"))
    return top_k(summed, key, [F.desc("score"), F.asc("mid")], n).select(key, "rank", "mid", "score")


def match_pref_genre(user: DataFrame, genre_top: DataFrame) -> DataFrame:
    """Category lists of every preferred category, matched by the first word of the preference."""
    prefs = user.select("uid", F.posexplode("prefGenres").alias("pos", "pref")).withColumn("genres", first_word("pref"))
    return prefs.join(genre_top, "genres").select("uid", "pos", "genres", "rank", "mid", F.col("avg").alias("score"))


def with_fallback(recs: DataFrame, user: DataFrame, genre_top: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """``recs`` (uid, rank, mid, score) plus, for users without a row, the list of one preferred
    category, picked by a hash of the user id and the seed."""
    listed = recs.where(F.col("rank") <= n).select("uid", "rank", "mid", "score")
    pick = F.pmod(F.xxhash64("uid", F.lit(seed)), F.size("prefGenres")).cast("int")
    chosen = F.array(F.get("prefGenres", pick)).alias("prefGenres")
    new = user.join(recs.select("uid").distinct(), "uid", "left_anti").where(F.size("prefGenres") > 0).select("uid", chosen)
    fallback = match_pref_genre(new, genre_top.where(F.col("rank") <= n)).select("uid", "rank", "mid", "score")
    return listed.unionByName(fallback)


def my_rated_items(rating: DataFrame, movie: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """The items every user rated, with the user's newest score of each."""
    by = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    newest = F.max_by("score", by).alias("score")
    return rating.groupBy("uid", "mid").agg(newest).join(movie, "mid")


def view_similar(movie_recs: DataFrame, movie: DataFrame, mids: DataFrame, n: int) -> DataFrame:
    """Item rows of the first ``n`` entries of each asked item's similarity list; ``for_mid`` is the
    asked item. ``movie_recs`` is ranked (mid, rank, sim_mid, score)."""
    heads = find_by_key(movie_recs.where(F.col("rank") <= n), mids, "mid").select(
        F.col("mid").alias("for_mid"), "rank", F.col("sim_mid").alias("mid"), "score"
    )
    return find_items_in(movie, heads, keep_rank=True, by=("for_mid",))


def view_wish(user_recs: DataFrame, user: DataFrame, genre_top: DataFrame, movie: DataFrame, n: int) -> DataFrame:
    """Item rows of each user's list, or of a preferred category where there is none."""
    known = find_by_key(user_recs, user, "uid")
    return find_items_in(movie, with_fallback(known, user, genre_top, n), keep_rank=True, by=("uid",))


def view_guess(
    cf: DataFrame, cb: DataFrame, sr: DataFrame, user: DataFrame, genre_top: DataFrame, movie: DataFrame, n: int
) -> DataFrame:
    """Item rows of each user's hybrid list, or of a preferred category. All lists are keyed by uid."""
    known = find_by_key(hybrid(cf, cb, sr, n), user, "uid")
    return find_items_in(movie, with_fallback(known, user, genre_top, n), keep_rank=True, by=("uid",))


def view_stream(stream_recs: DataFrame, users: DataFrame, n: int) -> DataFrame:
    """Head of each asked user's live list."""
    return find_by_key(stream_recs.where(F.col("rank") <= n), users, "uid")


def view_genre_top(genre_top: DataFrame, categories: DataFrame, n: int) -> DataFrame:
    """Head of each asked category's list."""
    return find_by_key(genre_top.where(F.col("rank") <= n), categories, "genres")


def view_item(movie: DataFrame, mids: DataFrame) -> DataFrame:
    return find_by_key(movie, mids, "mid")


def view_tags(tag: DataFrame, mids: DataFrame) -> DataFrame:
    return find_by_key(tag, mids, "mid")


def view_my_tags(tag: DataFrame, pairs: DataFrame) -> DataFrame:
    return find_by_key(tag, pairs, ["uid", "mid"])
