"""Ranked lists: cuts per key, long and nested forms, lookups by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.scalars import stable
from ratingloom.schemas import MIN_SIMILARITY, USER_LIST_LENGTH
from ratingloom.session import materialised

# Rows of one key's score band above which the band is cut further.
BAND_ROWS = 200_000


def top_k(rows: DataFrame, key: str | list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per key with their position.

    The rank filter lets Spark cut every input partition to ``k`` rows per key before the shuffle,
    so a key that holds most of the rows still sends only ``k`` rows per task.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def by_score(id_col: str = "mid", score_col: str = "score") -> list[Column]:
    return [stable(score_col).desc(), F.col(id_col).asc()]


def banded_rank(
    rows: DataFrame, key: str, id_col: str, score_col: str, low: float, high: float, bands: int = 64
) -> DataFrame:
    """Exact position of every row in its key's list, best score first, without cutting the list.

    The rows are written once. They are ranked inside score bands and shifted by the size of the
    better bands. Bands are equal-width, and one that holds many rows of a key, equal scores too, is
    cut at quantiles of its (score, id), so no list is sorted by one task.
    """
    share = (F.lit(high) - F.col(score_col)) / F.lit(high - low)
    band = F.least(F.lit(bands - 1), F.greatest(F.lit(0), F.floor(share * bands))).cast("int")
    ordered = materialised(rows.withColumn(score_col, stable(score_col)).withColumn("_band", band), "pairs")
    place = F.struct((-F.col(score_col)).alias("s"), F.col(id_col).alias("i"))
    full = ordered.groupBy(key, "_band").agg(F.count("*").alias("_size")).where(F.col("_size") > BAND_ROWS)
    # A sample by hash gives the cuts of the large bands; where they fall decides no result.
    drawn = ordered.join(full, [key, "_band"]).where(F.pmod(F.xxhash64(key, id_col), F.floor(F.col("_size") / 512) + 1) == 0)
    cuts = drawn.groupBy(key, "_band").agg(F.array_sort(F.collect_list(place)).alias("_sample"), F.max("_size").alias("_size"))
    step = F.greatest(F.lit(1), F.floor(F.size("_sample") * BAND_ROWS / F.col("_size"))).cast("int")
    cuts = cuts.withColumn("_cuts", F.filter("_sample", lambda s, i: i % step == 0)).select(key, "_band", "_cuts")
    parted = ordered.join(cuts, [key, "_band"], "left").withColumn(
        "_part", F.coalesce(F.size(F.filter("_cuts", lambda c: c <= place)), F.lit(0))
    )
    better = Window.partitionBy(key).orderBy("_band", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parted.groupBy(key, "_band", "_part")
        .count()
        .select(key, "_band", "_part", F.coalesce(F.sum("count").over(better), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(key, "_band", "_part").orderBy(F.col(score_col).desc(), F.col(id_col))
    return (
        parted.join(offsets, [key, "_band", "_part"])
        .withColumn("rank", (F.col("_before") + F.row_number().over(inside)).cast("int"))
        .drop("_band", "_part", "_cuts", "_before")
    )


def rank_lists(rows: DataFrame, key: str, k: int, id_col: str = "mid") -> DataFrame:
    """One row per key with its ``k`` best as ``recs array<struct<mid,score>>``, best first.

    Lists that are not cut stay in long form (see ``similar_items``): a nested list is one value
    and has to fit one task.
    """
    cut = top_k(rows, key, by_score(id_col), k)
    entry = F.struct(F.col("rank"), F.col(id_col).alias("mid"), F.col("score"))
    ordered = F.sort_array(F.collect_list(entry))
    recs = F.transform(ordered, lambda r: F.struct(r["mid"].alias("mid"), r["score"].alias("score")))
    return cut.groupBy(key).agg(recs.alias("recs"))


def list_rows(lists: DataFrame, key: str) -> DataFrame:
    """Nested lists back to rows (key, rank, mid, score)."""
    return lists.select(key, F.posexplode("recs").alias("pos", "rec")).select(
        key, (F.col("pos") + 1).alias("rank"), F.col("rec.mid").alias("mid"), F.col("rec.score").alias("score")
    )


def head_of_list(lists: DataFrame, n: int, keys: DataFrame | None = None, on: str = "uid") -> DataFrame:
    """The first ``n`` entries of each list; with ``keys`` a key without a list gets an empty one."""
    heads = lists.select(on, F.slice("recs", 1, n).alias("recs"))
    if keys is None:
        return heads
    empty = F.array().cast(lists.schema["recs"].dataType)
    return keys.select(on).distinct().join(heads, on, "left").withColumn("recs", F.coalesce("recs", empty))


def filter_positive(pred: DataFrame) -> DataFrame:
    """Scores above zero after rounding, the same rule as in the block products."""
    return pred.where(stable("score") > 0)


def filter_similar(pairs: DataFrame, min_sim: float = MIN_SIMILARITY) -> DataFrame:
    """Pairs strictly above the cut; NaN never passes. Those of ``all_pairs_cosine`` are made with the
    cut where that can be, and their scores are rounded already."""
    if "_higher_cut" in vars(pairs):
        return pairs._higher_cut(min_sim).where((F.col("score") > min_sim) & ~F.isnan("score"))
    return pairs.where((stable("score") > min_sim) & ~F.isnan("score"))


def user_top(pred: DataFrame, k: int = USER_LIST_LENGTH) -> DataFrame:
    """The ``k`` best positive predictions of every user."""
    return top_k(filter_positive(pred), "uid", by_score(), k)


def similar_items(pairs: DataFrame, k: int | None = None, min_sim: float = MIN_SIMILARITY) -> DataFrame:
    """Similar items per item with their rank, best first; without ``k`` the lists stay whole.

    Pairs that have a ``rank`` already come as whole lists or heads of them (``all_pairs_cosine``); a cut
    takes only the ends of these, so the rank stands and nothing is shuffled.
    """
    kept = filter_similar(pairs, min_sim)
    if "rank" in pairs.columns:
        return kept if k is None else kept.where(F.col("rank") <= k)
    if k is None:
        return banded_rank(kept, "mid", "sim_mid", "score", min_sim, 1.0)
    return top_k(kept, "mid", by_score("sim_mid"), k)


def find_by_key(table: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``table`` whose key occurs in ``keys``."""
    on = [on] if isinstance(on, str) else on
    return table.join(keys.select(*on).distinct(), on, "left_semi")


def find_items_in(movie: DataFrame, mids: DataFrame, keep_rank: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Item rows for a list of ids. Repeats collapse and list order is lost; with ``keep_rank`` the
    rank, score and ``by`` columns of the list come along and repeats stay."""
    if not keep_rank:
        return find_by_key(movie, mids, "mid")
    return mids.select(*by, "rank", "mid", "score").join(movie, "mid")


def exists_flag(keys: DataFrame, table: DataFrame, on: str | list[str]) -> DataFrame:
    """Distinct keys with a flag that tells whether ``table`` holds them."""
    on = [on] if isinstance(on, str) else on
    known = table.select(*on).distinct().withColumn("found", F.lit(True))
    return keys.select(*on).distinct().join(known, on, "left").withColumn("found", F.coalesce("found", F.lit(False)))
