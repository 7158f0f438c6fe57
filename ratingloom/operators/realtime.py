"""Re-ranking from recent ratings, set at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.scalars import log10_count
from ratingloom.operators.lists import by_score, top_k
from ratingloom.schemas import CANDIDATES, LIKED_ABOVE, RECENT_RATINGS, SCORING_GATE

# Entries of a similarity list that one join key covers; see top_candidates.
LIST_SEGMENT = 64


def newest_first(order: Sequence[str]) -> list[Column]:
    return [F.desc(c) for c in order]


def recent_ratings(rating: DataFrame, k: int = RECENT_RATINGS, order: Sequence[str] = ("ts", "mid", "score")) -> DataFrame:
    """(uid, pos, mid, score): the newest ``k`` ratings of every user, repeats of an item kept.

    ``order`` names the columns that decide what is newest; together with uid they should be unique.
    """
    return top_k(rating, "uid", newest_first(order), k, rank="pos").select("uid", "pos", "mid", "score")


def latest_event(events: DataFrame, order: Sequence[str] = ("ts", "mid", "score")) -> DataFrame:
    """The newest event of every user."""
    newest = F.max_by(F.struct(*[F.col(c) for c in events.columns if c != "uid"]), F.struct(*order))
    return events.groupBy("uid").agg(newest.alias("_e")).select("uid", "_e.*")


def exclude_rated(cand: DataFrame, rating: DataFrame) -> DataFrame:
    """Candidates the user has not rated yet."""
    return cand.join(rating.select("uid", "mid").distinct(), ["uid", "mid"], "left_anti")


def _reach(events: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """(uid, mid, _last): the last segment of the event item's list that can hold one of the ``k`` candidates."""
    depth = seen.groupBy("uid").agg(F.count("*").alias("_seen"))
    last = F.floor((F.coalesce("_seen", F.lit(0)) + (k - 1)) / LIST_SEGMENT).cast("int").alias("_last")
    return events.select("uid", "mid").join(depth, "uid", "left").select("uid", "mid", last)


def list_depths(events: DataFrame, rating: DataFrame, k: int = CANDIDATES) -> DataFrame:
    """(mid, depth): how many entries of each event item's list ``top_candidates`` reads at most.

    Similarity lists of these items to this depth give the candidates of whole lists.
    """
    reached = _reach(events, rating.select("uid", "mid").distinct(), k)
    return reached.groupBy("mid").agg(((F.max("_last") + 1) * LIST_SEGMENT).alias("depth"))


def top_candidates(events: DataFrame, sim: DataFrame, rating: DataFrame, k: int = CANDIDATES) -> DataFrame:
    """(uid, rank, mid, score): for each user's event item the ``k`` most similar unrated items.

    ``events`` has one (uid, mid) per user and ``sim`` is ranked (mid, rank, sim_mid, score). A user
    who rated r items finds all ``k`` candidates among the first k + r list entries, so only the list
    segments that cover them are joined: exact, whatever the length of a list.
    """
    seen = rating.select("uid", "mid").distinct()
    asked = _reach(events, seen, k).select("uid", "mid", F.explode(F.sequence(F.lit(0), F.col("_last"))).alias("_segment"))
    segments = sim.withColumn("_segment", F.floor((F.col("rank") - 1) / LIST_SEGMENT).cast("int"))
    found = asked.join(segments, ["mid", "_segment"]).select("uid", F.col("sim_mid").alias("mid"), "score")
    return top_k(exclude_rated(found, seen), "uid", by_score(), k).select("uid", "rank", "mid", "score")


def candidate_x_recent(cand: DataFrame, recents: DataFrame) -> DataFrame:
    """(uid, mid, recent_mid, recent_score): each candidate with each of the user's recent ratings.

    Both sides are lists of fixed length per user.
    """
    recent = recents.select("uid", "pos", F.col("mid").alias("recent_mid"), F.col("score").alias("recent_score"))
    return cand.select("uid", "mid").join(recent, "uid")


def sim_lookup(pairs: DataFrame, sim: DataFrame) -> DataFrame:
    """``pairs`` with the similarity of ``mid`` and ``recent_mid``, 0 where the table has none."""
    known = sim.select("mid", F.col("sim_mid").alias("recent_mid"), F.col("score").alias("sim"))
    return pairs.join(known, ["mid", "recent_mid"], "left").withColumn("sim", F.coalesce("sim", F.lit(0.0)))


def looked_up_pairs(pairs: DataFrame) -> DataFrame:
    """(mid, sim_mid): the rows of a similarity table that ``sim_lookup`` asks for."""
    return pairs.select("mid", F.col("recent_mid").alias("sim_mid")).distinct()


def score_candidates(pairs: DataFrame, gate: float = SCORING_GATE, like: float = LIKED_ABOVE) -> DataFrame:
    """Mean of similarity times rating over the recents above the gate, plus the logarithm of the
    liked count, minus that of the others. A candidate with no recent above the gate drops out."""
    liked = F.count_if(F.col("recent_score") > like)
    disliked = F.count_if(F.col("recent_score") <= like)
    score = F.avg(F.col("sim") * F.col("recent_score")) + log10_count(liked) - log10_count(disliked)
    return pairs.where(F.col("sim") > gate).groupBy("uid", "mid").agg(score.alias("score"))


def batch_recommend(
    events: DataFrame,
    rating: DataFrame,
    sim: DataFrame,
    k: int = CANDIDATES,
    recent: int = RECENT_RATINGS,
    gate: float = SCORING_GATE,
    order: Sequence[str] = ("ts", "mid", "score"),
    similar: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(uid, mid, score) after each user's newest event. ``rating`` already holds the events.

    ``sim`` may be cut to the lists that ``list_depths`` names if ``similar`` makes the rows of the whole
    table for given (mid, sim_mid) pairs.
    """
    cand = top_candidates(latest_event(events, order), sim, rating, k)
    pairs = candidate_x_recent(cand, recent_ratings(rating, recent, order))
    return score_candidates(sim_lookup(pairs, sim if similar is None else similar(looked_up_pairs(pairs))), gate)


def recommendation_lists(events: DataFrame, scored: DataFrame, k: int = CANDIDATES) -> DataFrame:
    """(uid, recs) for every user with an event, the ``k`` best first; empty where nothing was scored."""
    scored = top_k(scored, "uid", by_score(), k)
    entry = F.struct(F.negative(F.round("score", 12)).alias("o"), "mid", "score")
    recs = F.transform(
        F.sort_array(F.collect_list(entry)), lambda r: F.struct(r["mid"].alias("mid"), r["score"].alias("score"))
    )
    lists = scored.groupBy("uid").agg(recs.alias("recs"))
    empty = F.array().cast("array<struct<mid:int,score:double>>")
    return events.select("uid").distinct().join(lists, "uid", "left").withColumn("recs", F.coalesce("recs", empty))
