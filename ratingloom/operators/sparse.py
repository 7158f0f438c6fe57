"""Cosine join of sparse vectors through an index of prefixes.

Terms are ordered by how many vectors have them, rare ones first. A vector's prefix ends where the
rest is shorter than the cut: two unit vectors that share no term of both prefixes have a product
below it. So only vectors that share a prefix term meet, each pair's shared prefix terms are summed,
and the length of the rest that lies behind the shorter prefix bounds what is missing; what passes
that bound is multiplied in full. A frequent term is in a prefix only of vectors that have little
else, and adaptive execution splits its side of the join.

Equal vectors all pass: collapse them first where there are many, as ``content_profiles`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.scalars import stable
from ratingloom.schemas import MIN_SIMILARITY, SCORE_DIGITS
from ratingloom.session import materialised

#: Rounded sums differ from exact ones by less.
SLACK = 10.0 ** (1 - SCORE_DIGITS)


def _square_sum(entries: Column) -> Column:
    return F.aggregate(entries, F.lit(0.0), lambda total, e: total + e["w"] * e["w"])


def ordered_vectors(vectors: DataFrame) -> DataFrame:
    """(id, entries) of all vectors that have a direction: unit weights as (df, term, w), rare terms
    first, written once."""
    flat = vectors.select(F.col("mid").alias("id"), F.inline("features"))
    flat = flat.where(F.col("weight") != 0)
    spread = flat.groupBy("term").agg(F.count("*").alias("df"))
    entry = F.struct("df", "term", F.col("weight").alias("w"))
    rows = flat.join(spread, "term").groupBy("id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    length = F.sqrt(_square_sum(F.col("entries")))
    unit = F.transform("entries", lambda e: F.struct(e["df"].alias("df"), e["term"].alias("term"), (e["w"] / F.col("_length")).alias("w")))
    return materialised(rows.withColumn("_length", length).select("id", unit.alias("entries")), "ordered-vectors")


def prefixes(ordered: DataFrame, min_sim: float) -> DataFrame:
    """(id, df, term, w, last, rest): every prefix entry, the prefix's last (df, term) and the length of
    what follows it."""
    start = F.struct(F.lit(0.0).alias("before"), F.lit(0).alias("n"))
    cut = (min_sim - SLACK) ** 2

    def step(at: Column, e: Column) -> Column:
        # An entry is in the prefix while it and what follows are as long as the cut.
        inside = 1 - at["before"] >= cut
        return F.struct((at["before"] + e["w"] * e["w"]).alias("before"), (at["n"] + F.when(inside, 1).otherwise(0)).alias("n"))

    count = F.aggregate("entries", start, step, lambda at: at["n"])
    kept = ordered.withColumn("_n", count).withColumn("prefix", F.slice("entries", F.lit(1), F.col("_n")))
    rest = F.sqrt(F.greatest(F.lit(0.0), 1 - _square_sum(F.col("prefix"))))
    last = F.element_at("prefix", -1)
    return kept.select("id", F.inline("prefix"), F.struct(last["df"].alias("df"), last["term"].alias("term")).alias("last"), rest.alias("rest"))


def candidates(prefix: DataFrame, min_sim: float) -> DataFrame:
    """(a, b): pairs with a < b that share a prefix term and whose bound reaches the cut."""
    side = lambda s: prefix.select("term", *[F.col(c).alias(f"{s}_{c}") for c in ("id", "w", "last", "rest")])
    met = side("a").join(side("b"), "term").where("a_id < b_id")
    rest = F.when(F.col("a_last") <= F.col("b_last"), F.col("a_rest")).otherwise(F.col("b_rest"))
    bound = F.sum(F.col("a_w") * F.col("b_w")) + F.first(rest)
    pairs = met.groupBy(F.col("a_id").alias("a"), F.col("b_id").alias("b")).agg(bound.alias("bound"))
    return pairs.where(F.col("bound") > min_sim - SLACK).select("a", "b")


def sparse_cosine(vectors: DataFrame, min_sim: float = MIN_SIMILARITY) -> DataFrame:
    """(mid, sim_mid, score): both directions of all pairs of different items with cosine above
    ``min_sim``, as ``all_pairs_cosine`` with ``sparse`` has them. ``min_sim`` is positive."""
    if min_sim <= 0:
        raise ValueError("without a positive cut no pair can be passed over; see all_pairs_cosine")
    ordered = ordered_vectors(vectors)
    pairs = candidates(prefixes(ordered, min_sim), min_sim)
    weights = F.map_from_entries(F.transform("entries", lambda e: F.struct(e["term"], e["w"])))
    left, right = ordered.select(F.col("id").alias("a"), "entries"), ordered.select(F.col("id").alias("b"), weights.alias("weights"))
    both = pairs.join(left, "a").join(right, "b")
    product = F.aggregate("entries", F.lit(0.0), lambda total, e: total + e["w"] * F.coalesce(F.try_element_at("weights", e["term"]), F.lit(0.0)))
    scored = both.select("a", "b", stable(product).alias("score")).where(F.col("score") > min_sim)
    directions = F.array(F.struct(F.col("a").alias("mid"), F.col("b").alias("sim_mid")), F.struct(F.col("b").alias("mid"), F.col("a").alias("sim_mid")))
    return scored.select(F.inline(directions), "score")
