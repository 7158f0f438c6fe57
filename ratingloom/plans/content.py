"""Item similarity from the words of the genre column.

Many items share the same words, hence the same vector. All vector work runs on the distinct word
lists (profiles); items meet their profile only at the end.
"""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.scalars import stable
from ratingloom.operators.lists import by_score, filter_similar, top_k
from ratingloom.operators.sparse import sparse_cosine
from ratingloom.operators.vectors import all_pairs_cosine
from ratingloom.schemas import HASH_BUCKETS, MIN_SIMILARITY
from ratingloom.session import materialised


def project_content(movie: DataFrame) -> DataFrame:
    """(mid, name, genres) with the genre separators turned into spaces."""
    return movie.select("mid", "name", F.translate("genres", "|", " ").alias("genres"))


def tokenize(df: DataFrame, col: str = "genres") -> DataFrame:
    """``df`` plus ``words``: lower-case pieces between single white space characters."""
    return Tokenizer(inputCol=col, outputCol="words").transform(df)


def term_counts(tokens: DataFrame, buckets: int | None = None) -> DataFrame:
    """Exact counts (mid, term, tf), or with ``buckets`` hashed counts as a vector column."""
    if buckets is not None:
        return HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=buckets).transform(tokens)
    return tokens.select("mid", F.explode("words").alias("term")).groupBy("mid", "term").agg(F.count("*").alias("tf"))


def tfidf(counts: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """Weights tf * ln((m + 1) / (df + 1)).

    Exact counts give (mid, term, weight), where ``documents`` has the m items; hashed counts give a
    ``features`` vector.
    """
    if "rawFeatures" in counts.columns:
        return IDF(inputCol="rawFeatures", outputCol="features").fit(counts).transform(counts)
    total = (counts.select("mid").distinct() if documents is None else documents).agg(F.count("*").alias("m")).scalar()
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    weight = F.col("tf") * F.log((total + 1) / (F.col("df") + 1))
    return counts.join(df, "term").select("mid", "term", weight.alias("weight"))


def content_profiles(movie: DataFrame) -> DataFrame:
    """(gid, words, members): the distinct word lists; gid is the least mid that has the list."""
    bag = F.array_sort("words").alias("words")
    return (
        tokenize(project_content(movie))
        .groupBy(bag)
        .agg(F.min("mid").alias("gid"), F.count("*").alias("members"))
    )


def profile_members(movie: DataFrame, profiles: DataFrame) -> DataFrame:
    """(mid, gid): the profile of every item."""
    bags = tokenize(project_content(movie)).select("mid", F.array_sort("words").alias("words"))
    return bags.join(profiles.select("gid", "words"), "words").select("mid", "gid")


def _profile_vectors(profiles: DataFrame, buckets: int | None) -> DataFrame:
    """(mid = gid, features) with document frequencies that count every member of a profile."""
    if buckets is not None:
        hashed = HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=buckets).transform(profiles)
        counts = hashed.select("gid", "members", F.posexplode(vector_to_array("rawFeatures")).alias("term", "tf"))
        counts = counts.where(F.col("tf") > 0)
    else:
        counts = (
            profiles.select("gid", "members", F.explode("words").alias("term"))
            .groupBy("gid", "members", "term")
            .agg(F.count("*").alias("tf"))
        )
    total = profiles.agg(F.sum("members").alias("m")).scalar()
    df = counts.groupBy("term").agg(F.sum("members").alias("df"))
    weight = F.col("tf") * F.log((total + 1) / (F.col("df") + 1))
    entry = F.struct(F.col("term").cast("string").alias("term"), weight.cast("double").alias("weight"))
    return counts.join(df, "term").groupBy(F.col("gid").alias("mid")).agg(F.collect_list(entry).alias("features"))


def profile_similarity(
    profiles: DataFrame,
    min_sim: float = MIN_SIMILARITY,
    buckets: int | None = HASH_BUCKETS,
    k: int | None = None,
    indexed: bool = False,
) -> DataFrame:
    """(gid, sim_gid, score): similar profiles, both directions, whole lists or the ``k`` best.
    ``indexed`` makes whole lists by an index of prefixes instead of products of blocks: for many
    terms, of which a profile has few.

    A profile with weight on some word is similar to itself with score 1, which stands for the pairs
    among its members.
    """
    vectors = materialised(_profile_vectors(profiles, buckets), "profile-vectors")
    pairs = sparse_cosine(vectors, min_sim) if indexed and k is None else all_pairs_cosine(vectors, min_sim, k, sparse=True)
    pairs = pairs.select(F.col("mid").alias("gid"), F.col("sim_mid").alias("sim_gid"), "score")
    weighted = F.exists("features", lambda f: f["weight"] != 0)
    alone = vectors.where(weighted).select(F.col("mid").alias("gid"), F.col("mid").alias("sim_gid"), F.lit(1.0).alias("score"))
    return pairs.unionByName(alone.where(F.col("score") > min_sim))


def similar_members(pairs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(mid, rank, sim_mid, score): the ``k`` best similar items of every item.

    Only the best profiles that together hold k + 1 items are opened, and of each no more than its
    first k + 1 items: no pair list is expanded beyond what the cut can reach.
    """
    sizes = members.groupBy(F.col("gid").alias("sim_gid")).agg(F.count("*").alias("size"))
    better = Window.partitionBy("gid").orderBy(F.desc(stable("score"))).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    equal = Window.partitionBy("gid", stable("score"))
    reached = (
        pairs.join(sizes, "sim_gid")
        .withColumn("_before", F.sum("size").over(better) - F.sum("size").over(equal))
        .where(F.col("_before") < k + 1)
        .select("gid", "sim_gid", "score")
    )
    first = top_k(members.select(F.col("gid").alias("sim_gid"), F.col("mid").alias("sim_mid")), "sim_gid", [F.asc("sim_mid")], k + 1)
    options = reached.join(first.drop("rank"), "sim_gid").select("gid", "sim_mid", "score")
    best = top_k(options, "gid", by_score("sim_mid"), k + 1, rank="_r").drop("_r")
    own = members.join(best, "gid").where(F.col("mid") != F.col("sim_mid"))
    return top_k(own, "mid", by_score("sim_mid"), k).select("mid", "rank", "sim_mid", "score")


def content_similarity(
    movie: DataFrame, k: int, min_sim: float = MIN_SIMILARITY, buckets: int | None = HASH_BUCKETS
) -> DataFrame:
    """The ``k`` best per item; the whole result is ``profile_similarity`` with ``profile_members``.

    (mid, rank, sim_mid, score): items with similar genre words. Every profile has a member, so the
    k + 1 best profiles, its own among them, and their ties hold the k best items.
    ``buckets=None`` counts exact words instead of hashed ones. The uncut lists are
    ``profile_similarity`` with ``profile_members``; ``similar_to`` opens them for chosen items.
    The profiles are written to the checkpoint folder once, as several steps read them.
    """
    profiles = materialised(content_profiles(movie), "profiles")
    pairs = profile_similarity(profiles, min_sim, buckets, k + 1)
    return similar_members(pairs, profile_members(movie, profiles), k)


def similar_to(mids: DataFrame, pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(mid, sim_mid, score): the whole similarity lists of the given items."""
    asked = members.join(mids.select("mid").distinct(), "mid", "left_semi")
    others = members.select(F.col("gid").alias("sim_gid"), F.col("mid").alias("sim_mid"))
    found = asked.join(pairs, "gid").join(others, "sim_gid").where(F.col("mid") != F.col("sim_mid"))
    return filter_similar(found.select("mid", "sim_mid", "score"), 0.0)
