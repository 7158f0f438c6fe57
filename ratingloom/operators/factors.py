"""Latent-factor recommendation: train, predict, evaluate, tune."""

from __future__ import annotations

import gc
import math
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ratingloom.operators import als
from ratingloom.operators.lists import similar_items, user_top
from ratingloom.operators.products import scored_pairs
from ratingloom.operators.vectors import all_pairs_cosine, best_products
from ratingloom.schemas import (
    ALS_ITERATIONS,
    ALS_LAMBDA,
    ALS_RANK,
    MIN_SIMILARITY,
    TUNING_LAMBDAS,
    TUNING_RANKS,
    USER_LIST_LENGTH,
)
from ratingloom.session import dealt, forget, materialised


# Bytes of factors that one ``transform`` sends along with its pairs.
SENT_AT_ONCE = 4_000_000_000


def project_triples(rating: DataFrame) -> DataFrame:
    return rating.select("uid", "mid", "score")


def split_ratings(
    rating: DataFrame, ids: Sequence[str] = ("uid", "mid", "ts"), share: float = 0.8, seed: int = 7
) -> tuple[DataFrame, DataFrame]:
    """Disjoint random parts that cover the input.

    The side of a row follows from a hash of its ``ids`` and the seed, so a recomputed partition
    puts every row on the same side again.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c) for c in ids]))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(16**8))
    drawn = rating.withColumn("_draw", draw)
    return drawn.where(F.col("_draw") < share).drop("_draw"), drawn.where(F.col("_draw") >= share).drop("_draw")


def train_als(
    rating: DataFrame,
    rank: int = ALS_RANK,
    iterations: int = ALS_ITERATIONS,
    reg: float = ALS_LAMBDA,
    seed: int = 7,
    blocks: int | None = None,
) -> ALSModel:
    """Explicit-feedback factors, lambda weighted by the number of ratings. ``blocks`` is the number of
    user and item blocks; by default it follows from the ratings and the tasks the cluster runs at once.
    The factors lie below the shared folder until ``free_model``."""
    return als.fit(project_triples(rating), rank, iterations, reg, seed, blocks)


def score_factors(user_factor: DataFrame, item_factor: DataFrame, pairs: DataFrame) -> DataFrame:
    """(uid, mid, score, copies): factor products of given (uid, mid) pairs.

    Pairs with an unknown id drop out; ``copies`` counts how often a pair was given. A vector is sent
    once to each block of pairs that names it, not along with every pair.
    """
    return scored_pairs(pairs, user_factor.select("uid", "features"), item_factor.select("mid", "features"))


def factor_tables(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    users = model.userFactors.select(F.col("id").alias("uid"), "features")
    items = model.itemFactors.select(F.col("id").alias("mid"), "features")
    return users, items


def predict_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predicted scores of the pairs whose user and item the model knows, as ``score_factors``."""
    return score_factors(*factor_tables(model), pairs)


def transformed(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """(uid, mid, prediction): ``model.transform`` of distinct pairs. It sends a user's factors along with
    every pair, so large tables are answered part after part, by users, and the answers stored. What the
    model drops is dropped from the stored answers: its own filter would multiply every pair once more."""
    drop = model.getColdStartStrategy() == "drop"
    model = model.copy({model.coldStartStrategy: "nan"})
    pairs = materialised(pairs.select("uid", "mid"), "pairs")
    parts = max(1, math.ceil(pairs.count() * model.rank * 4 / SENT_AT_ONCE))
    answers = []
    for part in range(parts):
        some = pairs.where(F.pmod(F.xxhash64("uid"), F.lit(parts)) == part)
        answers.append(materialised(model.transform(some).select("uid", "mid", "prediction"), "predictions"))
        # Spark deletes the files of a shuffle once nothing refers to it.
        gc.collect()
        pairs.sparkSession._jvm.System.gc()
    found = reduce(DataFrame.unionByName, answers)
    return found.na.drop("all", subset=["prediction"]) if drop else found


def top_products(user_factor: DataFrame, item_factor: DataFrame, k: int = USER_LIST_LENGTH) -> DataFrame:
    """(uid, rank, mid, score): the ``k`` best positive products per user over all items."""
    return user_top(best_products(user_factor, item_factor, k), k)


def recommend_users(model: ALSModel, k: int = USER_LIST_LENGTH) -> DataFrame:
    """(uid, rank, mid, score): the ``k`` best positive predictions per user. Blocks of users meet
    blocks of items; there is no product of the two tables."""
    return top_products(*factor_tables(model), k)


def factor_similarity(model: ALSModel, min_sim: float = MIN_SIMILARITY, k: int | None = None) -> DataFrame:
    """Similar items by the cosine of their factors, with their rank; whole lists without ``k``."""
    items = factor_tables(model)[1]
    return similar_items(all_pairs_cosine(items, min_sim, k, ranked=True), k, min_sim)


def join_observed_predicted(obs: DataFrame, pred: DataFrame) -> DataFrame:
    """(uid, mid, actual, predicted, n): observed and predicted scores of the same pair.

    A repeated pair meets every copy on the other side. The copies are counted before the join and
    multiplied in ``n``, so no repeated pair is ever expanded; ``pred`` may bring its own ``copies``.
    """
    copies = F.sum("copies") if "copies" in pred.columns else F.count("*")
    actual = obs.groupBy("uid", "mid", F.col("score").alias("actual")).agg(F.count("*").alias("_n"))
    predicted = pred.groupBy("uid", "mid", F.col("score").alias("predicted")).agg(copies.alias("_m"))
    return actual.join(predicted, ["uid", "mid"]).select(
        "uid", "mid", "actual", "predicted", (F.col("_n") * F.col("_m")).alias("n")
    )


def _moments(scores: DataFrame, parts: int | None = None) -> DataFrame:
    """(uid, mid, n, mean, var): count, mean and variance of the scores of every pair."""
    scores = dealt(scores, parts, "uid", "mid")
    if "copies" in scores.columns:
        return scores.select("uid", "mid", F.col("copies").alias("n"), F.col("score").alias("mean"), F.lit(0.0).alias("var"))
    return scores.groupBy("uid", "mid").agg(
        F.count("*").alias("n"), F.avg("score").alias("mean"), F.var_pop("score").alias("var")
    )


def rmse(obs: DataFrame, pred: DataFrame, parts: int | None = None) -> DataFrame:
    """One row: root of the mean squared error over the pairs of ``join_observed_predicted``.

    The squares over all copies of a pair follow from both sides' moments, so each side is shuffled
    once and the join meets every pair once. ``pred`` with ``copies`` has each pair once already.
    ``parts`` is the number of partitions for large tables, by default the session's.
    """
    o = _moments(obs, parts).select("uid", "mid", F.col("n").alias("_n"), F.col("mean").alias("_mean"), F.col("var").alias("_var"))
    both = o.join(_moments(pred, parts), ["uid", "mid"])
    copies = F.col("n") * F.col("_n")
    squares = copies * (F.col("var") + F.col("_var") + F.pow(F.col("mean") - F.col("_mean"), F.lit(2.0)))
    return both.agg(F.sqrt(F.try_divide(F.sum(squares), F.sum(copies))).alias("rmse"))


def tune_als(
    train: DataFrame,
    test: DataFrame,
    ranks: Sequence[int] = TUNING_RANKS,
    lambdas: Sequence[float] = TUNING_LAMBDAS,
    iterations: int = ALS_ITERATIONS,
    seed: int = 7,
    at_once: int = 3,
) -> DataFrame:
    """(rank, lambda, rmse), one row per grid cell; both parts are read once for the whole grid.

    ``at_once`` cells are fitted side by side, each in a job group and a scheduler pool of its own, so
    one cell's last tasks do not leave the cluster idle; pools share it where the session runs with
    ``spark.scheduler.mode=FAIR``. If a cell fails the jobs of the others are cancelled.
    """
    spark = train.sparkSession
    context, run = spark.sparkContext, uuid.uuid4().hex
    train = project_triples(train).persist(StorageLevel.MEMORY_AND_DISK)
    test = project_triples(test).persist(StorageLevel.MEMORY_AND_DISK)

    def cell(rank: int, reg: float) -> tuple[int, float, float]:
        name = f"tune-{run}-{rank}-{reg}"
        context.setJobGroup(name, f"ALS of rank {rank}, lambda {reg}", True)
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            model = train_als(train, rank, iterations, reg, seed)
            error = rmse(test, predict_pairs(model, test)).first()["rmse"]
            free_model(model)
            return rank, float(reg), error
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)

    grid = [(rank, reg) for rank in ranks for reg in lambdas]
    try:
        # The first cell reads both parts; the others find them held.
        cells = [cell(*grid[0])] if grid else []
        with ThreadPoolExecutor(max(1, at_once)) as pool:
            running = [pool.submit(inheritable_thread_target(spark)(cell), *g) for g in grid[1:]]
            try:
                cells += [r.result() for r in running]
            except BaseException:
                for r in running:
                    r.cancel()
                for rank, reg in grid:
                    context.cancelJobGroup(f"tune-{run}-{rank}-{reg}")
                raise
    finally:
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(cells, "rank int, lambda double, rmse double")


def free_model(model: ALSModel) -> None:
    """Delete the stored factors of one model; those of others stay."""
    forget(model.userFactors.sparkSession, model.path)


def best_params(grid: DataFrame) -> DataFrame:
    """The grid row with the least error; cells without a number are passed over."""
    usable = grid.where(F.col("rmse").isNotNull() & ~F.isnan("rmse"))
    return usable.orderBy("rmse", "rank", "lambda").limit(1)
