"""Least squares in blocks: normal equations, Spark's own error, bad ratings, block counts."""

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from ratingloom.operators import als, factors


def made(spark, users=60, items=45):
    rng = np.random.default_rng(5)
    u, v = rng.uniform(0.3, 1.6, size=(users, 3)), rng.uniform(0.3, 1.6, size=(items, 3))
    rows = [(i, j, float(u[i] @ v[j])) for i in range(users) for j in range(items) if rng.random() < 0.4 or i == 0]
    return spark.createDataFrame(rows + rows[:9], "uid int, mid int, score double"), rows + rows[:9]


@pytest.mark.parametrize("rank", [2, 30])
def test_users_solve_their_equations(spark, rank):
    rating, rows = made(spark)
    model = factors.train_als(rating, rank=rank, iterations=2, reg=0.1, blocks=3)
    users = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    items = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    assert set(users) == {u for u, _, _ in rows} and set(items) == {m for _, m, _ in rows}
    for uid, x in users.items():
        f = np.array([items[m] for u, m, _ in rows if u == uid])
        s = np.array([s for u, _, s in rows if u == uid])
        assert np.allclose(f.T @ (f @ x - s) + 0.1 * len(s) * x, 0, atol=1e-3)


def test_blocks_change_nothing(spark):
    rating, _ = made(spark)
    one, many = (factors.train_als(rating, rank=4, iterations=3, blocks=b) for b in (1, 7))
    for a, b in ((one.userFactors, many.userFactors), (one.itemFactors, many.itemFactors)):
        a, b = ({r["id"]: r["features"] for r in f.collect()} for f in (a, b))
        assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], atol=1e-3) for i in a)


def test_the_error_is_that_of_the_built_in_trainer(spark):
    rating, _ = made(spark)
    own = factors.train_als(rating, rank=4, iterations=10, reg=0.05)
    fitted = ALS(userCol="uid", itemCol="mid", ratingCol="score", rank=4, maxIter=10, regParam=0.05, seed=1).fit(rating)
    errors = [m.transform(rating).select(F.sqrt(F.avg((F.col("prediction") - F.col("score")) ** 2))).first()[0] for m in (own, fitted)]
    assert abs(errors[0] - errors[1]) < 0.1 * errors[1] + 0.01


def test_training_leaves_the_model_alone_and_a_freed_model_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(als, "scratch", lambda _, purpose: str(tmp_path / f"{purpose}-{len(list(tmp_path.iterdir()))}-{np.random.randint(1 << 30)}"))
    rating, _ = made(spark)
    model = factors.train_als(rating, rank=3, iterations=2)
    assert [p.name.startswith("als-model") for p in tmp_path.iterdir()] == [True]
    factors.free_model(model)
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("row", [(None, 1, 3.0), (1, None, 3.0), (1, 1, None), (1, 1, float("nan"))])
def test_bad_ratings_are_errors(spark, row):
    rating = spark.createDataFrame([(1, 2, 3.0), row], "uid int, mid int, score double")
    with pytest.raises(Exception, match="no id|a score is null"):
        factors.train_als(rating, rank=2, iterations=1)


def test_nothing_to_train_on_is_an_error(spark):
    with pytest.raises(ValueError, match="no ratings"):
        factors.train_als(spark.createDataFrame([], "uid int, mid int, score double"), rank=2, iterations=1)


def test_blocks_bound_what_is_sent_and_what_is_held():
    assert als.block_count(600_000, 20_000, 200, 12) == 12
    # 1.2 million items: the blocks of users together receive no more than SENT_BYTES.
    assert als.block_count(36_000_000, 1_200_000, 200, 12) * 1_200_000 * 800 <= als.SENT_BYTES
    assert als.block_count(216_000_000, 7_200_000, 200, 12) * als.HELD_BYTES >= 216_000_000 * 800
