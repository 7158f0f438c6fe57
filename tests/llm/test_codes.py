"""Vector codes beside Lloyd's rounds over all pairs in plain Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from ratingloom.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, part int"


def brute(rows, entries=256, rounds=4, parts=4):
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in order] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda x, book: min((far(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for _, v, _ in kept:
                mine.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(mine[k]) for c in zip(*mine[k], strict=True)] if k in mine else e for k, e in enumerate(books[p])]
    out, sums = [], {}
    for i, v, label in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        sums[label] = sums.get(label, 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, code, error, sums[label], digest) for i, code, error, label in out), key=str)


def vectors(seed, count, dims=8, spread=0.05):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    single = lambda x: float(np.float32(x))
    return [[single(x + rnd.gauss(0, spread)) for x in rnd.choice(centres)] for _ in range(count)]


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in codes.labelled_codes(df, **options).collect()), key=str)


@pytest.mark.parametrize("seed, spread", [(1, 0.01), (2, 0.3)])
def test_equals_all_pairs(spark, seed, spread):
    rows = [(i * 7 % 1000, v, i % 4 if i % 9 else None) for i, v in enumerate(vectors(seed, 500, spread=spread))]
    assert run(spark, rows, entries=40) == brute(rows, entries=40)


def test_ties_repeats_and_what_is_dropped(spark):
    some = [[0.5, -0.5, 0.25, 0.0]] * 30 + [[0.0, 0.0, 0.0, 0.0]] * 20 + [[1.0, -1.0, 0.5, 0.0]] * 3
    rows = [(i // 2, v, None) for i, v in enumerate(some)] + [(None, [0.1, 0.2, 0.3, 0.4], 1)]
    dropped = [(900, None, 1), (901, [None, 0.0, 0.0, 0.0], 1), (902, [float("nan"), 0.0, 0.0, 0.0], 1), (903, [0.0, float("-inf"), 0.0, 0.0], 1)]
    assert run(spark, rows + dropped) == brute(rows + dropped)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = [(i, v, i % 3) for i, v in enumerate(vectors(4, 300))]
    monkeypatch.setattr(codes, "BLOCK", 37)
    assert run(spark, rows, entries=16, rounds=2) == brute(rows, entries=16, rounds=2)


def test_trees_assign_whole_nodes_and_drop_pairs():
    rnd = np.random.default_rng(3)
    points = np.concatenate([rnd.integers(-30, 30, (400, 4)) + c for c in ([0] * 4, [4000] * 4, [-4000] * 4)])
    entries = np.array([[0, 0, 0, 0], [4000, 4000, 4000, 4000], [4000, 4000, 4000, 4001], [-4000, -4000, -4000, -4000]])
    parts, book = codes.Tree(points, 16), codes.Tree(entries, 1)
    nodes, _ = codes._descend(parts, book)
    assert len(nodes) < 2 * len(points) // 16
    entry, counts, sums = codes.assign(parts, book, True)
    far = ((points[:, None] - entries[None]) ** 2).sum(2)
    assert (entry == far.argmin(1)).all() and (counts == np.bincount(entry, minlength=4)).all()
    assert (sums == [points[entry == k].sum(0) for k in range(4)]).all()
    assert (codes.assign(parts, book, False)[0] == -1).any()


def test_large_components_stay_exact():
    points = np.array([[2**26, 0], [2**26 - 1, 0], [-(2**26), 0]])
    entry, _, _ = codes.assign(codes.Tree(points, 16), codes.Tree(points[::-1].copy(), 1), True)
    assert entry.tolist() == [2, 1, 0]


@pytest.mark.parametrize("bad", [[[0.0] * 4, [0.0] * 8], [[0.0] * 6], [[1e9] * 4]])
def test_what_has_no_codes_is_an_error(spark, bad):
    with pytest.raises((PySparkException, ValueError)):
        run(spark, [(i, v, 1) for i, v in enumerate(bad)])


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, 1)]) == []
