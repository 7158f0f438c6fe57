"""Source mixes: targets beside plain rounds, taken words beside the blocks themselves, and permutations."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, taken string"


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        rest, parts = total - sum(fixed.values()), sum(weight[s] for s in free)
        above = [s for s in free if most * sizes[s] < rest * weight[s] / parts]
        if not above:
            return fixed | {s: rest * weight[s] / parts for s in free}
        fixed |= {s: most * sizes[s] for s in above}


def documents(seed, count=120):
    rnd = random.Random(seed)
    sources = ["a", "b", "é", "Z", "", None, "z\U0001f600", "z￮"]
    pick = lambda: sources[0] if rnd.random() < 0.4 else rnd.choice(sources)
    docs = [(i, " \n".join(f"d{i}w{j}" for j in range(rnd.randint(0, 90))), pick()) for i in range(count)]
    return docs + [(500, None, "a"), (501, "", "b"), (502, " \t", "only empty"), (None, "n o i d", "a"), (7, "x y", "a"), (7, "x y", "a"), (503, "big " * 3000, "b")]


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "t") for d in docs], SCHEMA).repartition(3)


@pytest.mark.parametrize("block", [1, 7, 64, 512])
def test_targets_are_met(spark, block):
    docs = documents(block)
    rows = mixing.mix(frame(spark, docs), block=block).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in rows) == Counter((i, s, len((t or "").split())) for i, t, s in docs)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
    targets = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], rel=1e-12)
        assert 0 <= r.taken <= 3 * r["size"]
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in sizes)


@pytest.mark.parametrize("unit", [1_000, 250_000_000, 2_000_000_000])
def test_targets_of_many_words(spark, unit):
    """Words whose number an int holds, but not three times that; and more."""
    sizes = {"a": 3 * unit, "b": unit, "c": unit // 10, "d": 2 * unit}
    targets = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long"))[0].collect()}
    assert targets == pytest.approx(brute_targets(sizes), rel=1e-12)


def test_reruns_and_partitions_agree(spark):
    df = frame(spark, documents(3))
    one = sorted(map(tuple, mixing.mix(df, block=16).collect()), key=str)
    assert one == sorted(map(tuple, mixing.mix(df.repartition(7), block=16).collect()), key=str)
    assert one != sorted(map(tuple, mixing.mix(df, block=16, seed=14).collect()), key=str)


def test_shards_hold_what_documents_give(spark):
    df = frame(spark, documents(4))
    mixed = mixing.mix(df, block=16)
    pieces = mixing.mixed_shards(df, block=16, shard=8).collect()
    taken = Counter()
    slots = defaultdict(list)
    for p in pieces:
        taken[p.doc_id] += len(p.text.split())
        slots[p.shard, p.slot].append((p.piece, p.text))
    expected = Counter()
    for r in mixed.collect():
        expected[r.doc_id] += r.taken
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in expected.items() if v}
    n = len(slots)
    assert set(slots) == {(i // 8, i % 8) for i in range(n)}
    assert all(len(" ".join(t for _, t in sorted(s)).split()) <= 16 for s in slots.values())
    # A piece is consecutive words of its document.
    said = {i: (t or "").split() for i, t, _ in documents(4)}
    assert all(said[p.doc_id][p.first_word : p.first_word + len(p.text.split())] == p.text.split() for p in pieces if p.doc_id not in (None, 7))


def test_shards_differ_like_a_draw(spark):
    docs = [(i, "w " * 64, "ab"[i % 2]) for i in range(400)]
    sources, _ = mixing.source_targets(frame(spark, docs).select("source", F.lit(64).cast("long").alias("size")))
    counts = mixing.drawn_blocks(sources, 16, 40).groupBy("shard").pivot("number", [0, 1]).count().collect()
    full = [r for r in counts if (r["0"] or 0) + (r["1"] or 0) == 40]
    shares = [r["0"] / 40 for r in full]
    assert len(full) == 40 and len(set(shares)) > 5 and abs(sum(shares) / len(shares) - 1 / 3) < 0.02


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000])
def test_permutation(spark, n):
    keys = mixing.permutation_keys(F.lit(n).cast("long"), "s", F.col("k"))
    rows = spark.range(n).crossJoin(spark.range(3).withColumnRenamed("id", "k")).select("k", "id", mixing.permuted(F.col("id"), F.lit(n).cast("long"), keys).alias("to")).collect()
    for k in range(3):
        assert sorted(r.to for r in rows if r.k == k) == list(range(n))
    if n == 1000:
        assert len({tuple(r.to for r in rows if r.k == k) for k in range(3)}) == 3
        # Neighbours do not stay neighbours.
        to = {r.id: r.to for r in rows if r.k == 0}
        assert sum(abs(to[i] - to[i + 1]) == 1 for i in range(n - 1)) < 20


def test_empty_table(spark):
    assert mixing.mix(frame(spark, [])).collect() == [] and mixing.mixed_shards(frame(spark, [])).collect() == []
    assert [tuple(r) for r in mixing.mix(frame(spark, [(1, None, None)])).collect()] == [(1, None, 0, 0, 0.0, 0)]
