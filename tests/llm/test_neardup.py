"""Near-duplicate classes beside all pairs in plain Python, and signatures beside their expectation."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ratingloom.llm import common, neardup
from ratingloom.llm.queries import LLM_REGISTRY

SF_DIR = "/root/testdata/sf0.001"


def shingles(text):
    words = [w for w in text.replace("\n", " ").split(" ") if w]
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_classes(docs, weights="set", similarity=0.8):
    docs = [(i, t) for i, t in docs if i is not None]
    parent = {i: i for i, _ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    counted = [(i, t, shingles(t or "")) for i, t in docs]
    if weights == "set":
        counted = [(i, t, Counter(set(c))) for i, t, c in counted]
    for n, (a, s, left) in enumerate(counted):
        for b, t, right in counted[n + 1 :]:
            total = sum((left | right).values())
            if (s is not None and s == t) or (total and sum((left & right).values()) / total >= similarity):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i, _ in docs}


def mutated(rnd, words, rate):
    return [rnd.choice(VOCAB) if rnd.random() < rate else w for w in words]


VOCAB = [f"w{i}" for i in range(400)]


def planted(seed, groups=12, size=14):
    rnd = random.Random(seed)
    docs = []
    for _ in range(groups):
        base = [rnd.choice(VOCAB) for _ in range(rnd.randint(3, 250))]
        docs += [" ".join(mutated(rnd, base, rnd.choice([0, 0.002, 0.01, 0.02, 0.03, 0.05, 0.2]))) for _ in range(size)]
    docs += [" ".join(rnd.choice(VOCAB) for _ in range(60)) for _ in range(40)]
    rnd.shuffle(docs)
    return [*enumerate(docs)]


def classes(spark, docs, **options):
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, class_id int").repartition(4)
    return neardup.near_duplicate_classes(df, **options).collect()


@pytest.mark.parametrize("weights", ["set", "counts"])
def test_equals_all_pairs(spark, weights):
    docs = planted(len(weights)) + [(900, None), (901, None), (902, ""), (903, ""), (904, " "), (905, "a b"), (906, "a  b"), (907, "b a")]
    docs += [(908, "x y z u v " * 40), (909, "x y z u v " * 30), (910, "x y z u v " * 39)]
    got = classes(spark, docs, weights=weights)
    assert {r.doc_id: r.class_id for r in got} == brute_classes(docs, weights)


def test_chain_through_a_member_that_is_not_smallest(spark):
    words = [f"t{i}" for i in range(200)]
    change = lambda at: [f"c{i}" if i in at else w for i, w in enumerate(words)]
    chain = [change({10, 60, 110, 150}), change({10, 60}), words, change({30}), change({30, 80, 130}), change({30, 80, 130, 180, 45})]
    docs = [(i, " ".join(w)) for i, w in enumerate([chain[0], chain[5], chain[2], chain[1], chain[3], chain[4]])]
    assert {r.doc_id: r.class_id for r in classes(spark, docs)} == brute_classes(docs)


def test_repeated_rows_and_missing_ids(spark):
    docs = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (7, "x")]
    assert sorted((r.doc_id or -1, r.class_id or -1) for r in classes(spark, docs)) == [(-1, -1), (3, 3), (5, 3), (5, 3), (7, 7)]


def test_every_text_of_an_id_is_compared(spark):
    one, two = [f"a{i}" for i in range(120)], [f"b{i}" for i in range(120)]
    docs = [(i, " ".join(w)) for i, w in [(1, one), (1, two), (2, [*one, "x"]), (3, [*two, "y"]), (4, one[:60] + two[:60])]]
    assert {r.doc_id: r.class_id for r in classes(spark, docs)} == brute_classes(docs) == {1: 1, 2: 1, 3: 1, 4: 4}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicate_classes(df).count() == 0


def test_large_blocks_keep_links(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    docs = planted(3, groups=3, size=40)
    assert {r.doc_id: r.class_id for r in classes(spark, docs)} == brute_classes(docs)


def batch(columns, rows):
    return pa.RecordBatch.from_pylist([dict(zip(columns, r, strict=True)) for r in rows])


def links_of(task, columns, rows):
    return [tuple(r.values()) for b in task(iter([batch(columns, rows)])) for r in b.to_pylist()]


def test_a_block_names_its_rows_once():
    sign = lambda *at: bytes(1 if i in at else 0 for i in range(neardup.K))
    queries = [(7, 0, 0, i, i, sign(i), True) for i in range(10, 40)]
    members = [(7, 0, 0, i, i, sign(i), False) for i in range(40)] + [(7, 0, 0, 99, 99, bytes([2] * neardup.K), False)]
    task = neardup._blocks_of(neardup.OPEN, slice(0, 3), neardup._hanging_rows(0.8))
    assert sorted(links_of(task, neardup.OPEN, queries + members)) == [(0, i) for i in range(40)]


def test_a_block_joins_components_on_whole_texts():
    base = [f"t{i}" for i in range(100)]
    text = lambda n: " ".join([*base[:-n], *[f"c{n}x{i}" for i in range(n)]])
    texts = {1: text(1), 2: text(2), 3: text(3), 4: text(60), 5: text(2) + " end"}
    row = lambda i, query: (7, 0, 0, i, {5: 2}.get(i, i), bytes(neardup.K), texts[i], i != 1, query)
    task = neardup._blocks_of(neardup.GROUPED, slice(0, 3), neardup._joining_rows(5, "set", 0.8))
    found = links_of(task, neardup.GROUPED, [row(i, True) for i in (2, 3, 4, 5)] + [row(i, False) for i in texts])
    joined = {frozenset(p) for p in found}
    assert len(found) == 2 and not any(4 in p for p in joined) and all(len(p) == 2 for p in joined)


@pytest.mark.parametrize("rate", [0.016, 0.03])
def test_written_rows_grow_with_the_group(spark, monkeypatch, rate):
    """Near copies of one text: what every step writes is bounded by bands times rows, and far from 16
    times as much for four times the rows."""
    written = {}
    real = neardup.stored

    def counting(df, purpose):
        rows, path = real(df, purpose)
        written.setdefault(purpose, []).append(rows.count())
        return rows, path

    monkeypatch.setattr(neardup, "stored", counting)
    sums = []
    rnd = random.Random(8)
    base = [rnd.choice(VOCAB) + str(i) for i in range(120)]
    docs = [(i, " ".join(mutated(rnd, base, rate))) for i in range(400)]
    for size in (100, 400):
        written.clear()
        got = {r.doc_id: r.class_id for r in classes(spark, docs[:size])}
        sums.append({k: max(v) for k, v in written.items()})
    assert len(set(got.values())) > 1
    assert all(sums[1].get(k, 0) <= 8 * max(20, n) for k, n in sums[0].items()), sums
    assert all(n <= neardup.BANDS * 400 for n in sums[1].values()) and sums[1]["groups"] <= 400


def test_signatures_rule_out_fewer_pairs_than_the_bands_miss():
    k, least = neardup.K, neardup._floor(neardup.SIMILARITY)
    ruled_out = sum(math.comb(k, n) * 0.8**n * 0.2 ** (k - n) for n in range(k + 1) if n / k < least)
    assert ruled_out < (1 - 0.8**neardup.BAND) ** neardup.BANDS


def test_signatures_estimate_weighted_jaccard():
    rnd = np.random.default_rng(5)
    elements = rnd.integers(0, 2**63, 300).astype(np.uint64)
    weights = rnd.integers(1, 6, 300) * 0.75
    other = np.where(rnd.random(300) < 0.3, weights * 0.4, weights)
    truth = np.minimum(weights, other).sum() / np.maximum(weights, other).sum()
    estimates = []
    for salt in range(30):
        mixed = common.mixed(elements + np.uint64(salt))
        both = neardup.dart_signatures(np.concatenate((mixed, mixed)), np.concatenate((weights, other)), np.repeat([0, 1], 300), 2)
        estimates.append((both[0] == both[1]).mean())
    assert abs(np.mean(estimates) - truth) < 0.03


def test_long_and_short_texts_fill_all_coordinates():
    known = common.WordHashes()
    texts = [[b"a"], [], [str(i).encode() for i in range(30_000)]]
    hashes, counts, owner = neardup.shingle_elements(known, texts, 5)
    signatures = neardup.dart_signatures(hashes, counts.astype(float), owner, 3)
    assert (signatures[[0, 2]] != 0).all() and (signatures[1] == 0).all()


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in LLM_REGISTRY["op2_near_duplicates"](spark, SF_DIR).collect()}
    split = [(i, " ".join(t.split())) for i, t in docs]
    assert got == brute_classes(split)
