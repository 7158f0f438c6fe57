"""Importance resampling beside plain Python over whole texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from ratingloom.llm import resampling

SCHEMA = "doc_id long, text string, rank int, weight string"


def features(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return words, words + [a + b" " + b for a, b in zip(words, words[1:], strict=False)]


def brute(docs, target, buckets=10_000, share=25, least=20, seed=7):
    raw, wanted = Counter(), Counter()
    for counts, texts in ((raw, [t for _, t in docs]), (wanted, target)):
        for text in texts:
            counts.update(zlib.crc32(f) % buckets for f in features(text)[1])
    here, there = sum(raw.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (here + buckets) / ((raw[b] + 1) * (there + buckets))))
    rows = []
    for key, text in docs:
        words, found = features(text)
        weight = sum(gain(zlib.crc32(f) % buckets) for f in found) // len(found) if found else 0
        score = None
        if key is not None:
            h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(words), len(found), weight, score, None])
    able = sorted((r for r in rows if r[1] >= least and r[4] is not None), key=lambda r: (-r[4], r[0], r[2], r[3]))
    for i, row in enumerate(able[: share * len(able) // 100]):
        row[5] = i + 1
    return sorted(map(tuple, rows), key=str)


def texts(seed, count):
    rnd = random.Random(seed)
    words = ["The", "thing", "über", "x" * 90, "a1", "Ärger", "z-y", "日本", "\n", "\x00"] + [f"w{i}" for i in range(60)]
    return [rnd.choice([" ", "  ", ", "]).join(rnd.choices(words, k=rnd.randint(0, 60))) for _ in range(count)]


def run(spark, docs, target, **options):
    df = spark.createDataFrame([(i, t, 5, "w") for i, t in docs], SCHEMA).repartition(3)
    asked = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted((tuple(r) for r in resampling.resample(df, asked, **options).collect()), key=str)


def test_equals_plain_python(spark):
    docs = list(enumerate(texts(1, 150))) + [(200, None), (201, ""), (None, "a b " * 40), (None, None), (3, "again and again " * 20), (3, "again and again " * 20)]
    docs += [(300, "very long " * 30_000), (301, "y" * 200_000 + " " + "q" * 100)]
    target = [*texts(2, 10), None]
    assert run(spark, docs, target) == brute(docs, target)
    assert run(spark, docs, target, buckets=17, share=60, seed=1) == brute(docs, target, buckets=17, share=60, seed=1)


def test_ranks_are_whole_and_in_order(spark):
    docs = [(i, "one two three " * 10) for i in range(400)]
    ranked = [r for r in run(spark, docs, ["one"]) if r[5] is not None]
    assert sorted(r[5] for r in ranked) == list(range(1, 101))
    assert [r[0] for r in sorted(ranked, key=lambda r: r[5])] == [r[0] for r in sorted(ranked, key=lambda r: (-r[4], r[0]))]


def test_carried_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(1, "a b", 7, "s")], SCHEMA)
    assert resampling.resample(df, df, carry=("rank",)).select("doc_id", "n_words").collect()[0] == (1, 2)


def test_empty_tables(spark):
    assert run(spark, [], ["a b"]) == []
    docs = list(enumerate(texts(5, 30)))
    assert run(spark, docs, []) == brute(docs, [])
