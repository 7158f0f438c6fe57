"""Removed repeats beside a plain dictionary of windows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import substrings

SCHEMA = "doc_id long, text string, n_words int"


def brute(docs, length):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, words in split:
        for at in range(len(words) - length + 1):
            key = tuple(words[at : at + length])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - length + 1):
            if i is not None and first[tuple(words[at : at + length])] < i:
                gone.update(range(at, at + length))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def planted(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["é中", "a b"]
    passages = [[rnd.choice(vocab) for _ in range(rnd.randint(10, 60))] for _ in range(6)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(rnd.randint(0, 6)):
            words += rnd.choice(passages)[rnd.randint(0, 5) :] if rnd.random() < 0.5 else [rnd.choice(vocab) for _ in range(rnd.randint(0, 30))]
        docs.append((rnd.randint(0, 50), rnd.choice([" ", "\n", " \t "]).join(words)))
    return docs + [(100, None), (101, ""), (102, " \n "), (None, docs[0][1]), (None, "x"), docs[3], docs[3]]


@pytest.mark.parametrize("length, seed_words", [(13, 6), (5, 5), (8, 3), (13, 1)])
def test_equals_brute_force(spark, length, seed_words):
    docs = planted(length)
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], SCHEMA).repartition(5)
    got = substrings.remove_repeats(df, length, seed_words).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got], key=str) == brute(docs, length)
    assert all(r.n_removed == sum(s.stop - s.start for s in r.repeats) for r in got)
    assert all(s.stop - s.start >= length for r in got for s in r.repeats)


def test_text_layout_keeps_white_space(spark):
    shared = " ".join(f"s{i}" for i in range(13))
    docs = [(1, f"a b\n\n{shared}  c"), (2, f" x\ty\n{shared}\nz  w\n"), (3, f"{shared}"), (4, f"  {shared} end")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.kept for r in substrings.remove_repeats(df, layout="text").collect()}
    assert got == {1: docs[0][1], 2: " x\ty\nz  w\n", 3: "", 4: "  end"}


def test_empty_and_very_long(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert substrings.remove_repeats(df).count() == 0
    words = [f"w{i}" for i in range(60_000)]
    docs = [(2, " ".join(words), 0), (1, " ".join(words[15_000:]), 0)]
    rows = substrings.remove_repeats(spark.createDataFrame(docs, SCHEMA)).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed) for r in rows] == [(45_000, 0), (60_000, 45_000)]


def test_no_product_or_nested_loop(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string").withColumn("extra", F.lit(1))
    plan = substrings.remove_repeats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
