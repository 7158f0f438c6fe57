"""Contamination beside plain loops over words."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import decontam


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, length):
    phrases = {}
    for item, text in items:
        ws = words_of(text)
        for i in range(max(1, len(ws) - length + 1) if ws else 0):
            phrases.setdefault(tuple(ws[i : i + length]), set()).add(item)
    out = []
    for doc, text in docs:
        ws = words_of(text)
        hit, held = set(), set()
        for size in {len(p) for p in phrases}:
            for i in range(len(ws) - size + 1):
                found = phrases.get(tuple(ws[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    held |= found
        out.append((doc, len(ws), len(hit), len(held), sorted(map(str, held)), bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=str)


def planted(seed):
    rnd = random.Random(seed)
    vocab = ["the", "The", "of", "a"] * 8 + [f"W{i}" for i in range(40)] + ["é中", "42"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([3, 12, 13, 14, 30])))) for i in range(25)]
    docs = []
    for i in range(80):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            if rnd.random() < 0.4:
                parts.append(" ".join(words_of(rnd.choice(items)[1])[rnd.randint(0, 3) :]))
            else:
                parts.append(", ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 60))))
        docs.append((i % 70, "\n".join(parts)))
    return docs, items


@pytest.mark.parametrize("length, rarest", [(13, 2), (5, 1), (13, 3)])
def test_equals_brute_force(spark, length, rarest):
    docs, items = planted(length)
    docs += [(500, None), (501, ""), (None, items[3][1]), (None, "x " * 100 + items[4][1]), docs[1], (502, "a b " * 9_000 + items[5][1])]
    items += [(90, None), (91, ""), (92, items[7][1]), (92, items[7][1]), (93, "W1"), (94, "never seen here")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int").repartition(4)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = decontam.contamination(df, bench, length, rarest).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(docs, items, length)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    docs, items = planted(1)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted([tuple(r) for r in decontam.contamination(df, bench).collect()], key=str) == brute(docs, items, 13)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontam.contamination(docs.limit(0), items).count() == 0
    assert [tuple(r) for r in decontam.contamination(docs, items.limit(0)).collect()] == [(1, 2, 0, 0, [], False)]


def test_proximity(spark):
    docs = [(1, "rare one gap two"), (2, "rare one two"), (3, "two rare one"), (4, "one x x x x x x rare"), (5, "rare rare one")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "rare two")], "item_id long, text string")
    index = decontam.PhraseIndex(df, bench)
    near = {(r.doc, r.begin, r.off) for r in index.near(2).collect()}
    assert near == {(1, 0, 2), (2, 0, 1), (3, 0, 2)}
    assert index.exact().count() == 0


def test_main_path_is_built_in(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = decontam.contamination(df, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_words_are_cut_at_gaps(spark):
    texts = [None, "", " .,", "One", " one TWO", "one\n", "--a--b--", "é中Ü ñ\x00x\x7fy", "É 😀z\x85w", "a1_b2'c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    cut = df.select("text", decontam.words(F.col("text")).alias("words"), decontam.word_count("text").alias("n"))
    assert [(r.words or [], r.n) for r in cut.collect()] == [(words_of(t), len(words_of(t))) for t in texts]
    # One object for every match made this most of the query's time.
    assert "regexp_extract_all" not in cut._jdf.queryExecution().executedPlan().toString()
