"""Counts beside plain Python, and the label model beside plain Python EM."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import rules
from ratingloom.llm.queries import LLM_REGISTRY

SF_DIR = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(i, i + 3)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [None, "", " \n\t ", "a", "a a a", "a a a a", "a b c a b c", "x\nx\n\nx y\n\n", "# * $ <b>", "é中😀 é中😀 é中😀 é中😀 z", "a b c d a b c\ta b\x0bc",
         "one two three " * 3000, "word " * 60, "A\x1cB\x85C \xa0 d"]


def test_counts(spark):
    rnd = random.Random(4)
    texts = TEXTS + [rnd.choice([" ", "\n"]).join(rnd.choice("ab") for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a", "x")], "doc_id long, text string, n_words string")
    got = {r.doc_id: r for r in rules.text_counts(df).collect()}
    assert len(got) == len(texts) + 1
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), repr(text)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = LLM_REGISTRY["op10_quality"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        expected = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert r.kept == (not r.base_failed and r.quality >= 0.5)


def plain_em(patterns, names):
    good, acc = rules.GOOD, {n: rules.ACCURACY for n in names}
    for _ in range(rules.STEPS):
        q = {}
        for p in patterns:
            odds = math.log(good / (1 - good)) + sum(v * math.log(acc[n] / (1 - acc[n])) for n, v in zip(names, p))
            q[p] = 1 / (1 + math.exp(-odds))
        before = dict(acc)
        for i, n in enumerate(names):
            right = sum(c * (q[p] if p[i] > 0 else 1 - q[p]) for p, c in patterns.items() if p[i])
            cast = sum(c for p, c in patterns.items() if p[i])
            acc[n] = min(rules.HIGHEST, max(rules.LOWEST, (right + rules.PRIOR_VOTES * rules.ACCURACY) / (cast + rules.PRIOR_VOTES)))
        if max(abs(acc[n] - before[n]) for n in names) < rules.SETTLED:
            break
    return acc


def test_label_model(spark):
    rnd = random.Random(7)
    chosen = rules.RULES[:4]
    names = [r.name for r in chosen]
    right = dict(zip(names, [0.95, 0.9, 0.75, 0.6]))
    rows = []
    for _ in range(3000):
        good = rnd.random() < 0.65
        rows.append(tuple(0 if rnd.random() < 0.2 else (1 if good else -1) * (1 if rnd.random() < right[n] else -1) for n in names))
    voted = spark.createDataFrame(rows, ", ".join(f"vote_{n} int" for n in names))
    model = rules.fit(voted, chosen)
    assert model.accuracy == pytest.approx(plain_em(Counter(rows), names))
    assert all(abs(model.accuracy[n] - right[n]) < 0.08 for n in names)


def test_empty_table(spark):
    assert rules.judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_main_path_is_built_in(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    for frame in (rules.text_counts(df), rules.judge(df)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Exchange hash", plan)


def test_labelled_texts(spark):
    """Held beside the quality labels, which no rule has seen."""
    sf_dir = "/root/testdata/sf0.01"
    judged = LLM_REGISTRY["op10_quality"](spark, sf_dir).where("not base_failed").select("doc_id", "kept")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    share = {r.label: r.kept for r in judged.join(labels, "doc_id").groupBy("label").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.98 and share[0] < 0.1


def test_clean_text_is_kept(spark):
    rnd = random.Random(1)
    vocab = ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 9))) for _ in range(500)]
    clean = [". ".join(" ".join(rnd.choice(vocab) for _ in range(12)) for _ in range(20)) + "." for _ in range(40)]
    noisy = ["BUY!! NOW!! 111 ### $$$ " * 60, "* | # " * 100, "12 34 56 78 " * 50]
    df = spark.createDataFrame([*enumerate(clean + noisy)], "doc_id long, text string")
    kept = {r.doc_id for r in rules.judge(df).where("kept").collect()}
    assert kept == set(range(40))
