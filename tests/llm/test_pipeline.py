"""Every stage beside plain Python on documents with planted cases."""

from __future__ import annotations

import random
import re

import pytest
import tiktoken

import corpus_pipeline
from ratingloom.llm import bpe, langid
from tests.llm.test_decontam import brute as brute_hits
from tests.llm.test_neardup import brute_classes
from tests.llm.test_substrings import brute as brute_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planted():
    rnd = random.Random(11)
    vocab = {"en": ["the", "and", "with", "thing", "reed", "whole"], "de": ["der", "und", "nicht", "schön", "über", "weiß"]}
    word = lambda lang: rnd.choice(vocab[lang]) + rnd.choice(["", "er", "en", str(rnd.randint(0, 99))])
    items = [(i, " ".join(word("en") for _ in range(20))) for i in range(5)]
    passage = " ".join(word("en") for _ in range(60))
    docs = []
    for i in range(60):
        lang = rnd.choice(["en", "de"])
        text = "\n".join(" ".join(word(lang) for _ in range(rnd.randint(5, 15))) for _ in range(rnd.randint(4, 12)))
        if i % 7 == 3:
            text += "\n" + passage
        if i % 11 == 5:
            text = items[i % 5][1] + "\n" + text
        docs.append((i, text, lang, f"s{i % 3}", len(text)))
    docs += [(100 + i, docs[i][1], *docs[i][2:]) for i in range(5)]
    docs += [(200 + i, docs[i + 10][1] + " end", *docs[i + 10][2:]) for i in range(5)]
    return docs + [(300, None, None, None, None), (301, "", "en", "s", 0), (302, "12 34 !", "de", "s", 7), (None, "the and " * 30, None, "s", 240)], items


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, items = planted()
    sf_dir = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    found, current = [docs], spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = f"{sf_dir}/{name}"
        stage(spark, current, sf_dir).write.parquet(path)
        current = spark.read.parquet(path)
        found.append([tuple(r) for r in current.collect()])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert current.columns == COLUMNS and dict(current.dtypes) == dict(spark.createDataFrame([], SCHEMA).dtypes)
    return found, items, sf_dir


def order(rows):
    return sorted(rows, key=str)


def test_language_drops_only_texts_without_letters(stages):
    before, after = stages[0][0], stages[0][1]
    kept = [r for r in before if r[1] and re.search(r"[^\W\d_]", r[1])]
    assert order((r[0], r[1]) for r in after) == order((r[0], r[1]) for r in kept)
    assert {r[2] for r in after} == {"en", "de"} and all(r[2] == s[2] for r in after for s in before if r[0] == s[0] is not None)


def test_near_duplicates_keep_one_of_each_class(stages):
    before, after = stages[0][1], stages[0][2]
    classes = brute_classes([(r[0], r[1]) for r in before])
    assert order(after) == order(r for r in before if r[0] is None or classes[r[0]] == r[0])
    assert len(after) < len(before)


def test_repeats(stages):
    before, after = stages[0][2], stages[0][3]
    expected = brute_repeats([(r[0], r[1]) for r in before], 13)
    assert order((r[0], " ".join(r[1].split())) for r in after) == order((i, kept) for i, _, _, kept in expected)
    assert any(n for _, _, n, _ in expected) and all(r[4] == len(r[1]) for r in after)
    untouched = {i for i, _, n, _ in expected if not n}
    assert {r for r in after if r[0] in untouched} == {r for r in before if r[0] in untouched}


def test_decontamination(stages):
    (before, after), items = stages[0][3:5], stages[1]
    bad = {r[0] for r in brute_hits([(r[0], r[1]) for r in before], items, 13) if r[5]}
    assert bad and order(after) == order(r for r in before if r[0] not in bad)


def test_encoding_and_run(spark, stages):
    before, after = stages[0][4], stages[0][5]
    ranks = bpe.read_ranks(corpus_pipeline.RANKS)
    reference = tiktoken.Encoding("own", pat_str=corpus_pipeline.public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = [(r[0], r[2], r[3], len(ids := reference.encode_ordinary(r[1])), ids, r[1]) for r in before]
    assert order(after) == order(expected)
    assert order(tuple(r) for r in corpus_pipeline.run(spark, stages[2]).collect()) == order(after)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_unknown_is_what_language_rejects():
    assert langid.infer(["123", None], langid.Model([], langid.np.zeros((langid.BUCKETS, 0)))) == [[], []]
