"""Encoding beside tiktoken, decoding as a round trip, and section counts beside a plain loop."""

from __future__ import annotations

import gc
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratingloom.llm import bpe, tokencounts
from ratingloom.llm.queries import LLM_REGISTRY, RANKS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def table(ranks):
    return bpe.RankTable(ranks)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(table, texts):
    known = bpe.Pieces(public_tokenizers.PATTERN, table, lambda ids: ids)
    cuts = [bpe.cut_text(t) for t in texts]
    known.learn(set().union(*cuts))
    return [[i for piece in cut for i in known[piece]] for cut in cuts]


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("ab  \n\t'sé1٣!? \x1c\x85中😀,.Zz "), max_size=40), min_size=1, max_size=5))
def test_any_text(table, reference, texts):
    assert encode(table, texts) == [reference.encode_ordinary(t) for t in texts]


def test_long_words(table, reference, ranks):
    words = ["abcab" * 300, "thetionand" * 100 + "x", "é" * 1000, "a" * 49, "ab" * 24]
    assert encode(table, words) == [reference.encode_ordinary(w) for w in words]
    for word in words:
        assert bpe._merge_long(word.encode(), ranks) == reference.encode_ordinary(word)


def test_learning_walks_through_no_memory(table, reference):
    known = bpe.Pieces(public_tokenizers.PATTERN, table, lambda ids: ids)
    pieces, seen = {f"w{i:x}q,{i}" for i in range(20_000)}, []
    gc.collect()
    gc.callbacks.append(lambda phase, info: seen.append(phase))
    try:
        known.learn(pieces)
        collected = seen.count("start")
    finally:
        gc.callbacks.pop()
    assert collected <= 1 and gc.isenabled()  # one may follow at the end
    assert all(known[p] == reference.encode_ordinary(" " + p) for p in pieces)


def test_pieces_of_one_word_are_kept_once(table):
    known = bpe.Pieces(public_tokenizers.PATTERN, table, lambda ids: (len(ids), ids), joined=lambda parts: (sum(n for n, _ in parts), None))
    known.learn({"eauouon", "eauouon,"})
    assert known["eauouon"] is known.words[" eauouon"]
    assert known["eauouon,"][0] == known["eauouon"][0] + 1


def test_query(spark, reference):
    got = {r.doc_id: r for r in LLM_REGISTRY["op8_byte_bpe"](spark, SF_DIR).collect()}
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for doc in texts:
        ids = reference.encode_ordinary(doc.text)
        row = got[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()


def test_digests_of_texts_that_begin_with_a_space(spark, reference):
    texts = [" 1", "  two", " a b", "\n c", " "]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.ids_sha256 for r in bpe.encode_digests(df, RANKS, public_tokenizers.PATTERN).collect()}
    ids = [",".join(map(str, reference.encode_ordinary(t))) for t in texts]
    assert got == {i: hashlib.sha256(x.encode()).hexdigest() for i, x in enumerate(ids)}


EDGES = [(1, None), (2, ""), (None, "a b"), (3, "x" * 50_000 + " y"), (4, "one two"), (4, "one two"), (5, " \n ")]


def test_edges(spark, reference):
    df = spark.createDataFrame([(i, t, 7) for i, t in EDGES], "doc_id long, text string, n_tokens int")
    rows = bpe.encode_digests(df, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r.n_tokens, r.doc_id or 0) for r in rows) == sorted((len(reference.encode_ordinary(t or "")), i or 0) for i, t in EDGES)
    ids = bpe.encode_texts(df, RANKS, public_tokenizers.PATTERN, carry=("n_tokens",)).collect()
    assert sorted(r.ids for r in ids) == sorted(reference.encode_ordinary(t or "") for _, t in EDGES)
    assert sorted(r.decoded for r in ids) == sorted(t or "" for _, t in EDGES)
    assert {r.n_tokens for r in ids} == {7}
    assert bpe.encode_digests(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def brute_sections(reference, text, rule):
    spans, at = [], 0
    for token in reference.encode_ordinary(text):
        size = len(reference.decode_single_token_bytes(token))
        spans.append((at, at + size))
        at += size
    lines, at = [], 0
    for line in text.encode().splitlines(keepends=True) if "\r" not in text else []:
        lines.append((at, at + len(line)))
        at += len(line)
    counts, crossing = [0] * len(lines), [0] * len(lines)
    for start, stop in spans:
        shares = [max(0, min(stop, b) - max(start, a)) for a, b in lines]
        touched = [i for i, s in enumerate(shares) if s]
        owner = {"first": touched[0], "last": touched[-1], "most": max(touched, key=lambda i: (shares[i], -i))}[rule]
        counts[owner] += 1
        crossing[owner] += len(touched) > 1
    chars = [(len(text.encode()[:a].decode()), len(text.encode()[:b].decode())) for a, b in lines]
    return [(i, *c, n, x) for i, (c, n, x) in enumerate(zip(chars, counts, crossing))]


@pytest.mark.parametrize("rule", tokencounts.RULES)
def test_sections(spark, rule):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    reference = tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    texts = ["a b\n\n  c é\nd", "one\n\n\n\ntwo\n   three", "\n", "no line", "é\n中中 x\n\n\n  \n\ny"]
    df = spark.createDataFrame([*enumerate(texts), (90, None), (91, "")], "doc_id long, text string")
    got = tokencounts.section_token_counts(df, path, public_tokenizers.PATTERN, rule).collect()
    expected = [(i, *row) for i, t in enumerate(texts) for row in brute_sections(reference, t, rule)]
    assert sorted(tuple(r) for r in got) == sorted(expected)
    assert any(r.n_crossing for r in got)


def test_sections_given_by_spans():
    starts, stops = np.array([0, 3, 5, 9]), np.array([3, 5, 9, 12])
    owner, crosses = tokencounts.attribute(starts, stops, np.array([[0, 4], [6, 8]]), "most")
    assert owner.tolist() == [0, 0, 1, -1] and crosses.tolist() == [False, True, True, False]
    with pytest.raises(ValueError):
        tokencounts.section_token_counts(None, RANKS, public_tokenizers.PATTERN, "half")


def test_section_query_covers_all_tokens(spark):
    whole = {r.doc_id: r.n_tokens for r in LLM_REGISTRY["op8_byte_bpe"](spark, SF_DIR).collect()}
    parts = LLM_REGISTRY["op5_section_tokens"](spark, SF_DIR).groupBy("doc_id").sum("n_tokens").collect()
    assert {r[0]: r[1] for r in parts} == {k: v for k, v in whole.items() if v}


def test_merges_as_a_built_in_expression(spark, ranks):
    words = ["", "a", " the", "thetionand", " Eauouon", "abcab" * 9, "é", "中文", " 123", "\n\n", "ndstonti"]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "word string").repartition(2)
    got = {r.word: r.ids for r in df.select("word", bpe.merge_expression(F.col("word"), ranks).alias("ids")).collect()}
    assert got == {None: []} | {w: bpe.merge_word(w.encode(), ranks) if w else [] for w in words}
