"""License scan beside plain loops."""

from __future__ import annotations

import re

from ratingloom.llm import licenses
from ratingloom.llm.queries import LLM_REGISTRY

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, labels int, score string"


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_base(text):
    words = words_of(text)
    places = []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


MIT = licenses.TEMPLATES[1].text
TEXTS = [
    "Released under the MIT License.", "x\nLicensed under the Apache License, Version 2.0.", "CC BY-NC 4.0 and cc by nc again",
    "This work is licensed under the GNU General Public License, version 3.", f"/* {MIT} */ code", "under the the mit license",
    MIT.replace("publish", "print out").replace("without limitation", "with no limit"), "the software of the rights to use", "",
    None, "UNDER THE MIT LICENSEÉ", "Mozilla Public License", "under the mit license " * 2000, "licensed under CC BY 4.0.",
    "Redistribution and use are fun", "gnu general public license, version 2 only", "licensed under cc by nc 4 0",
]


def scan(spark, texts):
    rows = [(i, t, 3, "s") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + [(None, "cc by nc", 3, "s")] * 2, SCHEMA).repartition(3)
    return licenses.scan_licenses(df).collect()


def test_base_labels_and_labels(spark):
    rows = scan(spark, TEXTS)
    assert sum(r.doc_id is None for r in rows) == 2
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    labels = [got[i].labels for i in range(len(TEXTS))]
    assert labels[:5] == ["mit", "apache-2", "cc-by-nc", "gpl-3", "mit"]
    assert labels[6:10] == ["mit", "", "", ""]
    assert labels[11] == "" and labels[13:15] == ["cc-by", ""] and labels[16] == "cc-by-nc"
    assert "gpl-3" not in labels[15]
    assert all(m.start < m.stop <= got[i].n_words for i in range(len(TEXTS)) for m in got[i].matches)


def test_empty_table(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_over_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = LLM_REGISTRY["op3_licenses"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == {i: brute_base(t) for i, t in texts.items()}
    assert {r.doc_id for r in got if "gpl-3" in r.labels} == {i for i, t in texts.items() if "gnu general public license version 3" in " ".join(words_of(t))}


def test_frequencies(spark):
    df = spark.createDataFrame([("MIT mit", 1), ("the mit", 2), (None, 3)], "text string, n int")
    got = {r.word: r.n_docs for r in licenses.document_frequencies(df, frozenset([b"mit", b"the", b"gone"])).collect()}
    assert got == {"mit": 2, "the": 1}
