"""Language identification by held-out accuracy, and mixtures by construction."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from ratingloom.llm import langid
from ratingloom.llm.queries import LLM_REGISTRY

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return langid.fit(documents)


def test_held_out_accuracy(spark, documents):
    known = {r.doc_id: r for r in documents.collect()}
    got = LLM_REGISTRY["op4_language"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == known[r.doc_id].lang for r in held]) > 0.97


def test_mixture_proportions(documents, model):
    of = {lang: " ".join(r.text for r in documents.where(f"lang = '{lang}'").limit(20).collect()) for lang in ("en", "de", "fr")}
    text = of["de"][:6000] + " " + of["fr"][:3000]
    (found,) = langid.infer([text], model)
    shares = dict(found)
    assert set(shares) == {"de", "fr"}
    assert abs(shares["de"] - 2 / 3) < 0.12 and abs(sum(shares.values()) - 1) < 1e-9


def test_trigrams_beside_a_plain_loop():
    texts = ["Ab c", None, "", "1é2", "  x\ny  "]
    owner, bucket, lettered = langid.trigrams(texts)
    assert lettered.tolist() == [True, False, False, True, True]
    assert np.bincount(owner, minlength=5).tolist() == [3, 0, 0, 1, 2]
    alone = [langid.trigrams([t]) for t in texts]
    assert np.concatenate([b for _, b, _ in alone]).tolist() == bucket.tolist()


def test_edges(spark, model):
    long = "the and " * 200_000
    rows = [(1, None, "en"), (2, "", None), (3, "123 !? \n", "de"), (None, "the of", "en"), (4, "ü", "de"), (4, "ü", "de"), (5, long, "en")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, languages string")
    got = {(r.doc_id, r.lang_pred): r for r in langid.identify(df, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= set(got) and (5, "en") in got
    assert got[(1, "und")].score == 0 and got[(1, "und")].languages == []
    assert langid.identify(df, model).count() == len(rows)
    assert langid.identify(df.limit(0), model).count() == 0
    nothing = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}
    one = langid.fit(df.where("lang = 'de'"))
    assert {r.lang_pred for r in langid.identify(df.where("doc_id = 4"), one).collect()} == {"de"}


def test_prediction_uses_the_text_only(spark, documents, model):
    sample = documents.where("doc_id < 50")
    plain = {r.doc_id: r.lang_pred for r in langid.identify(sample, model).collect()}
    other = sample.selectExpr("doc_id", "text", "'zz' as lang", "'s' as source")
    assert {r.doc_id: r.lang_pred for r in langid.identify(other, model).collect()} == plain


def own_mb():
    with open("/proc/self/smaps_rollup") as said:
        return sum(int(line.split()[1]) for line in said if line.startswith("Pss_Anon:")) / 1024


def test_tasks_give_their_memory_back():
    rnd = np.random.default_rng(5)
    words = ["".join(map(chr, rnd.integers(97, 123, 6))) for _ in range(3_000)]
    texts = [" ".join(rnd.choice(words, 1_000)) for _ in range(300)]
    batch = pa.RecordBatch.from_pydict({"lang": ["a"] * len(texts), "text": texts})
    before = own_mb()
    made = list(langid._count_trigrams(iter([batch] * 3)))
    assert own_mb() - before < 30
    assert {row["lang"] for b in made for row in b.to_pylist()} == {"a"}


def test_how_many_bytes_are_taken_at_once_decides_nothing(spark, documents, model, monkeypatch):
    def found():
        return sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.identify(documents, model).collect())

    few = found()
    monkeypatch.setattr(langid, "TAKEN_BYTES", 20_000_000)
    assert few == found()
    assert (langid.fit(documents).likelihood == model.likelihood).all()
