"""Code lengths against the recursion written out, and held-out accuracy."""

import math

import numpy as np
import pytest

from kerbside.llm import language_id as li


def literal_bits(texts, text):
    """Bits of ``text`` after counting ``texts``, by the recursion byte by byte."""
    counts = {}
    for t in texts:
        data = b"\n" * li.ORDER + t
        for i in range(li.ORDER, len(data)):
            for k in range(li.ORDER + 1):
                own = counts.setdefault(data[i - k:i], {})
                own[data[i]] = own.get(data[i], 0) + 1
    total, data = 0.0, b"\n" * li.ORDER + text
    for i in range(li.ORDER, len(data)):
        for k in range(li.ORDER, -2, -1):
            if k < 0:
                total += 8
                break
            own = counts.get(data[i - k:i])
            if own is None:
                continue
            n, d = sum(own.values()), len(own)
            if data[i] in own:
                total -= math.log2(own[data[i]] / (n + d))
                break
            total -= math.log2(d / (n + d))
    return total


TEXTS = {"en": ["the thing that there is", "other than the one", "wh th a", ""], "de": ["über die straße und das", "nicht der und die"], "x": ["q"]}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, own in TEXTS.items() for t in own)] + [(90, None, "en"), (91, "none", None)]
    return li.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_code_lengths_equal_the_recursion(model, monkeypatch):
    probes = [t.encode() for t in ["the thing", "über und nicht", "zzz §", "q", "", "a" * 100, "thq die\n\n" * 20]]
    want = [[literal_bits([t.encode() for t in TEXTS[lang]], p) for lang in model.languages] for p in probes]
    assert np.allclose(li.code_lengths(model, probes), want, rtol=1e-5, atol=1e-4)
    monkeypatch.setattr(li, "_CHUNK", 7)
    assert np.allclose(li.code_lengths(model, probes), want, rtol=1e-5, atol=1e-4)


def test_rows(spark, model):
    rows = [(1, None, 5), (2, "", 5), (3, "123 !!", 5), (4, "the other thing", 5), (4, "the other thing", 5), (None, "und die straße", 5), (5, "über " * 40_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = sorted(map(tuple, li.predict(docs, model).select("doc_id", "lang_pred").collect()), key=repr)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "de"), (5, "de")], key=repr)
    assert all(0 <= r.score <= 1 for r in li.predict(docs, model).collect())
    found = li.with_language(docs, model)
    assert found.columns == ["doc_id", "text", "score", "lang_pred", "score_"] and {r.score for r in found.collect()} == {5}
    moved = docs.selectExpr("text AS body", "score AS text", "doc_id AS Lang_Pred")
    found = li.with_language(moved, model, "body")
    assert found.columns == ["body", "text", "Lang_Pred", "lang_pred_", "score"]
    assert sorted(r.lang_pred_ for r in found.collect()) == sorted(lang for _, lang in got)
    nothing = li.fit(docs.withColumn("lang", docs.text).filter("false"))
    assert {r.lang_pred for r in li.predict(docs, nothing).collect()} == {"und"}
    assert li.predict(docs.filter("false"), model).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fold = li.held_out(docs.doc_id)
    found = li.predict(docs, li.fit(docs.filter(~fold))).join(docs.filter(fold).select("doc_id", "lang"), "doc_id")
    rows = found.filter("lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
