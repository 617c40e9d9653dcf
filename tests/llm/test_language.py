from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeris.llm import language
from aeris.llm.catalog import op9_rank_order_language
from aeris.llm.language import gram_text, learn_profiles, predict_languages, text_counts


def grams(text):
    out = Counter()
    for w in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        padded = f"_{w}_"
        out.update(w)
        for n in (2, 3):
            out.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return out


@pytest.mark.parametrize("chunk", [1 << 20, 40])
def test_ngrams_against_brute_force(monkeypatch, chunk):
    monkeypatch.setattr(language, "CHUNK", chunk)
    texts = ["Hello the a b. Éa ça", "", None, "123", "a", "déjà vu, DÉJÀ! x", "漢字 \U00020000 ß", "word " * 30 + "é " * 7]
    seen = set()
    for row, codes, counts, g in text_counts(texts):
        codes = codes if g is None else g.codes(codes)
        assert np.all(np.diff(codes) > 0)
        assert {gram_text(int(c)): int(n) for c, n in zip(codes, counts)} == grams(texts[row])
        seen.add(row)
    assert seen == {i for i, t in enumerate(texts) if t}


def test_profiles_and_distance_against_brute_force(spark):
    rows = [("en", "the cat and the dog"), ("en", "that is the hat"), ("de", "der hund und die katze"), ("de", None), (None, "ignored text"), ("zz", "123")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = learn_profiles(docs, 20)
    expected = {}
    for lang in ("de", "en"):
        total = sum((grams(t) for own, t in rows if own == lang and t), Counter())
        key = lambda x: (-total[x], len(x), [0 if c == "_" else ord(c) for c in x])
        expected[lang] = sorted(total, key=key)[:20]
    assert {lang: [gram_text(int(c)) for c in p] for lang, p in got.items()} == expected
    text = "the hund"
    own = grams(text)
    ranked = sorted(own, key=lambda x: (-own[x], len(x), [0 if c == "_" else ord(c) for c in x]))
    far = {lang: sum(abs(p.index(x) - i) if x in p else 20 for i, x in enumerate(ranked)) / (20 * len(ranked)) for lang, p in expected.items()}
    r = predict_languages(spark.createDataFrame([(text, 1)], "text string, score int"), got).first()
    best = min(sorted(far), key=far.get)
    assert r.lang_pred == best and r.score == pytest.approx(1 - far[best])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    out = [r for r in op9_rank_order_language(spark, sf).collect() if r.held_out]
    assert len(out) > 150 and sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.99 * len(out)


def test_odd_rows(odd_docs, no_docs):
    profiles = learn_profiles(odd_docs.where(F.col("lang").isNotNull()))
    out = predict_languages(odd_docs, profiles)
    assert out.count() == odd_docs.count() and out.columns == [c for c in odd_docs.columns if c != "score"] + ["lang_pred", "score"]
    for r in out.collect():
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert {r.lang_pred for r in predict_languages(odd_docs, {}).collect()} == {"und"}
    assert learn_profiles(no_docs) == {} and predict_languages(no_docs, profiles).count() == 0
