import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeris.llm import hmm
from aeris.llm.common import fold
from aeris.llm.hmm import Model, estimate, language_model_scores, log10_likelihood, no_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def a_model(rng, symbols=30, k=3):
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    return Model(norm(rng.random(k), 0), norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((symbols, k)), 0))


def forward_backward(s, m):
    alpha, beta = np.zeros((len(s), 3)), np.ones((len(s), 3))
    alpha[0] = m.start * m.emit[s[0]]
    for t in range(1, len(s)):
        alpha[t] = alpha[t - 1] @ m.move * m.emit[s[t]]
    for t in range(len(s) - 2, -1, -1):
        beta[t] = m.move @ (m.emit[s[t + 1]] * beta[t + 1])
    z = alpha[-1].sum()
    moves = sum((np.outer(alpha[t], m.emit[s[t + 1]] * beta[t + 1]) * m.move / z for t in range(len(s) - 1)), np.zeros((3, 3)))
    return alpha * beta / z, moves, math.log10(z)


def test_recursions_against_brute_force():
    rng = np.random.default_rng(0)
    m = a_model(rng)
    texts = [rng.integers(0, 30, n).astype(np.uint16) for n in (1, 5, 40, 2, 90, 5)]
    found = [forward_backward(s, m) for s in texts]
    assert np.allclose(log10_likelihood(texts, m), [f[2] for f in found])
    c = hmm.whole_counts(texts, m)[0]
    emit = np.zeros((30, 3))
    for s, f in zip(texts, found):
        np.add.at(emit, s, f[0])
    assert np.allclose(c.emit, emit) and np.allclose(c.move, sum(f[1] for f in found)) and np.allclose(c.start, sum(f[0][0] for f in found))
    long = rng.integers(0, 30, 20_000).astype(np.uint16)
    assert np.isfinite(log10_likelihood([long], m)).all() and log10_likelihood([long], m)[0] < -20_000
    assert log10_likelihood([], m).shape == (0,)


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(1)
    texts = [rng.integers(15 * (i % 2), 15 * (i % 2) + 15, 60).astype(np.uint16) for i in range(80)]
    m = a_model(rng)
    scores = []
    for _ in range(6):
        scores.append(log10_likelihood(texts, m).sum())
        m = estimate(hmm.whole_counts(texts, m)[0], np.full(30, 1 / 30))
    assert all(b > a for a, b in zip(scores[1:], scores[2:])) and scores[-1] > scores[0] + 100
    assert np.allclose(estimate(no_counts(30, 3), np.full(30, 1 / 30)).emit, 1 / 30)


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    f = fold(F.col("doc_id"))
    return docs.collect(), {r.doc_id: r for r in language_model_scores(docs, f != 1, f == 1, n_frequent=500).collect()}


def test_base_score_and_counts_against_brute_force(scored):
    docs, got = scored
    tokens = {d.doc_id: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), d.text or "")) + [None] for d in docs}
    fold_of = {i: zlib.crc32(str(i).encode()) % 5 for i in tokens}
    c = Counter(t for i, own in tokens.items() if fold_of[i] != 1 for t in own)
    n, v = sum(c.values()), len(c)
    for i, own in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold_of[i] == 1, len(own), sum(c[t] > 0 for t in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own), rel=1e-9)


def test_score_against_brute_force(spark, monkeypatch):
    """The returned score, text by text: a plain forward product over symbols, and every rare word's share of its class."""
    made = []
    train = hmm.trained
    monkeypatch.setattr(hmm, "trained", lambda encoded, voc, *args: made.append((voc, train(encoded, voc, *args))) or made[-1][1])
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    f = fold(F.col("doc_id"))
    got = {r.doc_id: r.score for r in language_model_scores(docs, f != 1, f == 1, states=3, n_frequent=300).collect()}
    voc, model = made[0]
    tokens = {d.doc_id: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), d.text or "")) for d in docs.collect()}
    every = sorted({t for own in tokens.values() for t in own})
    w = hmm.words(hmm.pa.array(every))
    assert len(w.hash) == len(every)
    hashes, kinds = dict(zip(every, w.hash.tolist())), dict(zip(every, hmm.word_class(w).tolist()))
    c = Counter(t for i, own in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for t in own)
    signed = lambda h: h - 2**64 if h >= 2**63 else h
    frequent = sorted(sorted(c, key=lambda t: (-c[t], signed(hashes[t])))[:300], key=lambda t: hashes[t])
    symbol = {t: i for i, t in enumerate(frequent)}
    words_of, total_of = Counter(kinds[t] for t in c if t not in symbol), Counter()
    for t in c:
        if t not in symbol:
            total_of[kinds[t]] += c[t]
    for i, own in tokens.items():
        a, score = None, 0.0
        for s in [symbol.get(t, 300 + kinds.get(t, 0)) for t in own] + [voc.symbols - 1]:
            a = (model.start if a is None else [sum(a[j] * model.move[j, k] for j in range(3)) for k in range(3)]) * model.emit[s]
            score += math.log10(a.sum())
            a = a / a.sum()
        score += sum(math.log10((c[t] + 0.5) / (total_of[kinds[t]] + 0.5 * (words_of[kinds[t]] + 1))) for t in own if t not in symbol)
        assert got[i] == pytest.approx(score, rel=1e-9)


def test_model_beats_the_base_on_held_out_texts(scored):
    held = [r for r in scored[1].values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(math.isfinite(r.score) for r in held)


def test_odd_rows(spark, odd_docs, no_docs):
    f = fold(F.col("doc_id"))
    out = language_model_scores(odd_docs, f != 1, f == 1, states=2, n_frequent=50).collect()
    assert len(out) == odd_docs.count() and all(math.isfinite(r.score) and r.n_tokens >= 1 for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (0, 1, 2)} == {1} and not any(r.held_out for r in out if r.doc_id is None)
    untrained = language_model_scores(odd_docs, F.lit(False), F.lit(True), states=2).collect()
    assert {(r.n_known, r.train_tokens) for r in untrained} == {(0, 0)}
    assert language_model_scores(no_docs, f != 1, f == 1, states=2).count() == 0
    with pytest.raises(ValueError):
        language_model_scores(no_docs, f != 1, f == 1, n_frequent=1 << 16)


def test_whole_texts_keep_their_state(monkeypatch):
    rng = np.random.default_rng(3)
    m = a_model(rng)
    texts = [rng.integers(0, 30, n).astype(np.uint16) for n in (180, 1, 70, 130, 40)]
    found = [forward_backward(s, m) for s in texts]
    for at_once in (1 << 18, 150, 30):  # the longest texts in one block, then in several
        monkeypatch.setattr(hmm, "TOKENS", at_once)
        c, likelihood = hmm.whole_counts(texts, m)
        assert np.allclose(c.move, sum(f[1] for f in found)) and np.allclose(c.start, sum(f[0][0] for f in found))
        assert np.allclose(c.share, sum(f[0].sum(0) for f in found)) and math.isclose(likelihood, sum(f[2] for f in found) * math.log(10))


def test_states_come_from_all_training_texts_until_settled(spark):
    """A kind of text found in 4 of 2,604 texts gets a state of its own, and a further round gains next to nothing."""
    rng = np.random.default_rng(4)
    common = [" ".join(f"a{i}" for i in rng.integers(0, 40, 12)) for _ in range(2600)]
    rare = [" ".join(f"b{i}" for i in rng.integers(0, 40, 400)) for _ in range(4)]
    docs = spark.createDataFrame(list(enumerate(common + rare)), "doc_id long, text string")
    voc = hmm.vocabulary(hmm.word_counts(docs), 100)
    encoded = hmm._sliced(hmm.encode(docs, voc, F.lit(True), F.lit(False)))
    model = hmm.trained(encoded, voc, 2, hmm.SETTLED)
    counts, before = hmm.corpus_counts(encoded, model)
    assert hmm.corpus_counts(encoded, hmm.estimate(counts, voc.shares()))[1] - before <= 2 * hmm.SETTLED * abs(before)
    of = lambda kind: set(np.searchsorted(voc.hashes, hmm.words(hmm.pa.array([" ".join(f"{kind}{i}" for i in range(40))])).hash))
    best = model.emit.argmax(1)
    assert {best[i] for i in of("a")} != {best[i] for i in of("b")} and len({best[i] for i in of("b")}) == 1
