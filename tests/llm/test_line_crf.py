import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from aeris.llm.catalog import op7_line_crf
from aeris.llm.line_crf import chain_marginals, fit, line_features, score_documents, train


def test_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    first = np.array([0, 1, 1, 6, 9])
    score, move = rng.normal(size=9), rng.normal(size=(2, 2))
    good, pairs, log_z = chain_marginals(score, first, move)
    for i in range(4):
        own = score[first[i] : first[i + 1]]
        n = len(own)
        if not n:
            assert log_z[i] == 0 and not pairs[i].any()
            continue
        weight = {y: np.exp(sum(s for s, a in zip(own, y) if a) + sum(move[a, b] for a, b in zip(y, y[1:]))) for y in itertools.product((0, 1), repeat=n)}
        z = sum(weight.values())
        assert np.isclose(log_z[i], np.log(z))
        assert np.allclose(good[first[i] : first[i + 1]], [sum(w for y, w in weight.items() if y[t]) / z for t in range(n)])
        assert np.allclose(pairs[i], [[sum(w * sum(p == (a, b) for p in zip(y, y[1:])) for y, w in weight.items()) / z for b in (0, 1)] for a in (0, 1)])


def test_lines_of_odd_texts():
    texts = pa.array([None, "", " \n\t\n", "one", "a b\n\n c d \n\na b", "x" * 100_000, "\n" * 1000 + "é"])
    lines = line_features(texts)
    assert np.diff(lines.first).tolist() == [0, 0, 0, 1, 3, 1, 1] and np.isfinite(lines.features).all()
    assert lines.length[0] == 4


def test_features_do_not_depend_on_the_batch():
    texts = ["Good line here.\nANOTHER!! ONE!!\nGood line here.", "x | y | z", "alone"]
    whole = line_features(pa.array(texts))
    single = [line_features(pa.array([t])) for t in texts]
    assert np.allclose(whole.features, np.concatenate([s.features for s in single]))


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [(r.predicted, marks[r.doc_id]) for r in op7_line_crf(spark, sf).collect() if r.held_out and r.doc_id in marks]
    assert sum(a == b for a, b in out) >= 0.95 * len(out) and len(out) > 50


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (4, 1), (6, 0), (9, 1), (None, 0), (3, None), (0, 1), (77, 0), (5, 7)], "doc_id long, quality int")
    model = train(odd_docs, labels)
    out = score_documents(odd_docs, model)
    assert out.count() == odd_docs.count()
    for r in out.collect():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.text is not None and r.text.strip(" \t\n\x0b\x0c\r") or r.score == 0
    assert train(odd_docs, labels.where("quality = 1")) is None and train(no_docs, labels) is None
    assert {r.score for r in score_documents(odd_docs, None).collect()} == {0.0, 0.5}
    assert score_documents(no_docs, model).count() == 0


def test_training_order_does_not_matter(spark):
    rows = [(i, ("A fine line of prose.\n" if i % 3 else "BUY!! NOW!! ### |\n") * (1 + i % 4) + f"word{i}", int(i % 3 > 0)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    a, b = (train(d, docs.select("doc_id", F.col("quality")), per_label=10) for d in (docs, docs.repartition(5)))
    assert np.allclose(a.weights, b.weights)


def test_texts_stay_off_the_driver(spark, monkeypatch):
    rows = [(i, ("A fine line of prose.\n" if i % 3 else "BUY!! NOW!! ### |\n") * (1 + i % 4) + f"word{i}", int(i % 3 > 0)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    for name in ("toArrow", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(type(docs), name, lambda *a, **b: (_ for _ in ()).throw(AssertionError("texts on the driver")))
    model = train(docs, docs.select("doc_id", "quality"))
    lines = line_features(pa.array([t for _, t, _ in rows]))
    here = fit(lines, np.array([q for *_, q in rows]), np.ones(len(rows)))
    assert all(np.allclose(a, b, atol=1e-6) and a.dtype == b.dtype and a.shape == b.shape for a, b in zip(model, here))
