import numpy as np
import pytest
from pyspark.sql import functions as F

from aeris.llm import hard_negatives as module
from aeris.llm.hard_negatives import Block, coarser, filtered_search, hard_negatives, labelled_vectors, ranges, summaries

SCHEMA = "vec_id long, label int, vec array<long>"
IS_ANCHOR = F.col("vec_id") % 10 == 0


def brute(rows, every=10, n_positives=5, n_negatives=5):
    rows = sorted({(i, label, tuple(v)) for i, label, v in rows})
    anchors = {}
    for i, label, v in rows:
        if i % every == 0:
            anchors.setdefault(i, (label, v))
    out = []
    for a, (label, v) in anchors.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in rows if i != a and len(w) == len(v)]
        for s, i in sorted((s, i) for s, i, other in scored if other == label)[:n_positives]:
            fits = sorted((t, j) for t, j, other in scored if other != label and 80 * -s <= 100 * -t <= 100 * -s)
            out += [(a, i, r, j, -s, -t) for r, (t, j) in enumerate(fits[:n_negatives], 1)]
    return sorted(out)


def found(frame, **kwargs):
    return sorted(tuple(r) for r in hard_negatives(frame, IS_ANCHOR, **kwargs).collect())


@pytest.mark.parametrize("width", [1, 3, 16, 37, 64])
def test_summaries_bound_every_product(width):
    rng = np.random.default_rng(width)
    x, y = rng.integers(-300, 300, (50, width)), rng.integers(-300, 300, (60, width))
    exact = x @ y.T
    gap = []
    for level in (lambda z: coarser(*summaries(z), width), summaries):
        low, high = ranges(level(x), level(y), width)
        assert (low <= exact).all() and (exact <= high).all()
        gap.append((high - low).mean())
    assert gap[1] <= gap[0]


def test_filtered_search_leaves_out_no_answer():
    rng = np.random.default_rng(2)
    x = rng.integers(-20, 60, (500, 24))
    x[100:200] = x[100]
    ids, label = rng.permutation(500), rng.integers(0, 3, 500)
    block = Block(ids, label, x, *summaries(x))
    asked = block.take(np.arange(0, 500, 7))
    low, high = rng.integers(0, 4000, len(asked.ids)), rng.integers(4000, 12000, len(asked.ids))
    least = np.full(len(asked.ids), 2000)
    i, j, s = filtered_search(asked, block, False, low, high, least, 4)
    got = {}
    for q, r, score in zip(i, j, s):
        got.setdefault(int(q), []).append((-int(score), int(ids[r])))
    for q in range(len(asked.ids)):
        score = x @ asked.x[q]
        fits = (label != asked.label[q]) & (ids != asked.ids[q]) & (score >= max(low[q], least[q])) & (score <= high[q])
        assert got.get(q, []) == sorted((-int(score[r]), int(ids[r])) for r in np.flatnonzero(fits))[:4]


@pytest.mark.parametrize("block_rows", [25, 8192])
def test_query_against_brute_force(spark, monkeypatch, block_rows):
    """Two lengths, a hot vector, repeated rows, an id with two vectors, ties; many cells and blocks, and one."""
    monkeypatch.setattr(module, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(0)
    rows = [(int(i), int(rng.integers(0, 3)), [int(x) for x in rng.integers(-4, 5, rng.choice([3, 20]))]) for i in range(500)]
    rows += [(700 + i, 1, [2] * 20) for i in range(250)] + [(500, 2, [1] * 20), (500, 0, [3] * 20), rows[0], rows[10]]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(frame) == brute(rows)
    assert found(frame, positives=2, negatives=9) == brute(rows, n_positives=2, n_negatives=9)


def test_few_rows(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(10, 1, [1])], SCHEMA)) == []
    rows = [(10, 1, [3, 4]), (11, 1, [-3, -4]), (12, 2, [-3, -4])]
    assert found(spark.createDataFrame(rows, SCHEMA)) == []  # a negative score has no window
    rows = [(10, 1, [3, 4]), (11, 1, [-4, 3]), (12, 2, [4, -3]), (13, 2, [0, 0]), (14, 2, [0, 1])]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows) == [(10, 11, 1, 12, 0, 0), (10, 11, 2, 13, 0, 0)]


def test_rows_that_take_no_part(spark):
    good = [(i, [float(i % 5), 1.0, -0.5], i % 2, "s") for i in range(40)]
    bad = [(None, [1.0, 1.0, 1.0], 1, "s"), (50, None, 1, "s"), (60, [], 1, "s"), (70, [1.0, None, 1.0], 1, "s"), (80, [float("nan"), 1.0, 1.0], 1, "s"),
           (90, [float("-inf"), 1.0, 1.0], 1, "s"), (100, [9.0, 9.0, 9.0], None, "s")]
    frame = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>, label int, block string")
    vectors = labelled_vectors(frame, F.col("label"), 256)
    want = [(i, label, [int(np.floor(256 * x)) for x in v]) for i, v, label, _ in good]
    assert sorted((r.vec_id, r.label, r.vec) for r in vectors.collect()) == want
    assert found(vectors) == brute(want)
