import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aeris.llm.cover_tree import Tree, dual_search, top_k

NONE = np.iinfo(np.int64).min


def brute(q_ids, q, ids, x, k):
    score = q @ x.T
    score[q_ids[:, None] == ids[None]] = NONE
    order = np.lexsort((np.broadcast_to(ids, score.shape), ~score), axis=1)[:, :k]
    best = np.take_along_axis(score, order, 1)
    return [[(int(i), int(s)) for i, s in zip(ids[o], b) if s != NONE] for o, b in zip(order, best)]


@pytest.mark.parametrize("n, m, d, k", [(3000, 200, 8, 5), (2500, 300, 2, 3), (40, 40, 4, 60), (1, 1, 3, 5)])
def test_dual_search_against_brute_force(n, m, d, k):
    rng = np.random.default_rng(n)
    x = np.floor(256 * rng.normal(size=(n, d)) * 0.3).astype(np.int64)
    x[: n // 3] = x[0]  # many ties
    ids = rng.permutation(n) * 7
    pick = rng.choice(n, m, replace=False)
    best, where = dual_search(ids[pick], x[pick], ids, x, k, np.full(m, -np.inf))
    got = [[(int(ids[w]), int(s)) for w, s in zip(ws, ss) if w >= 0] for ws, ss in zip(where, best)]
    assert got == brute(ids[pick], x[pick], ids, x, k)


def test_tree_covers_its_points():
    x = np.random.default_rng(0).normal(size=(3000, 5))
    t = Tree(x)
    assert sorted(t.order.tolist()) == list(range(3000))
    for i in range(len(t.lo)):
        own = x[t.order[t.lo[i] : t.hi[i]]]
        assert np.sqrt(((own - t.centres[i]) ** 2).sum(1)).max() <= t.radii[i] + 1e-9
        if len(t.children[i]) > 1:
            c = t.centres[t.children[i]]
            gaps = np.sqrt(((c[:, None] - c[None]) ** 2).sum(2)) + 1e9 * np.eye(len(c))
            assert gaps.min() >= max(t.radii[t.children[i]]) - 1e-9


def test_query_with_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist(), 0) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0], None) for i in range(200)]  # a hot vector
    bad = [(None, [1.0] * 4, 1), (400, None, 1), (450, [], 1), (500, [1.0, None, 2.0, 3.0], 1), (550, [float("nan")] * 4, 1), (600, [float("inf"), 0.0, 0.0, 0.0], 1), (650, [1.0, 2.0], 1)]
    frame = spark.createDataFrame(rows + [rows[0], rows[0]] + bad, "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in top_k(frame, F.col("vec_id") % 50 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    ids = np.array([r[0] for r in rows])
    x = np.array([np.floor(256 * np.array(r[1], np.float32).astype(float)) for r in rows]).astype(np.int64)
    pick = np.flatnonzero(ids % 50 == 0)
    assert got == dict(zip(ids[pick].tolist(), brute(ids[pick], x[pick], ids, x, 5)))
    more = [(i, rng.normal(size=7).tolist(), 0) for i in range(2000, 2300)]  # a second length is a search of its own
    both = {}
    for r in top_k(frame.union(spark.createDataFrame(more, frame.schema)), F.col("vec_id") % 50 == 0, k=5).orderBy("query_id", "rank").collect():
        both.setdefault(r.query_id, []).append((r.vec_id, r.score))
    y = np.array([np.floor(256 * np.array(r[1], np.float32).astype(float)) for r in more]).astype(np.int64)
    own = np.array([r[0] for r in more])
    at = np.flatnonzero(own % 50 == 0)
    assert both == got | dict(zip(own[at].tolist(), brute(own[at], y[at], own, y, 5)))
    assert top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0], 1), (50, [2.0], 1)], "vec_id long, embedding array<float>, rank int")
    assert [(r.query_id, r.vec_id, r.score) for r in top_k(two, F.col("vec_id") % 50 == 0).orderBy("query_id").collect()] == [(0, 50, 256 * 512), (50, 0, 256 * 512)]


def test_blocks_are_sent_once_for_each_part_of_their_queries(spark, monkeypatch):
    """The rows sent to searches grow with the queries routed to their block, not with all queries."""
    from aeris.llm import tiles
    monkeypatch.setattr(tiles, "QUERY_ROWS", 10)
    asking = spark.createDataFrame([(i, 0 if i < 45 else 1) for i in range(50)], "vec_id long, block int")
    rows = spark.createDataFrame([(1000 + i, i % 3) for i in range(30)], "vec_id long, block int")
    met = tiles.searched(asking, rows, lambda q, x: pa.table({"q": pa.array([q.num_rows]), "x": pa.array([x.num_rows])}), "q long, x long").collect()
    assert sum(r.q for r in met) == 50 and all(r.x in (0, 10) for r in met)
    assert len(met) <= 6  # five parts of block 0 and one of block 1; nobody asks block 2
