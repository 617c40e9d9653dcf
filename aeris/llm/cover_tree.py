"""Exact top-k by inner product: dual-tree search over cover trees.

Vectors are integer (component x becomes floor(scale * x)). Rows are dealt to cells, the Voronoi cells of
a bounded sample of pivots, the top level of the trees; a cell with many rows is dealt on into
blocks of bounded size. Queries travel to blocks and are searched there block by block:

* each block of rows and each group of queries is indexed by a cover tree: a node's centres are
  picked farthest first, so that the centres are farther apart than any of its points is from its centre, and every
  child holds the points nearest its centre, with its covering radius;
* for a query node (centre p, radius s) and a row node (centre c, radius r) no inner product exceeds
  <p, c> + |p| r + |c| s + r s. A pair of nodes whose bound is below the worst kth score of the
  queries in the node is pruned; equal scores are not, ties go to the smaller id.

First each query searches its own block, which gives it a first kth score. Then it goes to all
blocks of the cells that its bound doesn't rule out. Of rows with equal vectors only the ``k + 1`` smallest ids can be in
any answer (one may be the query's own), so the others are left out before the deal; a vector
that a third of the rows share costs no more than any other.

Of a cover tree's invariants the trees keep covering (a node's radius reaches all its points) and separation (the centres of a node's
children are farther apart than any child's radius). They don't keep nesting: the root's centre is a mean, and a child
needn't have its parent's centre; so there is no scale for each level. The bounds need covering only.

What is shuffled: every row once, to its block, and a block once more for each ``QUERY_ROWS`` queries whose bounds reach it.
Driver and broadcast hold pivots and cell radii only: ``MAX_CELLS`` vectors at most, for each length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeris.llm.common import written
from aeris.llm.tiles import searched

MAX_CELLS = 256
CELL_ROWS = 4096  # about so many rows a cell, while there are fewer than MAX_CELLS
BLOCK_ROWS = 8192
FANOUT = 16
LEAF = 256


class Tree:
    """Cover tree over the rows of ``x``: ``order`` lists rows so that every node is a range
    ``lo:hi`` of it; node 0 is the root; ``children[i]`` are node numbers (none: a leaf)."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.lo, self.hi, self.children = [0], [len(x)], [[]]
        self.centre = [x.mean(0)]
        self.radius = [float(np.sqrt(((x - self.centre[0]) ** 2).sum(1).max()))]
        todo = [0]
        while todo:
            node = todo.pop()
            lo, hi = self.lo[node], self.hi[node]
            if hi - lo <= LEAF or self.radius[node] == 0:
                continue
            rows = self.order[lo:hi]
            own = x[rows]
            nearest = ((own - own[0]) ** 2).sum(1)
            owner, picked = np.zeros(len(rows), np.int64), [0]
            while len(picked) < FANOUT:
                far = int(nearest.argmax())
                if nearest[far] == 0:
                    break
                gap = ((own - own[far]) ** 2).sum(1)
                closer = gap < nearest
                owner[closer], nearest = len(picked), np.minimum(nearest, gap)
                picked.append(far)
            by_owner = np.argsort(owner, kind="stable")
            self.order[lo:hi] = rows[by_owner]
            cuts = lo + np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(picked)))))
            for j, p in enumerate(picked):
                a, b = int(cuts[j]), int(cuts[j + 1])
                child = len(self.lo)
                self.lo.append(a)
                self.hi.append(b)
                self.children.append([])
                self.centre.append(own[p])
                self.radius.append(float(np.sqrt(nearest[owner == j].max())))
                self.children[node].append(child)
                todo.append(child)
        self.centres = np.array(self.centre)
        self.radii = np.array(self.radius)
        self.norms = np.sqrt((self.centres**2).sum(1))


def bounds(tree: Tree, nodes: list[int], other: Tree, others: list[int]) -> np.ndarray:
    """Upper bounds of the inner products of all pairs of nodes (a little above them, for rounding)."""
    r, s = tree.radii[nodes][:, None], other.radii[others][None]
    n, m = tree.norms[nodes][:, None], other.norms[others][None]
    b = tree.centres[nodes] @ other.centres[others].T + n * s + m * r + r * s
    return b + 1e-6 * (1 + np.abs(b))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors (in doubles where those are exact)."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def dual_search(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int,
                worst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores and row numbers (-1: none) of the k best rows for each query, by score, then id; rows
    that score below ``worst`` (each query's kth score so far) may be missing."""
    by_id = np.argsort(ids, kind="stable")
    ids, x = ids[by_id], x[by_id]
    best = np.full((len(q), k), np.iinfo(np.int64).min)
    where = np.full((len(q), k), -1)
    worst = worst.astype(float).copy()
    qt, xt = Tree(q.astype(float)), Tree(x.astype(float))
    todo = [(0, [0])]
    while todo:
        node, others = todo.pop()
        rows = qt.order[qt.lo[node] : qt.hi[node]]
        open_ = bounds(qt, [node], xt, others)[0] >= worst[rows].min()
        others = [o for o, ok in zip(others, open_) if ok]
        if not others:
            continue
        finer = [c for o in others for c in (xt.children[o] or [o])]
        if qt.children[node]:
            todo.extend((child, finer) for child in qt.children[node])
            continue
        while any(xt.children[o] for o in finer):  # a leaf of queries goes down the row tree alone
            ok = bounds(qt, [node], xt, finer)[0] >= worst[rows].min()
            finer = [c for o, keep in zip(finer, ok) if keep for c in (xt.children[o] or [o])]
        high = bounds(qt, [node], xt, finer)[0]
        for j in np.argsort(-high, kind="stable"):
            if high[j] < worst[rows].min():
                break
            at = np.sort(xt.order[xt.lo[finer[j]] : xt.hi[finer[j]]])
            score = products(q[rows], x[at])
            score[q_ids[rows][:, None] == ids[at][None]] = np.iinfo(np.int64).min
            better = score.max(1) >= best[rows, -1]  # an equal score may have a smaller id
            if not better.any():
                continue
            gain, score = rows[better], score[better]
            merged = np.concatenate([best[gain], score], 1)
            source = np.concatenate([where[gain], np.broadcast_to(at, score.shape)], 1)
            source = np.where(merged == np.iinfo(np.int64).min, -1, source)
            rank = np.lexsort((source, ~merged), axis=1)[:, :k]
            best[gain] = np.take_along_axis(merged, rank, 1)
            where[gain] = np.take_along_axis(source, rank, 1)
            worst[gain] = np.maximum(worst[gain], np.where(where[gain, -1] >= 0, best[gain, -1], -np.inf))
    return best, np.where(where >= 0, by_id[where], -1)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(-1, width)


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gap = (x.astype(float) ** 2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1)
    cell = gap.argmin(1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))


def integer_vectors(rows: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """``vec_id, vec`` with integer components; rows without an id or vector, with an empty one or
    with a component that is null or not finite are left out. Ids are cast to long."""
    ok = F.expr(f"size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return rows.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & F.coalesce(ok, F.lit(False))).select(
        F.col(id_column).cast("long").alias("vec_id"), F.expr(f"transform({vector}, x -> cast(floor({scale} * cast(x as double)) as bigint))").alias("vec"))


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest integer inner product for each query, the row
    ``rank`` 1 first, ties to the smaller id; all other rows where there are fewer than ``k``.

    ``is_query`` is a condition on ``vec_id``. A row isn't a candidate of a query of its own id. Vectors that are null, empty or
    hold a null or non-finite component take no part. Vectors of different lengths have no inner product: a query meets the rows of its own
    length, and there is a search for each length in the table (one, or a few). Rows equal in id and vector count once; of a
    repeated id with several vectors of a length each is a candidate and the least is the query.
    Extra columns are ignored; an empty table gives no rows.
    """
    vectors = written(integer_vectors(rows, id_column, vector, scale), "tree-vectors")
    widths = sorted(r["width"] for r in vectors.select(F.size("vec").alias("width")).distinct().collect())  # a row a length
    found = [_top_k_of_width(vectors.where(F.size("vec") == width), width, is_query, k) for width in widths]
    if not found:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    every = reduce(DataFrame.unionByName, found)
    if len(found) > 1:  # an id may have vectors of several lengths
        every = every.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return every.select("query_id", "rank", "vec_id", "score")


def _top_k_of_width(vectors: DataFrame, width: int, is_query: Column, k: int) -> DataFrame:
    vectors = vectors.distinct()
    first_ids = Window.partitionBy("vec").orderBy("vec_id")
    kept = vectors.withColumn("nth", F.row_number().over(first_ids)).where(F.col("nth") <= k + 1).drop("nth")
    queries = vectors.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec"))

    n = vectors.count()
    n_cells = max(1, min(MAX_CELLS, -(-n // CELL_ROWS)))
    sample = vectors.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(n_cells).collect()  # MAX_CELLS rows at most
    pivots = np.array([r["vec"] for r in sample], float).reshape(-1, width)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, gap = _nearest(_matrix(batch.column("vec"), width), pivots)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(gap)], names=[*batch.schema.names, "cell", "gap"])

    dealt = written(kept.mapInArrow(deal, "vec_id long, vec array<long>, cell int, gap double"), "tree-rows")
    sizes = {r["cell"]: r for r in dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()}  # MAX_CELLS rows at most
    cells = sorted(sizes)
    n_blocks = [-(-sizes[c]["n"] // BLOCK_ROWS) for c in cells]
    first_block = np.concatenate(([0], np.cumsum(n_blocks))).astype(int)
    starts = F.create_map(*[F.lit(int(x)) for i, c in enumerate(cells) for x in (c, first_block[i])])
    counts = F.create_map(*[F.lit(int(x)) for i, c in enumerate(cells) for x in (c, n_blocks[i])])
    block = (starts[F.col("cell")] + F.pmod(F.xxhash64("vec_id", "vec"), counts[F.col("cell")])).cast("int")
    dealt = dealt.select("vec_id", "vec", block.alias("block"))

    centre, radius = pivots[cells], np.array([sizes[c]["radius"] for c in cells])
    norm = np.sqrt((centre**2).sum(1))

    def route(own: bool):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = _matrix(batch.column("vec"), width)
                home, _ = _nearest(q, centre)
                bound = q @ centre.T + np.sqrt((q.astype(float) ** 2).sum(1))[:, None] * radius
                bound += 1e-6 * (1 + np.abs(bound))
                worst = np.asarray(batch.column("worst").fill_null(np.iinfo(np.int64).min)).astype(float)
                goes = bound >= worst[:, None]
                blocks, source = [], []
                for i in range(len(q)):
                    here = int(first_block[home[i]]) + int(batch.column("vec_id")[i].as_py()) % n_blocks[home[i]]
                    to = [here] if own else [b for c in np.flatnonzero(goes[i]) for b in range(first_block[c], first_block[c + 1]) if b != here]
                    blocks += to
                    source += [i] * len(to)
                taken = batch.take(pa.array(source, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(blocks, pa.int32())], names=[*taken.schema.names, "block"])
        return task

    def search(q: pa.Table, x: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if q.num_rows and x.num_rows:
            ids = x.column("vec_id").to_numpy()
            q_ids = q.column("vec_id").to_numpy()
            worst = q.column("worst").combine_chunks().fill_null(np.iinfo(np.int64).min).to_numpy()
            best, where = dual_search(q_ids, _matrix(q.column("vec"), width), ids, _matrix(x.column("vec"), width), k, worst)
            at, place = np.nonzero(where >= 0)
            out = {"query_id": q_ids[at], "vec_id": ids[where[at, place]], "score": best[at, place]}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    def asked(asking: DataFrame, own: bool) -> DataFrame:
        """``asking``: vec_id, vec, worst."""
        asking = written(asking.mapInArrow(route(own), "vec_id long, vec array<long>, worst long, block int"), "tree-asks")
        return searched(asking, dealt, search, "query_id long, vec_id long, score long")

    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)

    near = written(asked(queries.withColumn("worst", F.lit(None).cast("long")), own=True), "tree-near")
    worst = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("worst")).where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), "worst")
    far = asked(queries.join(worst, "vec_id", "left").select("vec_id", "vec", "worst"), own=False)
    return ranked(near.unionByName(far)).select("query_id", "rank", "vec_id", "score")
