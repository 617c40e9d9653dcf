"""Hard negatives by segment summaries: bounds on scores from means and deviations, refined before any exact score.

A vector is cut into segments, and of each the mean m and the deviation s (root of the summed squared differences from the mean) are
stored. The inner product of two vectors lies within ``sum(n m m') - sum(s s')`` and ``sum(n m m') + sum(s s')``, over segments of n
components. Finer segments give a narrower range, so rows are filtered in steps:

* cells: rows whose coarse means lie in one box. A cell keeps the range of its means and its largest deviations, which
  bound every row in it; a query goes only to the cells that may hold an answer;
* within a cell's blocks, ``COARSE`` segments a vector, then ``FINE`` (each coarse one is made of fine ones): a row goes
  when its upper bound is below what the query can use, or its lower bound above it. The kth largest lower bound of rows
  that are certain to qualify is such a limit, without any score;
* exact scores for the pairs that are left.

Positives of an anchor are searched first; each positive's score then sets the window for its negatives. In both
searches an anchor asks its own block first, which gives the limit it takes to the other cells.

Driver: cut points of the cells, and means and deviations of at most ``LEVELS ** COARSE`` cells for each vector length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeris.llm.common import written
from aeris.llm.cover_tree import products
from aeris.llm.tiles import searched

COARSE, FINE = 4, 16
LEVELS = 8  # boxes along each coarse mean, at most
BLOCK_ROWS = 8192
CHUNK = 256  # queries whose bounds are in memory at a time
PAIRS = 1 << 16
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

SUMMED = "vec_id long, label int, vec array<long>, means array<double>, deviations array<double>"


def segments(width: int, n: int) -> np.ndarray:
    """Bounds of ``n`` segments of a vector (some empty, if it is short); those of a multiple of n refine them."""
    return np.arange(n + 1) * width // n


def summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the ``FINE`` segments of each row."""
    x = x.astype(float)
    cut = segments(x.shape[1], FINE)
    mean, deviation = np.zeros((len(x), FINE)), np.zeros((len(x), FINE))
    for j in range(FINE):
        own = x[:, cut[j] : cut[j + 1]]
        if own.shape[1]:
            mean[:, j] = own.mean(1)
            deviation[:, j] = np.sqrt(((own - mean[:, j : j + 1]) ** 2).sum(1))
    return mean, deviation


def coarser(mean: np.ndarray, deviation: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``COARSE`` segments' means and deviations from the fine ones'."""
    n = np.diff(segments(width, FINE)).reshape(COARSE, -1)
    m, s = mean.reshape(len(mean), COARSE, -1), deviation.reshape(len(mean), COARSE, -1)
    whole = (n * m).sum(2) / np.maximum(n.sum(1), 1)
    return whole, np.sqrt((s**2).sum(2) + (n * (m - whole[:, :, None]) ** 2).sum(2))


def ranges(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products of all pairs, a little wider than they are, for rounding."""
    n = np.diff(segments(width, a[0].shape[1]))
    middle, reach = (a[0] * n) @ b[0].T, a[1] @ b[1].T
    reach += 1e-6 * (1 + np.abs(middle) + reach)
    return middle - reach, middle + reach


def pair_products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of rows ``a[i]`` and ``b[j]``."""
    if len(i) * 8 > len(a) * len(b):
        return products(a, b)[i, j]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    a, b = (a.astype(float), b.astype(float)) if most < 2.0**53 else (a, b)
    parts = [np.einsum("pd,pd->p", a[i[s : s + PAIRS]], b[j[s : s + PAIRS]]) for s in range(0, len(i), PAIRS)]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


class Block:
    """Vectors with their stored summaries, queries or rows."""

    def __init__(self, ids: np.ndarray, label: np.ndarray, x: np.ndarray, mean: np.ndarray, deviation: np.ndarray):
        self.ids, self.label, self.x, self.fine = ids, label, x, (mean, deviation)
        self.coarse = coarser(mean, deviation, x.shape[1])

    def take(self, at: np.ndarray | slice) -> Block:
        return Block(self.ids[at], self.label[at], self.x[at], self.fine[0][at], self.fine[1][at])


def filtered_search(asked: Block, rows: Block, same_label: bool, low: np.ndarray, high: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Query number, row number and score of the ``k`` best rows of each query (larger score, then smaller id) of another id, of the
    same label or of another one, that score within ``low`` and ``high`` and not below ``least``."""
    found: list[tuple[np.ndarray, ...]] = []
    width = asked.x.shape[1]
    floor_, ceiling = np.maximum(low, least).astype(float)[:, None], high.astype(float)[:, None]
    sure_low = low.astype(float)[:, None]
    for start in range(0, len(asked.ids), CHUNK):
        at = slice(start, start + CHUNK)
        own = asked.take(at)
        alive = (own.label[:, None] == rows.label[None]) == same_label
        alive &= own.ids[:, None] != rows.ids[None]
        column = np.arange(len(rows.ids))
        for level in ("coarse", "fine"):
            a, b = getattr(own, level), getattr(rows, level)
            lower, upper = ranges(a, (b[0][column], b[1][column]), width)
            alive &= (upper >= floor_[at]) & (lower <= ceiling[at])
            sure = alive & (lower >= sure_low[at]) & (upper <= ceiling[at])
            alive &= upper >= _kth(np.where(sure, lower, -np.inf), k)[:, None]
            left = alive.any(0)
            alive, column = alive[:, left], column[left]
        i, j = np.nonzero(alive)
        score = pair_products(own.x, rows.x[column], i, j)
        fits = (score >= np.maximum(low, least)[at][i]) & (score <= high[at][i])
        i, j, score = i[fits], column[j[fits]], score[fits]
        order = np.lexsort((rows.ids[j], ~score, i))
        i, j, score = i[order], j[order], score[order]
        best = np.arange(len(i)) - np.searchsorted(i, i) < k
        found.append((start + i[best], j[best], score[best]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 3


def _matrix(table: pa.Table | pa.RecordBatch, name: str, dtype: type = np.int64) -> np.ndarray:
    column = table.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(column), -1)


def _block(table: pa.Table) -> Block:
    return Block(table.column("vec_id").to_numpy(), table.column("label").to_numpy(), _matrix(table, "vec"),
                 _matrix(table, "means", float), _matrix(table, "deviations", float))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds means and deviations; the rows of a batch may have different lengths."""
    for batch in batches:
        sizes = np.diff(batch.column("vec").offsets.to_numpy())
        for width in np.unique(sizes):
            own = batch.take(pa.array(np.flatnonzero(sizes == width)))
            both = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FINE).cast(pa.list_(pa.float64())) for x in summaries(_matrix(own, "vec"))]
            yield pa.RecordBatch.from_arrays([*own.columns, *both], names=[*own.schema.names, "means", "deviations"])


class Cells:
    """What bounds the rows of each cell of one vector length."""

    def __init__(self, width: int, rows: list, first_block: int):
        self.width = width
        self.code = {r["code"]: i for i, r in enumerate(rows)}
        self.low, self.high, self.deviation = (np.array([r[c] for r in rows], float) for c in ("low", "high", "deviation"))
        self.blocks = np.array([-(-r["n"] // BLOCK_ROWS) for r in rows])
        self.first = first_block + np.concatenate(([0], np.cumsum(self.blocks))).astype(int)

    def ranges(self, mean: np.ndarray, deviation: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the scores of each query with the rows of each cell."""
        n = np.diff(segments(self.width, COARSE))
        one, other = (mean * n)[:, None] * self.low[None], (mean * n)[:, None] * self.high[None]
        reach = deviation @ self.deviation.T
        low, high = np.minimum(one, other).sum(2) - reach, np.maximum(one, other).sum(2) + reach
        return low - 1e-6 * (1 + np.abs(low)), high + 1e-6 * (1 + np.abs(high))


def labelled_vectors(rows: DataFrame, label: Column, scale: int, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, label, vec`` with component x as floor(scale * x). Rows without an id, label or vector, with an empty one or a
    component that is null or not finite are left out."""
    ok = F.expr(f"size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return rows.where(F.col(id_column).isNotNull() & label.isNotNull() & F.coalesce(ok, F.lit(False))).select(
        F.col(id_column).cast("long").alias("vec_id"), label.cast("int").alias("label"),
        F.expr(f"transform({vector}, x -> cast(floor({scale} * cast(x as double)) as bigint))").alias("vec"))


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors of ``vectors`` (see :func:`labelled_vectors`).

    Scores are integer inner products with the anchor, larger ones first, ties to the smaller id. An anchor's positives are the first
    ``positives`` other rows of its label; for each, the first ``negatives`` rows of another label that score no more than it and at least
    ``share`` (a fraction) of it are returned, ``rank`` 1 first (none, if its score is negative). Fewer rows give fewer.

    ``is_anchor`` is a condition on ``vec_id``. Vectors of different lengths have no product: an anchor meets those of its own length only. Rows equal in all three
    columns count once; of a repeated id each other row is a candidate, none for an anchor of the same id, and the least (label, vector)
    is the anchor. An empty table gives no rows."""
    spark = vectors.sparkSession
    rows = vectors.distinct()
    # of rows equal in label and vector only those of the smallest ids can be among the first
    first_ids = Window.partitionBy("label", "vec").orderBy("vec_id")
    enough = max(positives + 1, negatives)
    kept = rows.withColumn("nth", F.row_number().over(first_ids)).where(F.col("nth") <= enough).drop("nth")
    kept = written(kept.mapInArrow(_summed, SUMMED), "negatives-rows")
    anchors = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r")).select("vec_id", "r.label", "r.vec")
    anchors = anchors.mapInArrow(_summed, SUMMED)

    n = kept.count()
    levels = int(max(1, min(LEVELS, round((n / BLOCK_ROWS) ** (1 / COARSE)))))
    width = F.size("vec")
    step = FINE // COARSE

    def fine_sizes(j: int) -> Column:
        return F.expr(f"cast(floor({j + 1} * size(vec) / {FINE}) as int) - cast(floor({j} * size(vec) / {FINE}) as int)")

    def coarse_mean(j: int) -> Column:
        parts = range(j * step, (j + 1) * step)
        total = sum((F.col("means")[p] * fine_sizes(p) for p in parts), F.lit(0.0))
        return total / F.greatest(sum((fine_sizes(p) for p in parts), F.lit(0)), F.lit(1))

    def coarse_deviation(j: int) -> Column:
        parts = range(j * step, (j + 1) * step)
        return F.sqrt(sum((F.pow(F.col("deviations")[p], 2) + fine_sizes(p) * F.pow(F.col("means")[p] - coarse_mean(j), 2) for p in parts), F.lit(0.0)))

    if levels > 1 and n:
        at = [i / levels for i in range(1, levels)]
        cuts = kept.agg(*[F.percentile_approx(coarse_mean(j), at).alias(f"c{j}") for j in range(COARSE)]).first()
        cuts = [list(c) for c in cuts]
    else:
        cuts = [[]] * COARSE
    code = F.lit(0)
    for j in range(COARSE):
        code = code * levels + sum(((coarse_mean(j) >= c).cast("int") for c in cuts[j]), F.lit(0))
    kept = kept.withColumn("code", code.cast("int"))

    found = kept.groupBy(width.alias("width"), "code").agg(
        F.count("*").alias("n"),
        F.array(*[F.min(coarse_mean(j)) for j in range(COARSE)]).alias("low"),
        F.array(*[F.max(coarse_mean(j)) for j in range(COARSE)]).alias("high"),
        F.array(*[F.max(coarse_deviation(j)) for j in range(COARSE)]).alias("deviation")).orderBy("width", "code").collect()  # LEVELS ** COARSE rows a length
    cells: dict[int, Cells] = {}
    for w in sorted({r["width"] for r in found}):
        cells[w] = Cells(w, [r for r in found if r["width"] == w], sum(int(c.blocks.sum()) for c in cells.values()))
    numbered = spark.createDataFrame(
        [(w, c, int(x.first[i]), int(x.blocks[i])) for w, x in cells.items() for c, i in x.code.items()], "width int, code int, first int, blocks int")
    kept = kept.withColumn("width", width).join(numbered, ["width", "code"]).withColumn(
        "block", (F.col("first") + F.pmod(F.xxhash64("vec_id", "label"), F.col("blocks"))).cast("int")).drop("width", "code", "first", "blocks")
    kept = written(kept, "negatives-blocks")
    asks = written(anchors.select("*", code.cast("int").alias("code")), "negatives-anchors")

    def routed(asking: DataFrame, home: bool) -> DataFrame:
        """A row for each block that a query asks. ``asking``: the anchors' columns, ``low``, ``high``, ``least`` (arrays, one entry a search)."""
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = np.diff(batch.column("vec").offsets.to_numpy())
                source, blocks = [], []
                for w in np.unique(sizes):
                    if int(w) not in cells:
                        continue
                    own, cell = np.flatnonzero(sizes == w), cells[int(w)]
                    part = batch.take(pa.array(own))
                    lower, upper = cell.ranges(*coarser(_matrix(part, "means", float), _matrix(part, "deviations", float), int(w)))
                    for i, at in enumerate(own):
                        c = cell.code.get(part.column("code")[i].as_py())
                        mine = None if c is None else int(cell.first[c]) + part.column("vec_id")[i].as_py() % int(cell.blocks[c])
                        if home:
                            to = [] if mine is None else [mine]
                        else:
                            low, high, least = (np.array(part.column(x)[i].as_py(), float)[:, None] for x in ("low", "high", "least"))
                            goes = ((upper[i] >= np.maximum(low, least)) & (lower[i] <= high)).any(0)
                            to = [b for c in np.flatnonzero(goes) for b in range(cell.first[c], cell.first[c + 1]) if b != mine]
                        source += [at] * len(to)
                        blocks += to
                taken = batch.take(pa.array(source, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(blocks, pa.int32())], names=[*taken.schema.names, "block"])

        kinds = ", ".join(f"{c} {t}" for c, t in asking.dtypes) + ", block int"
        return written(asking.mapInArrow(task, kinds), "negatives-asks")

    def tile(same_label: bool, k: int):
        def search(q: pa.Table, x: pa.Table) -> pa.Table:
            out: dict[str, list[np.ndarray]] = {"anchor_id": [], "high": [], "vec_id": [], "score": []}
            if q.num_rows and x.num_rows:
                asked, rows_ = _block(q), _block(x)
                limits = {c: q.column(c).combine_chunks() for c in ("low", "high", "least")}
                count = np.diff(limits["low"].offsets.to_numpy())
                for t in range(count.max(initial=0)):  # the searches of an anchor, one window each
                    own = np.flatnonzero(count > t)
                    low, high, least = (c.flatten().to_numpy()[(c.offsets.to_numpy()[:-1] - c.offsets.to_numpy()[0])[own] + t] for c in limits.values())
                    i, j, score = filtered_search(asked.take(own), rows_, same_label, low, high, least, k)
                    for name, values in (("anchor_id", asked.ids[own][i]), ("high", high[i]), ("vec_id", rows_.ids[j]), ("score", score)):
                        out[name].append(values)
            return pa.table({c: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for c, v in out.items()})
        return search

    best_first = Window.partitionBy("anchor_id", "high").orderBy(F.desc("score"), "vec_id")

    def all_best(asking: DataFrame, same_label: bool, k: int) -> DataFrame:
        """``anchor_id, high, vec_id, score, rank``. ``asking``: anchors with ``low`` and ``high``, arrays."""
        kinds = "anchor_id long, high long, vec_id long, score long"
        unlimited = asking.withColumn("least", F.expr(f"transform(low, x -> {LEAST + 1}L)"))
        near = written(searched(routed(unlimited, True), kept, tile(same_label, k), kinds), "negatives-near")
        reached = near.groupBy("anchor_id", "high").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
        reached = reached.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.map_from_entries(F.collect_list(F.struct("high", "least"))).alias("reached"))
        limited = asking.join(reached, "vec_id", "left").withColumn("least", F.expr(f"transform(high, x -> coalesce(reached[x], {LEAST + 1}L))")).drop("reached")
        far = searched(routed(limited, False), kept, tile(same_label, k), kinds)
        return near.unionByName(far).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)

    anyhow = asks.withColumn("low", F.array(F.lit(LEAST + 1))).withColumn("high", F.array(F.lit(MOST)))
    chosen = written(all_best(anyhow, True, positives).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    windows = chosen.where("positive_score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_set("positive_score")).alias("high"))
    num, den = share
    low = F.expr(f"transform(high, x -> ({num}L * x + {den - 1}) div {den})")  # rounded up: scores are integers, and these not negative
    found_negatives = all_best(asks.join(windows, "vec_id").withColumn("low", low), False, negatives)
    return chosen.join(found_negatives.select("anchor_id", F.col("high").alias("positive_score"), F.col("vec_id").alias("negative_id"),
                                              F.col("score").alias("negative_score"), "rank"), ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
