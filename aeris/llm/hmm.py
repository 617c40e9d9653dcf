"""Hidden Markov language model, trained by Baum-Welch counts that are summed across partitions.

Tokens are lower-cased (A-Z) words and one end for each text. The ``n_frequent`` most frequent words are
symbols of their own; every other word belongs to one of ``CLASSES`` classes by its last two
bytes. A state emits a symbol or a class; a word of a class follows the smoothed counts
(c + 0.5) / (N + 0.5 (V + 1)) within its class, whatever the state. A text's likelihood is exact: a
scaled forward recursion over the whole text.

Training: seeded random emissions break the symmetry of the states. Then rounds of Baum-Welch run over all
training texts until the summed log-likelihood gains less than ``settled`` of itself: each task sums
expected counts, the sums of all tasks are added up per symbol. The rounds are incremental: texts fall into ``SLICES`` slices by a
hash, the newest counts of every slice are kept, and the model is estimated again from all of them after each slice instead of after each
round, so a round goes several times as far. A text is one sequence, however long; of
texts too long to hold, the forward recursion is kept at some places and done again between them.
Emissions are smoothed towards the corpus's own shares.

Scale: word counts and the join of rare words to their counts are shuffles on the word's hash. Frequent words (a
bounded table) are looked up in the task, so only rare words move. Words are known by 64-bit
hashes. The driver holds the model: symbols times states, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import scratch_path, written
from aeris.llm.text import Words, slices, words

CLASSES = 256
END_HASH = 0
SETTLED = 1e-3
SLICES = 8
MOST_ROUNDS = 200  # far beyond what settles; training that goes on longer is an error
HELD = 1 << 19  # distinct words a task holds before it sends them on
TOKENS = 1 << 18  # tokens worked on at once
HELD_TOKENS = 1 << 22  # tokens a task holds to put texts of like length together


def word_class(w: Words) -> np.ndarray:
    """Class of each word by its last two bytes (the one byte of shorter words)."""
    last = w.data[w.end - 1].astype(np.int64)
    before = np.where(w.end - w.start > 1, w.data[np.maximum(w.end - 2, 0)], 0)
    return (last * 31 + before * 17) % CLASSES


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by word hash; the end's has class -1."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = ends = 0

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, first, where = np.unique(np.concatenate([x[0] for x in held]), return_index=True, return_inverse=True)
        return h, np.concatenate([x[1] for x in held])[first], np.bincount(where, np.concatenate([x[2] for x in held])).astype(np.int64)

    def out(h: np.ndarray, kind: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(h), 100_000):
            cut = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(h[cut].view(np.int64)), pa.array(kind[cut].astype(np.int32)), pa.array(n[cut])], names=["hash", "kind", "n"])

    for batch in batches:
        texts = batch.column("text")
        ends += batch.num_rows
        for a, b in slices(texts):
            w = words(texts.slice(a, b - a))
            h, first, n = np.unique(w.hash, return_index=True, return_counts=True)
            held.append((h, word_class(w)[first], n.astype(np.int64)))
            size += len(h)
            if size > HELD:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from out(*held[0])
                    held, size = [], 0
    if held:
        yield from out(*merged())
    if ends:
        yield from out(np.array([END_HASH], np.uint64), np.array([-1]), np.array([ends]))


def word_counts(texts: DataFrame) -> DataFrame:
    """``hash, kind, n`` of every token of column ``text`` (kind: the word's class; -1 for the end)."""
    return texts.select("text").mapInArrow(_count_task, "hash long, kind int, n long").groupBy("hash").agg(F.min("kind").alias("kind"), F.sum("n").alias("n"))


class Vocabulary(NamedTuple):
    """Frequent words (ascending hashes) with counts and symbol numbers; counts of the classes' other words
    and how many there are; the end's count; totals of tokens and distinct tokens."""

    hashes: np.ndarray
    counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    ends: int
    tokens: int
    distinct: int

    @property
    def symbols(self) -> int:
        return len(self.hashes) + CLASSES + 1

    def shares(self) -> np.ndarray:
        """Smoothed share of every symbol among all tokens."""
        c = np.concatenate([self.counts + 0.5, self.class_tokens + 0.5 * (self.class_words + 1), [self.ends + 0.5]])
        return c / c.sum()


def vocabulary(counts: DataFrame, n_frequent: int) -> Vocabulary:
    """From the written table of ``word_counts``: ``n_frequent`` rows and one row a class reach the driver."""
    plain = counts.where("kind >= 0")
    steps = {r["step"]: r["words"] for r in plain.groupBy(F.floor(F.log2("n") * 16).alias("step")).agg(F.count("*").alias("words")).collect()}  # some hundred rows
    least, above = 0, 0
    for step in sorted(steps, reverse=True):  # rarer words can't be among the most frequent; without them, few rows meet in the last sort
        least, above = step, above + steps[step]
        if above >= n_frequent:
            break
    top = plain.where(F.floor(F.log2("n") * 16) >= least).orderBy(F.desc("n"), "hash").limit(n_frequent).collect()
    top.sort(key=lambda r: r["hash"] & (2**64 - 1))
    kinds, n = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in plain.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        n[r["kind"]], kinds[r["kind"]] = r["n"], r["words"]
    total, distinct = int(n.sum()), int(kinds.sum())
    for r in top:
        n[r["kind"]] -= r["n"]
        kinds[r["kind"]] -= 1
    end = counts.where("kind < 0").agg(F.sum("n")).first()[0] or 0
    return Vocabulary(np.array([r["hash"] for r in top], np.int64).view(np.uint64), np.array([r["n"] for r in top], np.int64),
                      n, kinds, int(end), total + int(end), distinct + (end > 0))


def encode(docs: DataFrame, voc: Vocabulary, trains: Column, held_out: Column) -> DataFrame:
    """``row, doc_id, trains, held_out, n_tokens, n_known, known_score, class_score, symbols, rare`` of each text.

    ``symbols`` are the symbol numbers, the end's last, as 16-bit integers; ``rare`` the hashes and counts of words
    that are no symbols; ``known_score`` sums log10(c + 0.5) of all other tokens (``n_known`` of which have c > 0);
    ``class_score`` sums -log10 of the class totals of rare tokens."""
    frequent = len(voc.hashes)
    gain = np.log10(voc.counts + 0.5)
    cost = -np.log10(voc.class_tokens + 0.5 * (voc.class_words + 1))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: dict[str, list] = {c: [] for c in ("n_tokens", "n_known", "known_score", "class_score", "symbols", "hashes", "times")}
            texts = batch.column("text")
            for a, b in slices(texts):
                w = words(texts.slice(a, b - a))
                at = np.minimum(np.searchsorted(voc.hashes, w.hash), max(frequent - 1, 0))
                known = voc.hashes[at] == w.hash if frequent else np.zeros(len(w.hash), bool)
                kind = word_class(w)
                code = np.where(known, at, frequent + kind).astype(np.uint16)
                score = np.concatenate(([0.0], np.cumsum(np.where(known, gain[at] if frequent else 0.0, 0.0))))
                rest = np.concatenate(([0.0], np.cumsum(np.where(known, 0.0, cost[kind]))))
                n_known = np.concatenate(([0], np.cumsum(known)))
                for i in range(b - a):
                    lo, hi = w.first[i], w.first[i + 1]
                    cols["n_tokens"].append(hi - lo + 1)
                    cols["n_known"].append(n_known[hi] - n_known[lo] + (voc.ends > 0))
                    cols["known_score"].append(score[hi] - score[lo] + np.log10(voc.ends + 0.5))
                    cols["class_score"].append(rest[hi] - rest[lo])
                    cols["symbols"].append(np.append(code[lo:hi], np.uint16(voc.symbols - 1)).tobytes())
                    h, n = np.unique(w.hash[lo:hi][~known[lo:hi]], return_counts=True)
                    cols["hashes"].append(h.view(np.int64))
                    cols["times"].append(n)
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in cols["hashes"]]))).astype(np.int32))
            flat = lambda c, kind: pa.array(np.concatenate([*cols[c], np.zeros(0, np.int64)]), kind)
            rare = pa.StructArray.from_arrays([flat("hashes", pa.int64()), flat("times", pa.int32())], names=["hash", "n"])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "trains", "held_out")), pa.array(cols["n_tokens"], pa.int64()), pa.array(cols["n_known"], pa.int64()),
                 pa.array(cols["known_score"], pa.float64()), pa.array(cols["class_score"], pa.float64()), pa.array(cols["symbols"], pa.binary()),
                 pa.ListArray.from_arrays(offsets, rare)],
                names=["doc_id", "trains", "held_out", "n_tokens", "n_known", "known_score", "class_score", "symbols", "rare"])

    schema = (f"doc_id {dict(docs.dtypes)['doc_id']}, trains boolean, held_out boolean, n_tokens long, n_known long, known_score double, "
              "class_score double, symbols binary, rare array<struct<hash: long, n: int>>")
    rows = docs.select("doc_id", trains.alias("trains"), held_out.alias("held_out"), "text").mapInArrow(task, schema)
    return rows.withColumn("row", F.monotonically_increasing_id())


class Model(NamedTuple):
    """``start`` of a text, ``share`` of each state anywhere, ``move[i, j]``, ``emit[symbol, state]``."""

    start: np.ndarray
    share: np.ndarray
    move: np.ndarray
    emit: np.ndarray


class Counts(NamedTuple):
    start: np.ndarray
    share: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    def plus(self, other: Counts) -> Counts:
        return Counts(*(a + b for a, b in zip(self, other)))


def no_counts(symbols: int, states: int) -> Counts:
    return Counts(np.zeros(states), np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states)))


def estimate(c: Counts, shares: np.ndarray) -> Model:
    """Model of expected counts, emissions smoothed by a few pseudo-counts in the corpus's shares."""
    k = len(c.start)
    start = (c.start + 0.5) / (c.start + 0.5).sum()
    share = (c.share + 0.5) / (c.share + 0.5).sum()
    move = (c.move + 0.5) / (c.move + 0.5).sum(1, keepdims=True)
    emit = c.emit + shares[:, None] * (20.0 + 0.01 * c.emit.sum() / k)
    return Model(start, share, move, emit / emit.sum(0))


def _padded(sequences: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Symbols by position of sequences in order of falling length: step t has those of the sequences longer than t."""
    lengths = np.array([len(s) for s in sequences])
    table = np.zeros((len(sequences), int(lengths[0])), np.int32)
    for r, s in enumerate(sequences):
        table[r, : len(s)] = s
    active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left")
    return [table[: active[t], t] for t in range(table.shape[1])], active


def whole_counts(sequences: list[np.ndarray], m: Model) -> tuple[Counts, float]:
    """One E step over whole sequences and the log-likelihood (base e) of them all. At most TOKENS steps, or
    tokens of several sequences, are held at once."""
    total, likelihood = no_counts(*m.emit.shape), 0.0
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    lo = 0
    while lo < len(order):
        hi, size = lo, 0
        while hi < len(order) and (hi == lo or size + len(sequences[order[hi]]) <= TOKENS):
            size += len(sequences[order[hi]])
            hi += 1
        counts, gain = _group_counts([sequences[i] for i in order[lo:hi]], m)
        total, likelihood, lo = total.plus(counts), likelihood + gain, hi
    return total, likelihood


def _group_counts(group: list[np.ndarray], m: Model) -> tuple[Counts, float]:
    """``whole_counts`` of sequences in order of falling length, step by step: a block's rows are those of its first
    step, then of the next. The states ahead of each block are kept, and the block done again on the way back."""
    total, likelihood = no_counts(*m.emit.shape), 0.0
    lengths = np.array([len(s) for s in group])
    flat, begin = np.concatenate(group), np.concatenate(([0], np.cumsum(lengths)[:-1]))
    blocks = range(0, int(lengths[0]), TOKENS)
    before = [np.zeros((0, len(m.start)))]
    ones = np.ones(len(m.start))

    def forward(at: int) -> tuple[np.ndarray, ...]:
        steps = np.arange(at, min(at + TOKENS, int(lengths[0])))
        active = np.searchsorted(-lengths, -steps, side="left")
        offset = np.concatenate(([0], np.cumsum(active)))
        row = np.arange(offset[-1]) - np.repeat(offset[:-1], active)
        symbols = flat[begin[row] + np.repeat(steps, active)]
        emit = m.emit[symbols]
        alpha, scale, a = np.empty_like(emit), np.empty(len(emit)), before[at // TOKENS]
        for t, n, o in zip(steps.tolist(), active.tolist(), offset.tolist()):
            a = (a[:n] @ m.move if t else m.start) * emit[o : o + n]
            scale[o : o + n] = c = a @ ones
            a /= c[:, None]
            alpha[o : o + n] = a
        return symbols, active, offset, row, emit, alpha, scale

    for at in blocks[:-1]:
        *_, offset, _, _, alpha, _ = forward(at)
        before.append(alpha[offset[-2] :])
    behind = np.zeros((0, len(m.start)))
    for at in reversed(blocks):
        symbols, active, offset, row, ahead, alpha, scale = forward(at)
        likelihood += float(np.log(scale).sum())
        ahead /= scale[:, None]
        beta = np.ones_like(alpha)  # stays 1 where a sequence ends
        beta[offset[-2] : offset[-2] + len(behind)] = behind
        back = m.move.T.copy()
        for j in range(len(active) - 1, -1, -1):
            o, n = int(offset[j]), int(active[j])
            ahead[o : o + n] *= beta[o : o + n]
            behind = ahead[o : o + n] @ back
            if j:
                beta[offset[j - 1] : offset[j - 1] + n] = behind
        earlier = alpha[row[offset[1] :] + np.repeat(offset[:-2], active[1:])]
        total.move[...] += m.move * (earlier.T @ ahead[offset[1] :])
        if at:
            total.move[...] += m.move * (before[at // TOKENS][: active[0]].T @ ahead[: active[0]])
        weights = alpha * beta
        weights /= weights.sum(1, keepdims=True)
        if not at:
            total.start[...] += weights[: len(group)].sum(0)
        total.share[...] += weights.sum(0)
        for k in range(weights.shape[1]):
            total.emit[:, k] += np.bincount(symbols, weights[:, k], len(total.emit))
    return total, likelihood


def _sequences(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(s, np.uint16) for s in column.to_pylist()]


def start_model(voc: Vocabulary, states: int) -> Model:
    """The corpus's shares with seeded random factors for each state."""
    rng = np.random.default_rng(7)
    shares = voc.shares()
    emit = shares[:, None] * rng.gamma(1.0, size=(len(shares), states))
    return Model(np.full(states, 1 / states), np.full(states, 1 / states), np.full((states, states), 0.2 / states) + 0.8 * np.eye(states), emit / emit.sum(0))


def corpus_counts(texts: DataFrame, model: Model) -> tuple[Counts, float]:
    """Expected counts of one E step over all of ``texts`` (``symbols``), and their log-likelihood (base e) by the model.
    A task sends one row for each symbol it met."""
    symbols, states = model.emit.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, likelihood, held, size = no_counts(symbols, states), 0.0, [], 0
        for batch in batches:
            for s in _sequences(batch.column("symbols")):
                held.append(s)
                size += len(s)
                if size > HELD_TOKENS:
                    counts, gain = whole_counts(held, model)
                    total, likelihood, held, size = total.plus(counts), likelihood + gain, [], 0
        if held:
            counts, gain = whole_counts(held, model)
            total, likelihood = total.plus(counts), likelihood + gain
        met = np.flatnonzero(total.emit.any(1))
        if len(met):
            ids = np.concatenate([met, -1 - np.arange(states + 3)])
            values = np.concatenate([total.emit[met], total.move, [total.start, total.share, np.eye(states)[0] * likelihood]])
            for i in range(0, len(ids), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(ids[i : i + 10_000].astype(np.int32)), *map(pa.array, values[i : i + 10_000].T)],
                                                 names=["id", *(f"k{j}" for j in range(states))])

    sums = texts.select("symbols").mapInArrow(task, "id int, " + ", ".join(f"k{j} double" for j in range(states)))
    rows = sums.groupBy("id").agg(*[F.sum(f"k{j}").alias(f"k{j}") for j in range(states)]).toArrow()  # symbols and states
    ids = rows.column("id").to_numpy()
    values = np.stack([rows.column(f"k{j}").to_numpy() for j in range(states)], 1) if len(ids) else np.zeros((0, states))
    total = no_counts(symbols, states)
    total.emit[ids[ids >= 0]] = values[ids >= 0]
    extra = np.zeros((states + 3, states))
    extra[-1 - ids[ids < 0]] = values[ids < 0]
    return Counts(extra[states], extra[states + 1], extra[:states], total.emit), float(extra[states + 2, 0])


def trained(encoded: DataFrame, voc: Vocabulary, states: int, settled: float) -> Model:
    """Rounds over all training texts until one gains less than ``settled`` of the log-likelihood. A slice's share of it is by the
    model that its counts were made with."""
    model, last = start_model(voc, states), -np.inf
    kept = [no_counts(*model.emit.shape)] * SLICES
    for _ in range(MOST_ROUNDS):
        likelihood = 0.0
        for i in range(SLICES):
            kept[i], gain = corpus_counts(encoded.where(F.col("slice") == i), model)
            likelihood += gain
            model = estimate(reduce(Counts.plus, kept), voc.shares())
        if not likelihood - last > settled * abs(likelihood):
            return model
        last = likelihood
    raise RuntimeError(f"the log-likelihood hasn't settled in {MOST_ROUNDS} rounds")


def _sliced(encoded: DataFrame) -> DataFrame:
    """Written with the training texts' slices as partitions (-1: texts that don't train)."""
    path = scratch_path(encoded.sparkSession, "hmm-encoded")
    rows = encoded.withColumn("slice", F.when(F.col("trains"), F.pmod(F.xxhash64("row"), F.lit(SLICES))).otherwise(-1).cast("int"))
    rows.hint("rebalance", "slice").write.partitionBy("slice").parquet(path)
    return encoded.sparkSession.read.schema(rows.schema).parquet(path)


def log10_likelihood(sequences: list[np.ndarray], m: Model) -> np.ndarray:
    """Exact log10 probability of each sequence by the scaled forward recursion."""
    out = np.zeros(len(sequences))
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    lo = 0
    while lo < len(order):
        hi, size = lo, 0
        while hi < len(order) and (hi == lo or (size := (hi + 1 - lo) * len(sequences[order[lo]])) <= 8 * TOKENS):
            hi += 1  # the padded table stays bounded
        group = order[lo:hi]
        steps, active = _padded([sequences[i] for i in group])
        score = np.zeros(len(group))
        a = m.start * m.emit[steps[0]]
        for t in range(len(steps)):
            if t:
                a = (a[: active[t]] @ m.move) * m.emit[steps[t]]
            c = a.sum(1)
            score[: active[t]] += np.log10(c)
            a = a / c[:, None]
        out[group] = score
        lo = hi
    return out


def _likelihoods(encoded: DataFrame, model: Model) -> DataFrame:
    keep = ["row", "doc_id", "held_out", "n_tokens", "n_known", "known_score", "class_score"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = log10_likelihood(_sequences(batch.column("symbols")), model)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(score)], names=[*keep, "chain_score"])

    rows = encoded.select(*keep, "symbols")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "symbols")
    return rows.mapInArrow(task, f"{fields}, chain_score double")


def language_model_scores(docs: DataFrame, trains: Column, held_out: Column, states: int = 8, settled: float = SETTLED, n_frequent: int = 32_000) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs`` (``doc_id, text``).

    ``trains`` and ``held_out`` are conditions on the row; a null counts as false. ``base_score`` sums the log10
    smoothed shares of the tokens among all training tokens; ``score`` is the model's log10 probability of the text.
    ``n_known`` tokens occur in training. A null or empty text is its end alone. Without training texts every
    token is unknown. Repeated rows and null ids are ordinary rows; extra columns are ignored; an empty table gives no rows.
    """
    if n_frequent + CLASSES + 1 > 1 << 16:
        raise ValueError("symbols are 16-bit numbers")
    trains, held_out = F.coalesce(trains, F.lit(False)), F.coalesce(held_out, F.lit(False))
    counts = written(word_counts(docs.where(trains)), "hmm-words")
    voc = vocabulary(counts, n_frequent)
    encoded = _sliced(encode(docs, voc, trains, held_out))
    model = trained(encoded, voc, states, settled)

    rare = encoded.select("row", F.explode("rare").alias("w")).select("row", "w.hash", F.col("w.n").alias("times"))
    seen = F.coalesce("n", F.lit(0))
    rare = (
        rare.join(counts.where("kind >= 0").select("hash", "n"), "hash", "left")
        .groupBy("row").agg(F.sum(F.col("times") * F.log10(seen + 0.5)).alias("rare_score"), F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    )
    base = F.col("known_score") + F.coalesce("rare_score", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(voc.tokens + 0.5 * (voc.distinct + 1)))
    score = F.col("chain_score") + F.coalesce("rare_score", F.lit(0.0)) + F.col("class_score")
    return written(_likelihoods(encoded, model), "hmm-likelihoods").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(voc.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))
