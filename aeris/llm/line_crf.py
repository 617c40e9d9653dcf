"""Document quality from a linear-chain conditional random field over lines.

Each line that has a word is labelled good or bad. A line's score for a label is linear in its
own features and in those of the lines before and after it; neighbouring labels interact through
a transition score. Forward-backward marginals give each line's probability of being good; their
mean, weighted by line length, is the document's quality.

Training: only documents are labelled, so a document's label stands for each of its lines. The
field is fitted by gradient ascent in one task, not on the driver, over a bounded, documented sample of labelled
documents (``SAMPLE_PER_LABEL`` of each label, those with the smallest hash of the id), each class weighted back to its
share of all labels. Scoring is a map over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import with_computed
from aeris.llm.text import mix, slices, words

SAMPLE_PER_LABEL = 2000
SLICE_BYTES = 1 << 20
#: Of a model as a row: its fields, in order, each an array of numbers of a type.
FIELDS = {"mean": "float", "deviation": "float", "weights": "double", "transition": "double"}

LETTER_UPPER, LETTER_LOWER, DIGIT, SYMBOL, BAR, SHOUT, STOP, HIGH, OTHER = range(9)
CLASSES = 9
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = LETTER_UPPER, LETTER_LOWER, DIGIT, HIGH
_CLASS[list(b"#*$%&<>{}[]=~^_\\@+/")] = SYMBOL
_CLASS[list(b"|")] = BAR
_CLASS[list(b"!?")] = SHOUT
_CLASS[list(b".,;:")] = STOP


class Lines(NamedTuple):
    """Lines with a word of several texts: features, lengths in bytes, and
    ``first[i]:first[i + 1]`` the lines of text i."""

    features: np.ndarray
    length: np.ndarray
    first: np.ndarray


def line_features(texts: pa.Array) -> Lines:
    w = words(texts, lower=False)
    data = w.data
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    of_word = np.searchsorted(ends, w.start)
    n_lines = len(ends)
    n = np.bincount(of_word, minlength=n_lines)
    of_byte = np.repeat(np.arange(n_lines, dtype=np.int64) * CLASSES, ends - starts + 1)
    kinds = np.bincount(of_byte + _CLASS[data], minlength=n_lines * CLASSES).reshape(n_lines, CLASSES).astype(float)
    word_bytes = np.bincount(of_word, (w.end - w.start).astype(float), n_lines)
    same = np.zeros(n_lines)
    if len(w.hash) > 1:
        again = (w.hash[1:] == w.hash[:-1]) & (of_word[1:] == of_word[:-1])
        same = np.bincount(of_word[1:][again], minlength=n_lines)
    keyed = mix(w.hash ^ (of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, seen = np.unique(keyed, return_index=True)
    distinct = np.bincount(of_word[seen], minlength=n_lines)
    keep = np.flatnonzero(n > 0)
    doc = w.doc[np.searchsorted(of_word, keep)]
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    n, kinds, word_bytes, same, distinct = (x[keep].astype(float) if x.ndim == 1 else x[keep] for x in (n, kinds, word_bytes, same, distinct))
    line_hash = np.zeros(n_lines, np.uint64)
    np.add.at(line_hash, of_word, mix(w.hash + (np.arange(len(of_word)) - np.searchsorted(of_word, of_word)).astype(np.uint64)))
    line_key = mix(line_hash[keep] ^ (doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))
    _, kept_first = np.unique(line_key, return_index=True)
    repeated = np.ones(len(keep))
    repeated[kept_first] = 0
    letters = np.maximum(kinds[:, LETTER_UPPER] + kinds[:, LETTER_LOWER], 1)
    first_byte = data[w.start[np.searchsorted(of_word, keep)]]
    last_byte = data[w.end[np.searchsorted(of_word, keep, side="right") - 1] - 1]
    size = np.maximum(word_bytes, 1)
    columns = [
        np.log1p(n) / 5,
        np.minimum(n, 5) / 5,
        kinds[:, LETTER_UPPER] / letters,
        np.minimum(kinds[:, SYMBOL] / n, 3),
        np.minimum(kinds[:, BAR] / n, 3),
        np.minimum(kinds[:, SHOUT] / n, 3),
        np.minimum(kinds[:, STOP] / n, 3),
        kinds[:, DIGIT] / size,
        kinds[:, HIGH] / size,
        kinds[:, OTHER] / size,
        np.minimum(word_bytes / n, 40) / 10,
        same / n,
        distinct / n,
        np.log1p(n - distinct) / 5,
        repeated,
        ((first_byte >= 65) & (first_byte < 91) | (first_byte >= 128)).astype(float),
        np.isin(last_byte, list(b".!?")).astype(float),
    ]
    own = np.stack(columns, 1) if len(keep) else np.zeros((0, len(columns)))
    before, after = np.zeros_like(own), np.zeros_like(own)
    if len(own) > 1:
        joined = (doc[1:] == doc[:-1])[:, None]
        before[1:], after[:-1] = np.where(joined, own[:-1], 0), np.where(joined, own[1:], 0)
    has = np.stack([np.concatenate(([False], doc[1:] == doc[:-1]))[: len(own)], np.concatenate((doc[1:] == doc[:-1], [False]))[: len(own)]], 1)
    features = np.concatenate([own, own**2, before, after, has, np.ones((len(own), 1))], 1, dtype=np.float32)
    length = (ends - starts + 1)[keep].astype(float)
    return Lines(features, length, first)


class Model(NamedTuple):
    """``scale``: (mean, deviation) of the features; a line's score of good over bad is
    ``features @ weights``; ``transition[a, b]`` joins the labels of neighbouring lines."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    transition: np.ndarray


def chain_marginals(score: np.ndarray, first: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once: P(good) of every line, the summed pair
    marginals (2 x 2 for each chain) and the log normaliser of each chain.

    Works through positions: step t takes the t-th line of every chain that long."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    start, lengths = first[:-1][order], lengths[order]
    n_steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(n_steps), side="left")  # chains longer than t
    unary = np.stack([np.zeros(len(score)), score], 1)
    alpha, beta = unary.copy(), np.zeros_like(unary)
    for t in range(1, n_steps):
        now = start[: active[t]] + t
        came = alpha[now - 1][:, :, None] + transition
        alpha[now] += np.logaddexp(came[:, 0], came[:, 1])
    for t in range(n_steps - 2, -1, -1):
        now = start[: active[t + 1]] + t
        goes = transition[None] + (unary[now + 1] + beta[now + 1])[:, None, :]
        beta[now] = np.logaddexp(goes[:, :, 0], goes[:, :, 1])
    both = alpha + beta
    z = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - z)
    log_z = np.zeros(len(first) - 1)
    some = np.flatnonzero(np.diff(first) > 0)
    log_z[some] = z[first[:-1][some]]
    chain = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs = np.zeros((len(first) - 1, 2, 2))
    left = np.flatnonzero(chain[1:] == chain[:-1])
    if len(left):
        p = np.exp(alpha[left][:, :, None] + transition + (unary[left + 1] + beta[left + 1])[:, None, :] - z[left][:, None, None])
        for a in range(2):
            for b in range(2):
                pairs[:, a, b] = np.bincount(chain[left], p[:, a, b], len(first) - 1)
    return good, pairs, log_z


def fit(lines: Lines, label: np.ndarray, weight: np.ndarray, steps: int = 120, penalty: float = 1e-3) -> Model:
    """Weighted conditional log-likelihood of the label sequences, a document's label on each of its
    lines; every document counts once, however many lines it has. Adam on the full gradient."""
    x, first = lines.features.copy(), lines.first
    counts = np.maximum(np.diff(first), 1)
    mean = x.mean(0, dtype=np.float64)
    deviation = np.sqrt(np.maximum(np.einsum("ij,ij->j", x, x, dtype=np.float64) / len(x) - mean**2, 0))
    constant = deviation < 1e-6
    mean, deviation = np.where(constant, 0.0, mean).astype(np.float32), np.where(constant, 1.0, deviation).astype(np.float32)
    x -= mean
    x /= deviation
    chain = np.repeat(np.arange(len(label)), np.diff(first))
    y, each = label[chain].astype(float), (weight / counts)[chain]
    of_doc = weight / counts
    n_pairs = np.maximum(np.diff(first) - 1, 0)
    seen = np.zeros((2, 2))
    for k in range(2):
        seen[k, k] = (of_doc * n_pairs)[label == k].sum()
    w, t = np.zeros(x.shape[1]), np.zeros((2, 2))
    state = [np.zeros(w.size + 4), np.zeros(w.size + 4)]
    total = weight.sum()
    for step in range(1, steps + 1):
        good, pairs, _ = chain_marginals(x @ w, first, t)
        grad = np.concatenate([x.T @ (each * (y - good)) / total - penalty * w,
                               ((seen - (of_doc[:, None, None] * pairs).sum(0)) / total - penalty * t).ravel()])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        move = 0.05 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        w, t = w + move[:-4], t + move[-4:].reshape(2, 2)
    return Model(mean, deviation, w, t)


def document_scores(texts: pa.Array, model: Model) -> np.ndarray:
    """Length-weighted mean of the lines' P(good); 0 for a text without words."""
    out = np.zeros(len(texts))
    for a, b in slices(texts, SLICE_BYTES):
        lines = line_features(texts.slice(a, b - a))
        if len(lines.length):
            good, _, _ = chain_marginals((lines.features - model.mean) / model.deviation @ model.weights, lines.first, model.transition)
            chain = np.repeat(np.arange(b - a), np.diff(lines.first))
            total = np.bincount(chain, lines.length, b - a)
            out[a:b] = np.bincount(chain, lines.length * good, b - a) / np.maximum(total, 1)
    return np.clip(out, 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model | None:
    """Fit on at most ``per_label`` rows of each label of ``labels`` (``doc_id, quality``), joined with
    ``docs`` (``doc_id, text``). Null ids, labels other than 0 and 1 and texts without words don't train. A document marked
    both ways counts as bad. None if no row of a label is left for training."""
    marks = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    shares = {r["quality"]: r["n"] for r in marks.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    first = [marks.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for q in (0, 1)]
    chosen = first[0].unionAll(first[1])
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * per_label rows
    sample = sample.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # a repeated id trains once
    found = sample.repartition(1).sortWithinPartitions("doc_id").select("quality", "text").mapInArrow(_fit_task(shares), ", ".join(f"{f} array<{kind}>" for f, kind in FIELDS.items())).first()
    if found is None:
        return None
    return Model(np.array(found["mean"], np.float32), np.array(found["deviation"], np.float32), np.array(found["weights"]), np.array(found["transition"]).reshape(2, 2))


def _fit_task(shares: dict[int, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Fits on all batches (``quality, text``) of its partition and gives the model as one row; none if a label has no row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, parts = [np.zeros(0, np.int64)], []
        for batch in batches:
            texts = batch.column("text")
            labels.append(batch.column("quality").to_numpy())
            parts += [line_features(texts.slice(a, b - a)) for a, b in slices(texts, SLICE_BYTES)]
        label = np.concatenate(labels).astype(np.int64)
        if len(set(label.tolist())) < 2:
            return
        shifts = np.concatenate(([0], np.cumsum([len(p.length) for p in parts])))
        lines = Lines(np.concatenate([p.features for p in parts]), np.concatenate([p.length for p in parts]),
                      np.concatenate([[0], *[p.first[1:] + s for p, s in zip(parts, shifts)]]))
        del parts
        share = np.array([shares.get(0, 0), shares.get(1, 0)]) / np.maximum(np.bincount(label, minlength=2), 1)
        weight = share[label] * (np.diff(lines.first) > 0)
        model = fit(lines, label, weight / weight.mean())
        yield pa.RecordBatch.from_arrays([pa.array([np.ravel(x).tolist()], pa.list_(pa.float32() if kind == "float" else pa.float64()))
                                          for x, kind in zip(model, FIELDS.values())], names=list(FIELDS))

    return task


def score_documents(docs: DataFrame, model: Model | None, threshold: float = 0.3,
                    names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Every row of ``docs`` (column ``text``) with ``names`` appended: the score, and 1 if it reaches ``threshold``.

    A null or empty text, or one without words, scores 0; without a model every text with words
    scores 0.5. Columns of these names are replaced; others pass through.
    """
    docs = docs.drop(*names)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            if model is None:
                value = np.array([0.5 if t and t.strip(" \t\n\x0b\x0c\r") else 0.0 for t in texts.to_pylist()])
            else:
                value = document_scores(texts, model)
            n = batch.num_columns
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value, pa.float64()), pa.array((value >= threshold).astype(np.int32))],
                                             names=[*batch.schema.names, f"_{n}", f"_{n + 1}"])

    return with_computed(docs, score, names, ("double", "int"))
