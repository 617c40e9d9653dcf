"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent letter n-grams (one to three letters, words padded
with a boundary) of all training texts of a language, in order of count. A text's own most
frequent n-grams are compared with each profile by the out-of-place distance: the sum over the
text's n-grams of the difference of the two ranks, or of the profile length where the profile
lacks the n-gram. The nearest profile wins.

Scale: n-grams are counted in each task over flat arrays and summed per (language, n-gram) before
the shuffle, so a task sends at most its distinct n-grams. Only the profiles (``profile_size``
rows a language) reach the driver. Prediction is a map over the texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeris.llm.common import with_computed

UNDETERMINED = "und"
CHUNK = 1 << 20  # characters worked on at once
BITS = 18  # of a letter's number in an n-gram code

_letters: list[np.ndarray] = []


def letter_numbers() -> np.ndarray:
    """Number from 1 of every letter by code point, 0 for all other characters."""
    if not _letters:
        is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        _letters.append(np.where(is_letter, np.cumsum(is_letter), 0).astype(np.int32))
    return _letters[0]


def gram_text(code: int) -> str:
    """The n-gram of a code, for people: ``_`` is a word boundary."""
    letters = np.flatnonzero(letter_numbers())
    n = code >> (3 * BITS)
    digits = [(code >> (BITS * i)) & ((1 << BITS) - 1) for i in reversed(range(n))]
    return "".join(chr(letters[d - 1]) if d else "_" for d in digits)


def _pieces(text: str) -> Iterator[str]:
    """The text lower-cased in chunks that end between words (a longer run of letters is cut)."""
    start = 0
    while start < len(text):
        end = min(len(text), start + CHUNK)
        while end < len(text) and end > start and text[end - 1].isalpha():
            end -= 1
        end = end if end > start else start + CHUNK
        yield text[start:end].lower()
        start = end


class Grams:
    """The n-grams of several texts. Letters are renumbered densely, so that codes are small.
    A dense code grows with the general code, so ties sort alike everywhere."""

    def __init__(self, texts: list[str]):
        """``texts`` lower-cased."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        number = letter_numbers()[np.minimum(flat, 0x10FFFF)]
        keep = (number > 0) | (np.concatenate(([1], number[:-1])) > 0)
        keep[0] = True
        starts = 1 + np.concatenate(([0], np.cumsum(lengths + 1)))  # of each text's characters
        place = np.cumsum(keep) - 1
        self.first = place[starts[:-1]]
        self.last = place[starts[1:] - 1]  # the separator behind the text, or the one it was merged into
        number = number[keep]
        self.present = np.flatnonzero(np.bincount(number))
        if not len(self.present) or self.present[0] != 0:
            self.present = np.concatenate(([0], self.present))
        dense = np.zeros(self.present[-1] + 1, np.int64)
        dense[self.present] = np.arange(len(self.present))
        self.c = dense[number]
        a = self.base = len(self.present)
        kind = np.int32 if a**3 + a**2 + a < 2**31 else np.int64
        c = self.c
        self.two = (c[:-1] * a + c[1:] + a).astype(kind)
        self.three = (np.concatenate(([0], c[:-1])) * a * a + c * a + np.concatenate((c[1:], [0])) + a + a * a).astype(kind)
        self.one = c.astype(kind)

    def of(self, i: int) -> np.ndarray:
        """Dense codes of all n-grams of text i."""
        lo, hi = self.first[i], self.last[i]
        at = lo + np.flatnonzero(self.c[lo : hi + 1] > 0)
        before = at[self.c[at - 1] == 0] - 1
        return np.concatenate((self.one[at], self.two[np.concatenate((before, at))], self.three[at]))

    def codes(self, dense: np.ndarray) -> np.ndarray:
        """General codes of dense ones: the number of letters, then each letter's number."""
        a = self.base
        dense = dense.astype(np.int64)
        n = 1 + (dense >= a) + (dense >= a + a * a)
        rest = dense - np.where(n > 1, a, 0) - np.where(n > 2, a * a, 0)
        out = n.astype(np.int64) << (3 * BITS)
        for i in range(3):
            digit = rest // a**i % a
            out |= np.where(i < n, self.present[digit], 0) << (BITS * i)
        return out


def _counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.sort(x)
    start = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)
    return x[start], np.diff(np.concatenate((start, [len(x)])))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)


def _long_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts of one long text, chunk by chunk."""
    total = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for piece in _pieces(text):
        g = Grams([piece])
        codes, counts = _counted(g.of(0))
        total = _merged([total, (g.codes(codes), counts)])
    return total


def _batches(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and lower-cased texts of the rows up to CHUNK characters, in groups of about that."""
    rows, group, size = [], [], 0
    for i, t in enumerate(texts):
        if t and len(t) <= CHUNK:
            if size + len(t) > CHUNK and rows:
                yield rows, group
                rows, group, size = [], [], 0
            rows.append(i)
            group.append(t.lower())
            size += len(t)
    if rows:
        yield rows, group


def text_counts(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, Grams | None]]:
    """Row number, n-gram codes (ascending; dense ones of the Grams returned, else general ones) and
    counts of every text that is not null or empty."""
    for rows, group in _batches(texts):
        g = Grams(group)
        for i, row in enumerate(rows):
            codes, counts = _counted(g.of(i))
            yield row, codes, counts, g
    for row, t in enumerate(texts):
        if t and len(t) > CHUNK:
            yield row, *_long_counts(t), None


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, list] = {}
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        by_lang: dict[str, list[str]] = {}
        for t, lang in zip(texts, langs):
            if t and lang is not None:
                by_lang.setdefault(lang, []).append(t)
        for lang, own in by_lang.items():
            parts = totals.setdefault(lang, [])
            for _, group in _batches(own):
                g = Grams(group)
                dense = np.concatenate([g.of(i) for i in range(len(group))])
                table = np.bincount(dense)
                codes = np.flatnonzero(table)
                parts.append((g.codes(codes), table[codes]))
            parts.extend(_long_counts(t) for t in own if len(t) > CHUNK)
            totals[lang] = [_merged(parts)]
    for lang, parts in totals.items():
        codes, counts = parts[0]
        for i in range(0, len(codes), 50_000):
            own = codes[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own), pa.array(counts[i : i + 50_000])],
                                             names=["lang", "gram", "n"])


def learn_profiles(docs: DataFrame, profile_size: int = 400) -> dict[str, np.ndarray]:
    """Profile of each non-null ``lang`` of ``docs`` (``text, lang``): its ``profile_size`` most frequent
    n-gram codes, most frequent first, ties by code. Languages without any letter have none."""
    counts = docs.select("text", "lang").mapInArrow(_count_task, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = (
        counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= profile_size)
    )
    profiles: dict[str, list[tuple[int, int]]] = {}
    for r in top.collect():  # profile_size rows a language
        profiles.setdefault(r["lang"], []).append((r["place"], r["gram"]))
    return {lang: np.array([g for _, g in sorted(own)], np.int64) for lang, own in sorted(profiles.items())}


def out_of_place(grams: np.ndarray, sorted_profile: np.ndarray, places: np.ndarray) -> int:
    """Distance of a ranked list of n-grams to a profile given in order of code with each code's rank."""
    i = np.minimum(np.searchsorted(sorted_profile, grams), len(sorted_profile) - 1)
    found = sorted_profile[i] == grams
    return int(np.where(found, np.abs(places[i] - np.arange(len(grams))), len(places)).sum())


def predict_languages(docs: DataFrame, profiles: dict[str, np.ndarray], text_size: int = 300,
                      names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Every row of ``docs`` (column ``text``) with ``names`` (language and score) appended.

    A text's ``text_size`` most frequent n-grams (of all of the text) are ranked by count, then code.
    ``score`` is 1 minus the distance over the largest possible one. Ties go to the first language
    by code point. Null, empty and letterless texts, or no profiles at all: ``und`` with score 0.
    Columns of these names are replaced; others pass through.
    """
    languages = sorted(profiles)
    tables = [(np.sort(p), np.argsort(p, kind="stable")) for p in (profiles[x] for x in languages)]
    docs = docs.drop(*names)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
            if tables:
                for row, codes, counts, g in text_counts(batch.column("text").to_pylist()):
                    if not len(codes):
                        continue
                    top = np.argsort(-counts, kind="stable")[:text_size]
                    grams = codes[top] if g is None else g.codes(codes[top])
                    far = [out_of_place(grams, *t) / (len(grams) * len(t[0])) for t in tables]
                    k = int(np.argmin(far))
                    best[row], score[row] = languages[k], 1 - far[k]
            n = batch.num_columns
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(score)],
                                             names=[*batch.schema.names, f"_{n}", f"_{n + 1}"])

    return with_computed(docs, predict, names, ("string", "double"))
