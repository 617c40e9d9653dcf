"""Spelling variants: words that differ by one code point, found on a bit-sliced position index.

The vocabulary's words are numbered, and for every position and letter a bitset says which words have that
letter there. A query word walks over its letters once, for all words of the index at a time (64 to a machine word):

* ``zero``: words that equal the query so far; ``zero & here`` keeps those with the query's letter here;
* ``replaced``: words that differ by one replaced letter; they read the index at the query's position;
* ``longer``: words that have had one extra letter; they read it shifted, one position on.

A word leaves ``zero`` at its first difference and enters a one-error set there only, so it is reached on one
path. Words shorter by one letter are found from the other side: they are queries too.

So that the index needn't hold the whole vocabulary, words meet in blocks. Two words of m and m or m + 1 letters
that differ first in ``[lo, hi)`` share their first lo and their last m - hi letters, which is the block's key. A block with
more words than ``BLOCK_WORDS`` falls into two of half the window; at a window of one letter a block is bounded by the
alphabet. Every word is in 4 blocks (2 as the shorter or equal word, 2 as the longer one), and in more only
where blocks are split; no prefix or ending that many words share costs more than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import lower_az, written

LETTERS = r"[A-Za-zÀ-ÿ]"
BLOCK_WORDS = 4096
BLOCK_LETTERS = 1 << 22
SLICE_WORDS = 1024  # small blocks of one window share an index of about so many words
FOUND = "word string, n_near long, best_n long, best string"


class PositionIndex:
    """Bitsets over the words (rows of ``letters``, zero-padded): which have a letter at a position."""

    def __init__(self, letters: np.ndarray):
        self.n_words = len(letters)
        self.width = -(-self.n_words // 64)
        self.sets, self.row = [], []
        for p in range(letters.shape[1]):
            column = letters[:, p]
            present = np.unique(column[column > 0])
            row = np.zeros(256, np.int64)
            row[present] = np.arange(1, len(present) + 1)
            self.sets.append(np.concatenate([np.zeros((1, self.width), np.uint64), self.bits(column[None] == present[:, None])]))
            self.row.append(row)

    def bits(self, flags: np.ndarray) -> np.ndarray:
        """Rows of booleans over the words as rows of 64-bit sets."""
        packed = np.zeros((len(flags), self.width * 8), np.uint8)
        packed[:, : -(-self.n_words // 8)] = np.packbits(flags, axis=1, bitorder="little")
        return packed.view(np.uint64)

    def having(self, position: int, letter: np.ndarray) -> np.ndarray:
        """For each query's letter the set of words that have it at ``position``."""
        if position >= len(self.sets):
            return np.zeros((len(letter), self.width), np.uint64)
        return self.sets[position][self.row[position][letter]]

    def members(self, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query number and word number of every bit that is set."""
        at, byte = np.nonzero(sets.view(np.uint8))
        bit = np.unpackbits(np.ascontiguousarray(sets).view(np.uint8)[at, byte][:, None], axis=1, bitorder="little")
        which, low = np.nonzero(bit)
        return at[which], byte[which] * 8 + low


def one_error(letters: np.ndarray, sizes: np.ndarray, group: np.ndarray, m: int, lo: int, hi: int) -> tuple[np.ndarray, ...]:
    """Pairs (a, b) of word numbers of one ``group`` with a of ``m`` letters that differ by one replaced letter (first result)
    or by one extra letter of b (second), the first difference at ``lo`` or later and before ``hi`` (at the end too, if ``hi`` is m)."""
    index = PositionIndex(letters)
    query = np.flatnonzero(sizes == m)
    asked = letters[query]
    same, more = index.bits((sizes == m)[None]), index.bits((sizes == m + 1)[None])
    groups, own = np.unique(group, return_inverse=True)
    zero = index.bits(own[None] == np.arange(len(groups))[:, None])[own[query]]
    replaced, longer = np.zeros_like(zero), np.zeros_like(zero)
    for i in range(m):
        here, shifted = index.having(i, asked[:, i]), index.having(i + 1, asked[:, i])
        replaced &= here
        longer &= shifted
        if lo <= i < hi:
            differs = zero & ~here
            replaced |= differs & same
            longer |= differs & more & shifted
        zero &= here
    if hi == m:
        longer |= zero & more
    a, b = index.members(replaced)
    c, d = index.members(longer)
    return query[a], b, query[c], d


def _slice_found(words: np.ndarray, n: np.ndarray, group: np.ndarray, m: int, lo: int, hi: int) -> tuple[np.ndarray, ...]:
    sizes = np.char.str_len(words)
    letters = np.frombuffer(words.astype(f"S{m + 1}").tobytes(), np.uint8).reshape(len(words), m + 1)
    a, b, c, d = one_error(letters, sizes, group, m, lo, hi)
    whose, near = np.concatenate([a, c, d]), np.concatenate([b, d, c])  # a replaced letter is found from both sides
    place = np.empty(len(words), np.int64)  # the largest n first, then in code-point order
    by_rank = np.lexsort((words, -n))
    place[by_rank] = np.arange(len(words))
    count = np.bincount(whose, minlength=len(words))
    best = np.full(len(words), len(words))
    np.minimum.at(best, whose, place[near])
    has = np.flatnonzero(count)
    top = by_rank[best[has]]
    return words[has], count[has], n[top], words[top]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order, the rows of one together; a block may go on in the next batch."""
    def result(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        word, count, best_n, best = found
        texts = [pa.array([w.decode("latin-1") for w in x.tolist()], pa.string()) for x in (word, best)]
        return pa.RecordBatch.from_arrays([texts[0], pa.array(count, pa.int64()), pa.array(best_n, pa.int64()), texts[1]],
                                          names=["word", "n_near", "best_n", "best"])

    def blocks(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("m", "lo", "hi", "key")], 1)
        n = rows.column("n").to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1))))
        ends = np.append(starts[1:], len(keys))
        first = 0
        while first < len(starts):
            last, limit = first, min(SLICE_WORDS, max(1, BLOCK_LETTERS // int(keys[starts[first], 0] + 1)))
            while (last + 1 < len(starts) and ends[last + 1] - starts[first] <= limit
                   and (keys[starts[last + 1], :3] == keys[starts[first], :3]).all()):
                last += 1
            a, b = starts[first], ends[last]
            if b - a > 1:
                words = np.array([w.encode("latin-1") for w in rows.column("word").slice(a, b - a).to_pylist()])
                found = _slice_found(words, n[a:b], keys[a:b, 3], *(int(x) for x in keys[a, :3]))
                if len(found[0]):
                    yield result(found)
            first = last + 1

    waiting: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        waiting = rows if waiting is None else pa.concat_tables([waiting, rows])
        tail = [waiting.column(c)[waiting.num_rows - 1].as_py() for c in ("m", "lo", "hi", "key")]
        same = np.ones(waiting.num_rows, bool)
        for name, value in zip(("m", "lo", "hi", "key"), tail):
            same &= waiting.column(name).to_numpy() == value
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield from blocks(waiting.slice(0, cut))
            waiting = waiting.slice(cut).combine_chunks()
    if waiting is not None:
        yield from blocks(waiting)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row once for each half of its window, with the key of the block it is in there."""
    middle = F.expr("cast(floor((lo + hi) / 2) as int)")
    windows = F.array(F.struct(middle.alias("lo"), F.col("hi").alias("hi")), F.struct(F.col("lo").alias("lo"), middle.alias("hi")))
    halves = rows.select("word", "n", "m", F.explode(windows).alias("w")).select("word", "n", "m", "w.lo", "w.hi")
    shared = F.expr("xxhash64(m, lo, hi, left(word, lo), right(word, m - hi))")
    return halves.withColumn("key", shared)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` for each word of ``vocabulary`` (``word``, ``n``; each word once) that has near ones: words that differ by
    exactly one inserted, deleted or replaced code point. ``best`` is the one of largest n, the first in code-point order of equals."""
    longest = F.char_length("word")
    shorter = F.when(longest > 1, F.array(longest, longest - 1)).otherwise(F.array(longest))
    rows = vocabulary.where(longest > 0).select("word", "n", F.explode(shorter).alias("m"))
    rows = written(_halves(rows.select("word", "n", "m", F.lit(0).alias("lo"), F.col("m").alias("hi"))), "spelling-blocks")
    done = []
    while True:
        size = rows.groupBy("m", "lo", "hi", "key").agg(F.count("*").alias("words"), F.sum(F.char_length("word")).alias("letters"))
        large = written(size.where(f"hi - lo > 1 and (words > {BLOCK_WORDS} or letters > {BLOCK_LETTERS})").select("m", "lo", "hi", "key"), "spelling-large")
        if large.isEmpty():
            break
        done.append(rows.join(large, ["m", "lo", "hi", "key"], "left_anti"))
        rows = written(_halves(rows.join(large, ["m", "lo", "hi", "key"], "left_semi")), "spelling-blocks")
    for part in done:
        rows = rows.unionByName(part)
    found = rows.repartition("m", "key").sortWithinPartitions("m", "lo", "hi", "key").mapInArrow(_search, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.word").alias("best"))


def spelling_groups(vocabulary: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of ``vocabulary`` (``word``: code points below 256, ``n``: its count; each
    word once, no nulls).

    A word's form is its near word of largest n (ties: the smallest in code-point order) if that n is at least ``ratio`` times the word's; else null,
    as is ``form_n``. ``n_near`` counts near words (0: none). ``root`` follows forms to the last one; counts grow on the way, so there
    are no circles, and the way's length is bounded by the logarithm of the largest count. Other columns are ignored; an empty
    vocabulary gives no rows."""
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    vocabulary = written(vocabulary.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = near_words(vocabulary)
    is_form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    links = written(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-links")
    ways = links.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    while True:  # each round doubles the steps taken
        ways = written(ways, "spelling-ways")
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if ways.where("moved").isEmpty():
            break
        ways = ways.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
    return links.join(ways.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def noisy_words(rows: DataFrame, id_column: str = "doc_id", text: str = "text", min_length: int = 7, min_count: int = 2, every: int = 31) -> DataFrame:
    """``word, n``: how often each word of at least ``min_length`` code points occurs, ``min_count`` times or more.

    A word is a maximal run of Latin letters with A-Z lower-cased. Let h be the unsigned crc32 of ``<id>:<run>``; where ``every`` divides h, the
    run first loses its code point h modulo its length (planted typing errors). A null id is written as nothing; null texts have no words."""
    runs = rows.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text), F.lit(f"({LETTERS}{{{min_length},}})"), F.lit(1))).alias("run"))
    runs = runs.withColumn("run", lower_az(F.col("run")))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    lost = F.expr("cast(h % char_length(run) as int)")
    word = F.when(F.col("h") % every == 0, F.concat(F.substring("run", F.lit(1), lost), F.substring(F.col("run"), lost + 2, F.char_length("run")))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
