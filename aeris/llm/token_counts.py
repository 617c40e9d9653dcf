"""Token counts by the whole-token shortcut.

A tokenizer with byte-pair merges first cuts a text into pre-tokens and then merges the symbols of each
one on its own. Most pre-tokens of running text are themselves vocabulary strings, and merging those is
wasted where the outcome is known:

* offline, on the driver, every string of the vocabulary is merged once; those that come out as the one token
  that they name are *proven* whole (a string that the order of the merges can't reach is not);
* a pre-token that is proven whole counts one, by a set lookup; only the rest are merged.

Texts go through tasks in windows cut where the pre-tokenizer cuts for certain, and what a space-led
chunk of text counts is remembered for the next time, up to ``MEMO`` chunks. Nothing is shuffled. The
tokenizer's file (megabytes, whatever the number of rows) and the proven strings are all that is broadcast.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType
from tokenizers import Tokenizer

MEMO = 500_000  # remembered chunks of a Python worker
LONG = 64  # characters; longer chunks are counted again each time
WINDOW = 1 << 20  # characters of a text that are cut at a time

# Before a space that something visible follows, the byte-level pattern always starts a new pre-token: its
# letters, numbers and symbols take a space in front only, and a run of white space leaves its last character out.
SPACE = re.compile(r" (?=\S)")
# The same pattern over printable ASCII, where it needs no table of characters.
ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ A-Za-z0-9]+| +(?![^ ])| +")
# Byte-level vocabularies write a byte as a visible character: itself, or the next free one from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def whole_tokens(tokenizer: str) -> frozenset[str]:
    """The strings that alone encode as the one token of the vocabulary they name (without the mark of
    a word's end, where the vocabulary has one). ``tokenizer``: the JSON."""
    loaded = Tokenizer.from_str(tokenizer)
    end = getattr(loaded.model, "end_of_word_suffix", None) or ""
    proven = []
    for name, number in loaded.get_vocab(with_added_tokens=False).items():
        if name.endswith(end) and len(name) > len(end):
            string = name[: len(name) - len(end)]
            made = loaded.model.tokenize(string)
            if len(made) == 1 and made[0].id == number:
                proven.append(string)
    return frozenset(proven)


class _Memo(dict):
    """Counts of space-led chunks (keyed without the space), forgotten all at once when there are many."""

    def __init__(self, count: Callable[[str], int]):
        super().__init__()
        self.count = count

    def __missing__(self, chunk: str) -> int:
        n = self.count(" " + chunk)
        if len(chunk) <= LONG:
            if len(self) >= MEMO:
                self.clear()
            self[chunk] = n
        return n


class TokenCounter:
    """Counts of whole texts, without begin, end or other special tokens that a text doesn't spell out."""

    def __init__(self, tokenizer: str, whole: frozenset[str]):
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.whole, self.model = whole, self.tokenizer.model
        if self.tokenizer.pre_tokenizer is None:
            raise ValueError("the tokenizer has no pre-tokenizer: its texts don't fall into independent parts")
        described = json.loads(tokenizer)
        added = described.get("added_tokens") or []
        cuts = described["pre_tokenizer"]
        self.plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.chunked = described.get("normalizer") is None and cuts["type"] == "ByteLevel" and cuts["use_regex"] and not cuts["add_prefix_space"]
        self.memo = _Memo(self.pieces)

    def pieces(self, text: str) -> int:
        """Tokens of a text without special strings: its pre-tokens looked up, the rest merged."""
        whole, merged = self.whole, self.model.tokenize
        if self.chunked and text.isprintable():  # pre-tokens that need no library
            found = ()
            if text.isascii():
                found = ASCII.findall(text)
            elif text.lstrip(" ").isalpha() and text.rfind(" ") < 1 and max(text) < "\u0250":  # Latin letters
                found = (text.encode().decode("latin-1").translate(BYTES),)
            if found:
                return sum(1 if p in whole else len(merged(p)) for p in (p.replace(" ", "\u0120") for p in found))
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        return sum(1 if piece in whole else len(merged(piece)) for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def segment(self, text: str) -> int:
        if not self.chunked:
            return self.pieces(text)
        total, at, led = 0, 0, False
        while at < len(text) or led:
            cut = SPACE.search(text, at + WINDOW)
            chunks = SPACE.split(text[at : cut.start()] if cut else text[at:])
            if not led:
                total += self.pieces(chunks.pop(0))
            total += sum(map(self.memo.__getitem__, chunks))
            if not cut:
                break
            at, led = cut.end(), True
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.plain:  # an added token reaches beyond its own string
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        if self.special is None or not self.special.search(text):
            return self.segment(text)
        return sum(map(self.segment, filter(None, self.special.split(text)))) + sum(1 for _ in self.special.finditer(text))


@functools.lru_cache(maxsize=4)
def _counter(tokenizer: str, whole: frozenset[str]) -> TokenCounter:
    return TokenCounter(tokenizer, whole)


def count_tokens(rows: DataFrame, tokenizer: str, text: str = "text", keep: Sequence[str] = ("doc_id",), limit: int = 1024) -> DataFrame:
    """The columns ``keep`` of every row, and ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    ``tokenizer`` is the path of a tokenizer's JSON file, read on the driver only. Whole texts count, of any length; a null or
    empty text has no bytes and no tokens. A special string inside a text is the token it names. Repeated rows each give a row;
    an empty table gives none. Columns not in ``keep`` are ignored; one in ``keep`` must not be called as a result is."""
    described = Path(tokenizer).read_text(encoding="utf-8")
    model = rows.sparkSession.sparkContext.broadcast((described, whole_tokens(described)))
    source = rows.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long").alias("n_bytes"),
                         F.col(f"`{text}`").cast("string").alias("__text"))
    plain = source.toDF(*[f"_{i}" for i in range(len(source.columns))])  # columns pass through Arrow by place, whatever their names
    schema = StructType(plain.schema.fields[:-1]).add("n_tokens", LongType())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(*model.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            n = pa.array([counter.count(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n], names=schema.names)

    return plain.mapInArrow(counted, schema).toDF(*source.columns[:-1], "n_tokens").withColumn("over_limit", F.col("n_tokens") > limit)
