"""Words, hashes and shingles of a batch of texts, vectorised over the UTF-8 bytes.

A word is a maximal run of characters other than the ASCII white space 0x20 and 0x09-0x0D.
All of those are single bytes that never occur inside a multi-byte UTF-8 character, so words
can be found on the bytes of a whole batch at once; A-Z lower-casing is a byte map as well.

Word hashes are 64-bit polynomial hashes over a random byte table, computed from one prefix
sum per batch and passed through a mixing function. They identify words, shingles and n-grams
up to 64-bit collisions.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = int(_rng.integers(1, 2**61, dtype=np.uint64)) * 8 + 5
_STEP_INV = pow(_STEP, -1, 2**64)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = -(-n // (1 << 18)) << 18
        for k, base in enumerate((_STEP, _STEP_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


class Words(NamedTuple):
    """Words of one slice of texts: byte bounds, text index and hash of each, in text order;
    ``first[i]:first[i + 1]`` are the words of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes (a longer text stands alone)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = size = 0
    for i, s in enumerate(sizes):
        if i > start and size + s > limit:
            yield start, i
            start, size = i, 0
        size += int(s)
    if start < len(sizes):
        yield start, len(sizes)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts with a line feed after each, and the offset of each text (null as empty)."""
    parts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts.to_pylist()]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=offsets[1:])
    return np.frombuffer(b"\n".join(parts) + b"\n", np.uint8), offsets


def words(texts: pa.Array, lower: bool = True) -> Words:
    data, offsets = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False))  # the last byte is always white space
    start, end = edge[0::2], edge[1::2]
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:], dtype=np.uint64)
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    doc = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(doc, np.arange(len(offsets)))
    return Words(data, start, end, doc, h, first)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k consecutive words of a text and their text index. A text of fewer
    words (but one at least) has its whole sequence as its one shingle."""
    n = len(w.hash)
    if n >= k:
        h = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            h += w.hash[j : n - k + 1 + j] * _PLACE[j]
        whole = w.doc[: n - k + 1] == w.doc[k - 1 :]
        h, doc = mix(h[whole]), w.doc[: n - k + 1][whole]
    else:
        h, doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = []
        for i in short:
            own = w.hash[w.first[i] : w.first[i + 1]]
            extra.append(int((own * _PLACE[32 : 32 + len(own)]).sum(dtype=np.uint64)) ^ len(own))
        h = np.concatenate([h, mix(np.array(extra, np.uint64))])
        doc = np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    return h, doc


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of the array, in order."""
    for a, b in slices(texts):
        h, doc = shingles(words(texts.slice(a, b - a)), k)
        at = np.searchsorted(doc, np.arange(b - a + 1))
        for i in range(b - a):
            yield np.unique(h[at[i] : at[i + 1]])
