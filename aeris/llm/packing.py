"""Packing documents into training sequences of several permitted lengths.

Variable-capacity best fit: a piece goes to the open bin with the least room that still holds it.
Where none does, a new bin is opened in the permitted size of least cost per word that can still
be filled. How large to open is decided jointly for a group of pieces: each permitted size is
tried as the least one to open, every bin is finally cut down to the smallest permitted size
that holds its contents, and the cheapest outcome stays.

Scale: whole-length pieces of long documents fill bins of their own without any packing. The others
are dealt at random into groups of about ``GROUP_ROWS`` rows, packed independently of each other; a
group of thousands of pieces packs as tightly as the whole, and no task holds more. Copies,
hot sources and null ids don't matter to the deal.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import n_words, written

CAPACITIES = (512, 1024, 2048, 4096)
GROUP_ROWS = 4096


def sequence_cost(capacity: int) -> float:
    """Cost of one sequence: its positions, and attention that grows with their square."""
    return capacity * (1 + capacity / 32768)


def best_fit(sizes: Sequence[int], capacities: Sequence[int], cost: Callable[[int], float] = sequence_cost,
             least: int = 0) -> tuple[list[int], list[int], list[int], float]:
    """Pack ``sizes`` (descending, none above the largest capacity), opening bins of ``least`` at
    least: bin and offset of each piece, final capacity of each bin, total cost."""
    capacities = sorted(capacities)
    rest = sum(sizes)
    rooms: list[tuple[int, int]] = []  # (room, bin) of the open bins, ascending
    bins, offsets, used, opened = [], [], [], []
    for size in sizes:
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            fit = [c for c in capacities if c >= max(size, least)] or [capacities[-1]]
            room = min(fit, key=lambda c: (cost(c) / min(c, rest), c))
            b = len(used)
            used.append(0)
            opened.append(room)
        bins.append(b)
        offsets.append(used[b])
        used[b] += size
        rest -= size
        if room > size:
            bisect.insort(rooms, (room - size, b))
    final = [capacities[bisect.bisect_left(capacities, u)] for u in used]
    return bins, offsets, final, sum(map(cost, final))


def pack_group(sizes: Sequence[int], capacities: Sequence[int], cost: Callable[[int], float] = sequence_cost):
    """The cheapest of ``best_fit`` over the least size to open (the smallest such size on ties)."""
    return min((best_fit(sizes, capacities, cost, least) for least in sorted(capacities)), key=lambda x: x[3])


def pack(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pieces of all rows of ``docs`` (``doc_id, text``) with their places:
    ``doc_id, piece, start, n_words, bin_id, capacity, bin_offset, bin_words``.

    Words ``start`` to ``start + n_words`` of the document lie in bin ``bin_id`` from
    ``bin_offset`` on; the bin has ``capacity`` positions, ``bin_words`` of them used. A document
    longer than the largest capacity is cut into pieces of that length and a rest. A null
    or wordless text is one row of 0 words with no bin (null). Repeated rows and null ids are
    packed like any other. Extra columns are ignored; an empty table gives no rows.
    """
    largest = max(capacities)
    rows = written(docs.select("doc_id", n_words(F.col("text")).alias("size")).withColumn("row", F.monotonically_increasing_id()), "pack-sizes")
    pieces = (
        rows.select("row", "doc_id", "size", F.explode(F.expr(f"sequence(0, greatest(cast(ceil(size / {largest}) as int) - 1, 0))")).alias("piece"))
        .withColumn("start", (F.col("piece") * F.lit(largest).cast("long")))
        .withColumn("n_words", F.least(F.col("size") - F.col("start"), F.lit(largest)).cast("long"))
    )
    whole = pieces.where((F.col("n_words") == largest) | (F.col("n_words") == 0))
    filled = F.col("n_words") > 0
    out = ["doc_id", "piece", "start", "n_words", "bin_id", "capacity", "bin_offset", "bin_words"]
    whole = (
        whole.withColumn("bin_id", F.when(filled, F.concat_ws("-", F.lit("whole"), "row", "piece")))
        .withColumn("capacity", F.when(filled, F.lit(largest))).withColumn("bin_offset", F.when(filled, F.lit(0).cast("long")))
        .withColumn("bin_words", F.when(filled, F.col("n_words"))).select(out)
    )
    rest = pieces.where((F.col("n_words") < largest) & filled)
    n_groups = max(1, -(-rows.count() // group_rows))  # a row has one rest at most

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by([("n_words", "descending"), ("row", "ascending")])
        sizes = group.column("n_words").to_numpy()
        bins, offsets, final, _ = pack_group(sizes.tolist(), capacities)
        at, name = np.array(bins), group.column("grp")[0].as_py()
        added = {"bin_id": pa.array([f"{name}-{b}" for b in bins]), "capacity": pa.array(np.array(final, np.int32)[at]),
                 "bin_offset": pa.array(np.array(offsets, np.int64)), "bin_words": pa.array(np.bincount(at, sizes).astype(np.int64)[at])}
        for column, values in added.items():
            group = group.append_column(column, values)
        return group.select(out)

    kind = dict(docs.dtypes)["doc_id"]
    return (
        rest.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(n_groups)).cast("int"))
        .select("grp", "row", "doc_id", "piece", "start", "n_words").groupBy("grp")
        .applyInArrow(packed, f"doc_id {kind}, piece int, start long, n_words long, bin_id string, capacity int, bin_offset long, bin_words long")
        .unionByName(whole)
    )
