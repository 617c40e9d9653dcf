"""Sharding on a consistent-hash ring with virtual nodes and bounded loads. DataFrame functions only.

Each shard owns ``vnodes`` points of a ring of 2**32 positions; a point owns the arc that ends at
it. A row goes to the shard of its arc while that shard has room: capacity is ``1 + slack`` times
the mean load. What a full shard cannot hold continues clockwise to the next point whose shard
has room. A row that crosses the end of a piece goes to the side that holds its middle, so a shard
exceeds its capacity by half a row for each such end at most, and only overflowing rows move.

Only arc totals reach the driver: ``shards * vnodes`` rows at most, whatever the data. The walk
turns them into pieces ``(arc, from, to, shard)`` of each arc's running total of bytes; the
pieces, again bounded by the ring, are broadcast to the rows. Rows equal in id and text have one place; they are a group with a
count, from a partial aggregate, until they are written out again in runs of ``RUN`` rows. So an arc's running
total goes over its distinct rows, about 1 / (shards * vnodes) of them all, however often one is repeated.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeris.llm.common import spread, written

RING = 1 << 32
RUN = 10_000  # equal rows that one task writes out
PIECES = T.StructType([T.StructField("of_arc", T.IntegerType()), T.StructField("since", T.LongType()),
                       T.StructField("until", T.LongType()), T.StructField("shard", T.IntegerType())])


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """Sorted ``(position, shard)`` of all virtual nodes."""
    points = {int(hashlib.md5(f"shard-{s}-{v}".encode()).hexdigest()[:8], 16): s
              for s in range(shards) for v in range(vnodes)}
    return sorted(points.items())


def walk(points: list[tuple[int, int]], loads: dict[int, int], shards: int, slack: float) -> list[tuple[int, int, int, int]]:
    """Cut each arc's load into pieces ``(arc, since, until, shard)``.

    First every shard accepts its own arcs in ring order up to capacity; then each arc's rest
    continues clockwise from its point, in ring order of the arcs."""
    capacity = max(1, int(sum(loads.values()) * (1 + slack) / shards) + 1)
    room = [capacity] * shards
    pieces, rest = [], []
    for arc, (_, shard) in enumerate(points):
        load = loads.get(arc, 0)
        fits = min(load, room[shard])
        room[shard] -= fits
        if fits:
            pieces.append((arc, 0, fits, shard))
        if load > fits:
            rest.append((arc, fits, load))
    following = list(range(1, len(points) + 1))  # the next point worth asking, with path compression

    def open_point(i: int) -> int:
        seen = []
        while room[points[i % len(points)][1]] <= 0:
            seen.append(i % len(points))
            i = following[i % len(points)]
        for s in seen:
            following[s] = i % len(points)
        return i % len(points)

    for arc, since, load in rest:
        at = (arc + 1) % len(points)
        while since < load:
            at = open_point(at)
            shard = points[at][1]
            fits = min(load - since, room[shard])
            room[shard] -= fits
            pieces.append((arc, since, since + fits, shard))
            since += fits
    return pieces


def shard_rows(docs: DataFrame, shards: int = 24, vnodes: int = 256, slack: float = 0.001) -> DataFrame:
    """Every row of ``docs`` (``doc_id, text``) as ``doc_id, size, text_crc32, arc, shard, slot``.

    ``size`` is the UTF-8 length of the text plus 8 (a null text: 8), ``text_crc32`` its unsigned
    CRC-32 (a null text: that of the empty text). The position of a row is a hash of id and, so
    that null or repeated ids with different texts do not meet at one place, of its CRC. ``slot`` numbers the rows of a
    shard from 0 without gaps. Reruns agree up to the order of rows equal in all three columns.
    Extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    points = ring_points(shards, vnodes)
    starts = [p for p, _ in points]
    body = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text_crc32").cast("string")))
    rows = (
        docs.select("doc_id", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
        .withColumn("place", F.conv(F.substring(key, 1, 8), 16, 10).cast("long"))
    )
    # the arc of a place: points are looked up by the place's top bits, then counted within that cell
    cells = 1 << 12
    first = [bisect.bisect_left(starts, c * (RING // cells)) for c in range(cells + 1)]
    longest = max(b - a for a, b in zip(first, first[1:]))
    cell = F.floor(F.col("place") / (RING // cells)).cast("int")
    constants = lambda xs: F.expr(f"cast(split('{','.join(map(str, xs))}', ',') as array<bigint>)")
    at_cell = F.element_at(constants(first), cell + 1).cast("int")
    limits = constants(starts + [RING] * (longest + 1))
    in_cell = sum(((F.element_at(limits, at_cell + 1 + j) < F.col("place")).cast("int") for j in range(longest)), F.lit(0))
    rows = rows.withColumn("arc", ((at_cell + in_cell) % len(points)).cast("int"))
    groups = written(rows.groupBy("arc", "place", "doc_id", "text_crc32", "size").agg(F.count("*").alias("copies")), "ring-groups")

    load = F.col("size") * F.col("copies")
    loads = {r["arc"]: r["load"] for r in groups.groupBy("arc").agg(F.sum(load).alias("load")).collect()}  # one row per arc
    pieces = F.broadcast(spark.createDataFrame(walk(points, loads, shards, slack), PIECES))  # bounded by the ring

    order = ["place", F.col("doc_id").asc_nulls_first(), "text_crc32", "size"]
    running = Window.partitionBy("arc").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # copy j of a group begins at before + j * size; a piece has the copies whose middles lie in it
    copies_until = lambda end: F.ceil((F.col(end) - F.col("before") - F.floor(F.col("size") / 2)) / F.col("size")).cast("long")
    parts = (
        groups.withColumn("before", F.sum(load).over(running) - load).join(pieces, F.col("arc") == F.col("of_arc"))
        .withColumn("low", F.greatest(copies_until("since"), F.lit(0))).withColumn("high", F.least(copies_until("until"), F.col("copies")))
        .where("low < high").withColumn("n", F.col("high") - F.col("low"))
    )
    earlier_here = Window.partitionBy("arc", "shard").orderBy("before", "low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = written(parts.withColumn("nth", F.sum("n").over(earlier_here) - F.col("n"))
                    .select("doc_id", "size", "text_crc32", "arc", "shard", "n", "nth"), "ring-parts")
    earlier = Window.partitionBy("to_shard").orderBy("of_arc").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(F.col("arc").alias("of_arc"), F.col("shard").alias("to_shard")).agg(F.sum("n").alias("rows"))
        .withColumn("offset", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).drop("rows")
    )
    placed = parts.join(F.broadcast(offsets), (F.col("arc") == F.col("of_arc")) & (F.col("shard") == F.col("to_shard")))  # bounded by the ring
    runs = placed.withColumn("run", F.explode(F.expr(f"sequence(0L, (n - 1) div {RUN})")))
    long_ = spread(runs.where(F.col("n") > RUN), "arc", "shard", "run")  # a large group's runs go to different tasks
    return (
        runs.where(F.col("n") <= RUN).unionByName(long_)
        .withColumn("copy", F.explode(F.expr(f"sequence(run * {RUN}, least(n, (run + 1) * {RUN}) - 1)")))
        .withColumn("slot", (F.col("offset") + F.col("nth") + F.col("copy")).cast("long"))
        .select("doc_id", "size", "text_crc32", "arc", "shard", "slot")
    )
