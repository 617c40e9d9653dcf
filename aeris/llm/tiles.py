"""Queries meet blocks of rows in tiles of bounded size, in one shuffle on (block, part)."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERY_ROWS = 2048


def searched(asking: DataFrame, rows: DataFrame, search: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``search(queries, rows)`` for each tile: the queries of ``asking`` (``vec_id, block, ...``) routed to a block and the block's
    rows (``block, ...``), of bounded number. Queries of one block are cut into parts of about ``QUERY_ROWS``, and the block is
    sent once for each of its own parts: what is shuffled grows with the pairs of blocks and queries that a bound couldn't
    rule out. Blocks that nobody asks aren't sent. ``asking`` is read twice: write it before."""
    parts = asking.groupBy("block").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    asked = asking.join(parts, "block").withColumn("part", part).drop("parts")
    sent = rows.join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return asked.groupBy("block", "part").cogroup(sent.groupBy("block", "part")).applyInArrow(search, schema)
