"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

Every source is a queue of its documents in a shuffled (hash) order, repeated up to
``max_repeats`` times. A document's virtual finish time is the cumulative number of source
tokens up to and with it, divided by the source's target. Serving all queues by virtual finish
time interleaves the sources in proportion to their targets; the mix is the prefix of that
global order that the total budget allows.

Scale: the text is read once, into a narrow written table, in which equal rows are one row with a count (a partial
aggregate). A source's running total is taken in two levels (hash buckets, then within a bucket), so a source that
holds a third of the rows is spread over 16 ** ``BUCKET_DIGITS`` buckets, and a repeated row costs a bucket one row; it is written
out again in runs of ``RUN``. The global cut works the same way on ``BINS`` equal ranges of the
finish time: only the documents of the one range that holds the cut are put in exact order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeris.llm.common import n_words, quoted, spread, written

BUCKET_DIGITS = 3
BINS = 4096
RUN = 10_000  # equal rows that one task writes out
SALTS = 64


def cycle_weights(weights: Sequence[float]) -> Column:
    """Weight of the row's ``source_rank`` (from 1), repeating the given cycle."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return F.element_at(cycle, ((F.col("source_rank") - 1) % len(weights) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """``source, source_size, weight, target`` per source.

    The targets share the total of all sizes by weight; a target stops at ``max_repeats`` times
    its source's size and the excess is shared again by weight among the others until none is
    above. That fixed point is found in one pass: in the order of cap / weight, the capped
    sources are those whose cap lies below the share that the remaining words give them."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per_source = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("source_rank", F.row_number().over(by_name))
        .withColumn("weight", cycle_weights(weights))
        .withColumn("cap", F.col("source_size") * max_repeats)
    )
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("weight"), "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    level = F.when(F.col("left_weight") > 0, F.col("left_words") / F.col("left_weight"))
    return (
        per_source
        .withColumn("left_words", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(filled), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0)))
        .withColumn("capped", F.col("cap") <= level * F.col("weight"))
        .withColumn("level", F.max(F.when(~F.col("capped"), level)).over(everything))  # that of the first uncapped one
        .withColumn("target", F.when(F.col("capped") | F.col("level").isNull(), F.col("cap").cast("double"))
                    .otherwise(F.col("level") * F.col("weight")))
        .select("source", "source_size", "weight", "target")
    )


def mix(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), max_repeats: int = 3,
        seed: str = "mix", mark: Column | None = None) -> DataFrame:
    """All rows of ``docs`` (``doc_id, text, source``) as
    ``doc_id, source, size, source_size, target, taken, repeats`` (and ``mark``, an expression of the row
    that tells rows of one id apart).

    ``size`` is the number of words (a null or empty text: 0, never taken), ``repeats`` how often
    the mix takes the row and ``taken`` the words that makes. A null source is a source of its
    own, last in order; null ids and repeated rows are ordinary rows. The order within a source
    comes from an MD5 of seed and id, then id, size and mark, so reruns agree. The budget is the sum
    of all sizes; the last document is taken if it starts within it. Extra columns are ignored; an empty table gives no rows.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), digest.alias("place"),
                       (F.lit(None).cast("long") if mark is None else mark).alias("mark"))
    rows = written(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "mix-sizes")
    words = F.col("size") * F.col("copies")
    targets = source_targets(rows.select("source", words.alias("size")), weights, max_repeats).withColumnRenamed("source", "of")

    # rows without an id have one place; in its bucket they have buckets of their own, in the same order
    nameless, theirs = F.col("doc_id").isNull(), hashlib.md5(f"{seed}|null".encode()).hexdigest()
    side = F.when(nameless, 1).when(F.col("place") < theirs, 0).otherwise(2)
    high_bits = F.coalesce(F.shiftright("mark", 54), F.lit(0).cast("long"))
    rows = rows.withColumn("bucket", F.struct(
        F.conv(F.substring("place", 1, BUCKET_DIGITS), 16, 10).cast("int").alias("place"), side.alias("side"),
        F.when(nameless, F.col("size")).otherwise(0).alias("size"), F.when(nameless, high_bits).otherwise(0).alias("mark")))
    before = Window.partitionBy("of").orderBy("in_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(F.col("source").alias("of"), F.col("bucket").alias("in_bucket")).agg(F.sum(words).alias("words"))
        .withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .drop("words")
    )
    starts = starts.join(targets.withColumnRenamed("of", "source_of"), F.col("of").eqNullSafe(F.col("source_of"))).drop("source_of")
    within = (Window.partitionBy("source", "bucket").orderBy("place", F.col("doc_id").asc_nulls_first(), "size", "mark")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    queued = (
        _written_out(rows.withColumn("upto", F.sum(words).over(within)))
        .join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in_bucket")))
        .withColumn("upto", F.col("upto") + F.col("offset"))
        .select("doc_id", "source", "size", "source_size", "target", "place", "upto", "mark")
    )
    queued = written(queued, "mix-queues")

    passes = F.expr(f"transform(sequence(0, {max_repeats - 1}), e -> (e * source_size + upto) / nullif(target, 0))")
    served = queued.where("size > 0").select("doc_id", "place", "size", F.explode(passes).alias("finish"))
    served = served.withColumn("bin", F.floor(F.least("finish", F.lit(2.0)) * BINS).cast("int"))
    budget = queued.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("budget"))
    so_far = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (
        served.groupBy("bin").agg(F.sum("size").alias("words"))
        .withColumn("served", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
    )
    last = bins.where(F.col("served") < budget.scalar()).agg(F.max_by(F.struct("bin", "served"), "bin").alias("last"))
    order = Window.orderBy("finish", "place", F.col("doc_id").asc_nulls_first(), "size")
    cut = (
        served.where(F.col("bin") == last.select("last.bin").scalar())
        .withColumn("served", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .where(F.coalesce(F.col("served"), F.lit(0)) + last.select("last.served").scalar() < budget.scalar())
        .agg(F.max(F.struct("finish", "place")).alias("cut"))
    )
    before_cut = F.expr("size(filter(times, t -> size > 0 and (t < cut.finish or (t = cut.finish and place <= cut.place))))")
    return (
        queued.withColumn("times", passes).withColumn("cut", cut.scalar())
        .withColumn("repeats", F.coalesce(F.when(F.col("cut").isNotNull(), before_cut), F.lit(0)).cast("int"))
        .withColumn("taken", F.col("size") * F.col("repeats"))
        .select("doc_id", "source", "size", "source_size", "target", "taken", "repeats", *([] if mark is None else ["mark"]))
    )


def _written_out(groups: DataFrame) -> DataFrame:
    """Each row of ``groups`` ``copies`` times; ``upto``, the total up to and with them all, becomes each copy's own."""
    runs = groups.withColumn("run", F.explode(F.expr(f"sequence(0L, (copies - 1) div {RUN})")))
    long_ = spread(runs.where(F.col("copies") > RUN), "place", "run")  # a large group's runs go to different tasks
    each = runs.where(F.col("copies") <= RUN).unionByName(long_).withColumn("copy", F.explode(F.expr(f"sequence(run * {RUN} + 1, least(copies, (run + 1) * {RUN}))")))
    return each.withColumn("upto", F.expr("upto - (copies - copy) * size")).drop("run", "copy", "copies")


def mixed_rows(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), max_repeats: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` takes it, all columns as they are.

    Rows equal in id, source and text share what the mix takes of them evenly."""
    mark = F.xxhash64("text", "source")
    taken = mix(docs.select("doc_id", "text", "source"), weights, max_repeats, seed, mark)
    taken = (
        taken.groupBy(F.col("doc_id").alias("of_id"), F.col("mark").alias("of_mark"))
        .agg(F.sum("repeats").alias("times"), F.count("*").alias("n")).where("times > 0")
    )
    marked = docs.select(F.struct(*quoted(docs.columns)).alias("row"), F.col("doc_id").alias("own_id"), mark.alias("own_mark"),
                         F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"))
    found = marked.join(taken, F.col("own_id").eqNullSafe(F.col("of_id")) & (F.col("own_mark") == F.col("of_mark")))
    alone = found.where("n = 1").select("row", F.col("times").cast("int").alias("times"))
    # equal rows are numbered in SALTS parts, and a part's first number is the rows of the parts before it
    shared = written(found.where("n > 1"), "mix-shared")
    by_salt = Window.partitionBy("of_id", "of_mark").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = shared.groupBy("of_id", "of_mark", "salt").agg(F.count("*").alias("here")).withColumn("before", F.coalesce(F.sum("here").over(by_salt), F.lit(0)))
    first = first.select(F.col("of_id").alias("id_"), F.col("of_mark").alias("mark_"), F.col("salt").alias("salt_"), "before")
    here = F.row_number().over(Window.partitionBy("of_id", "of_mark", "salt").orderBy("of_mark"))
    numbered = shared.withColumn("here", here).join(first, F.col("of_id").eqNullSafe(F.col("id_")) & (F.col("of_mark") == F.col("mark_")) & (F.col("salt") == F.col("salt_")))
    nth = F.col("before") + F.col("here")
    shared = numbered.select("row", (F.floor(F.col("times") / F.col("n")) + F.when(nth <= F.col("times") % F.col("n"), 1).otherwise(0)).cast("int").alias("times"))
    return alone.unionAll(shared).select("row", F.explode(F.expr("array_repeat(0, times)"))).select("row.*")
