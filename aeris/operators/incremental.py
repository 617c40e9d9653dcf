"""Incremental marts (E1, E2, C4): late readings change the days they fall on, and nothing else is read.

Daily means keep a *state* that merges: number of rows and of values, sum, least and greatest value of each group. A batch of Bronze
records is deduplicated together with the Silver rows of its days (F1), which tells three kinds of readings apart:

* new keys: their state is added to the groups';
* replays that lose against the stored reading: nothing changes;
* records that come first in the survivor's order though they arrive later: the stored reading gives way. A least or greatest value
  can't be taken back, so the groups concerned are computed again from the day's readings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeris.functions import clamp_negative, round_half_up
from aeris.operators.gold import MEANS_KEYS
from aeris.operators.silver import DEDUP_KEYS, dedup_order, deduplicate, typed, valid_only, with_exceedance
from aeris.schemas import SILVER_COLUMNS

ORIGIN = "_origin"
STORED, ARRIVED = 0, 1
STATE_COLUMNS = [*MEANS_KEYS, "nb_mesures", "nb_valeurs", "somme", "somme_double", "minimum", "maximum", "plus_grande"]


def means_state(silver: DataFrame) -> DataFrame:
    """The mergeable state of the daily means."""
    v = clamp_negative("valeur")
    return silver.groupBy(*MEANS_KEYS).agg(
        F.count(F.lit(1)).alias("nb_mesures"), F.count(v).alias("nb_valeurs"), F.sum(v.try_cast("decimal(28,10)")).alias("somme"),
        F.sum(v).alias("somme_double"), F.min(v).alias("minimum"), F.max(v).alias("maximum"), F.max(F.abs(v)).alias("plus_grande"))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state of several, group by group."""
    parts = [s.select(*STATE_COLUMNS) for s in states]
    total = reduce(DataFrame.unionByName, parts).groupBy(*MEANS_KEYS).agg(
        F.sum("nb_mesures").alias("nb_mesures"), F.sum("nb_valeurs").alias("nb_valeurs"), F.sum("somme").alias("somme"),
        F.sum("somme_double").alias("somme_double"), F.min("minimum").alias("minimum"), F.max("maximum").alias("maximum"),
        F.max("plus_grande").alias("plus_grande"))
    return total.withColumn("somme", F.col("somme").cast("decimal(38,10)"))


def means_of_state(state: DataFrame, digits: int = 2) -> DataFrame:
    """E1 from the state: the rows that :func:`~aeris.operators.gold.daily_means` computes from the readings."""
    n = F.nullif(F.col("nb_valeurs"), F.lit(0))
    mean = F.when(F.col("plus_grande") < 1e17, F.col("somme").cast("double") / n).otherwise(F.col("somme_double") / n)
    return state.select(*MEANS_KEYS, round_half_up(mean, digits).alias("moyenne"), round_half_up(F.col("minimum"), digits).alias("minimum"),
                        round_half_up(F.col("maximum"), digits).alias("maximum"), "nb_mesures")


def arrived(bronze: DataFrame) -> DataFrame:
    """Typed, valid records of a batch in Silver's columns, deduplicated among themselves."""
    return with_exceedance(deduplicate(valid_only(typed(bronze)))).select(*SILVER_COLUMNS)


def merged_readings(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Silver of the batch's days with the batch in it, and where each survivor comes from. ``remplacee`` is the stored
    reading's group (a struct of the means' keys) where an arrived one takes its place, else null. Of equal rows the stored one stays."""
    columns = [c for c in stored.columns if c in batch.columns]
    both = stored.select(*columns, F.lit(STORED).alias(ORIGIN)).unionByName(batch.select(*columns, F.lit(ARRIVED).alias(ORIGIN)))
    by_key = Window.partitionBy(*DEDUP_KEYS)
    group = F.struct(*MEANS_KEYS)
    lost = F.max(F.when(F.col(ORIGIN) == STORED, group)).over(by_key)
    ranked = both.withColumn("_place", F.row_number().over(by_key.orderBy(*dedup_order(), F.col(ORIGIN)))).withColumn("remplacee", lost)
    survivors = ranked.where(F.col("_place") == 1).drop("_place")
    return survivors.withColumn("remplacee", F.when(F.col(ORIGIN) == ARRIVED, F.col("remplacee")))


def same_group(a: DataFrame, b: DataFrame) -> Column:
    """Equality of the means' keys, nulls equal."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in MEANS_KEYS])


def touched_groups(merged: DataFrame) -> DataFrame:
    """Groups that lost a reading to one that arrived, and the groups of the readings that took their places."""
    replaced = merged.where(F.col("remplacee").isNotNull())
    return replaced.select("remplacee.*").unionByName(replaced.select(*MEANS_KEYS)).distinct()


def updated_state(state: DataFrame, merged: DataFrame) -> DataFrame:
    """``state`` (of the batch's days) after ``merged``: new readings added, touched groups computed again."""
    touched = touched_groups(merged)
    added = merged.where((F.col(ORIGIN) == ARRIVED) & F.col("remplacee").isNull())
    kept = state.join(touched, same_group(state, touched), "left_anti")
    more = added.join(touched, same_group(added, touched), "left_anti")
    again = merged.join(touched, same_group(merged, touched), "left_semi")
    return merge_states(kept, means_state(more), means_state(again))
