"""Bronze -> Silver: typing, validity filter, deduplication, exceedance flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeris.functions import exceedance_class, finite, measurement_date, parse_source_timestamp
from aeris.schemas import SILVER_COLUMNS

DEDUP_KEYS = ["code_site", "code_polluant", "horodatage"]
# Survivor of a duplicate group: first ingested, then smallest reading, then every other column, so
# that a retried task picks the same row.
DEDUP_ORDER = ["_ingested_at", "valeur", "validite", "nom_site", "unite", "organisme", "code_zas", "zas",
               "type_implantation", "type_influence", "type_valeur", "horodatage_fin"]


def dedup_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in DEDUP_ORDER]


def day_filter(bronze: DataFrame, day: str | None) -> DataFrame:
    """Optional one-day scope. The text prefix on ``date_debut`` is the rule; when the
    Bronze partition column ``date`` is present the equivalent partition filter is added
    so the scan prunes directories."""
    if not day:
        return bronze
    out = bronze.filter(F.col("date_debut").startswith(day.replace("-", "/")))
    if "date" in bronze.columns:
        out = out.filter(F.col("date") == day)
    return out


def typed(bronze: DataFrame) -> DataFrame:
    """Reading as double, start / end timestamps, measurement day. What is parsed once and used twice has a
    projection of its own, which Catalyst then doesn't inline."""
    parsed = bronze.withColumns({
        "valeur": F.col("valeur").try_cast("double"),
        "horodatage": parse_source_timestamp("date_debut"),
        "horodatage_fin": parse_source_timestamp("date_fin"),
    })
    return parsed.withColumns({"valeur": finite("valeur"), "date_mesure": measurement_date("horodatage")})


def valid_only(df: DataFrame) -> DataFrame:
    """Drop readings flagged invalid (``-1``). A NULL flag is dropped as well."""
    return df.filter(F.col("validite") != "-1")


def deduplicate(df: DataFrame, keys: list[str] | None = None, order: list[Column] | None = None) -> DataFrame:
    """one row per key (NULL keys compare equal), the survivor chosen by ``order``.

    ``row_number() == 1`` lets Catalyst insert a partial per-partition group limit before
    the shuffle, so a hot key (replays) ships at most one row per map task."""
    keys = keys or DEDUP_KEYS
    order = order or dedup_order()
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def with_exceedance(df: DataFrame) -> DataFrame:
    """B8-B9 on the hourly, unclamped reading."""
    return df.withColumn("depassement", exceedance_class("valeur", "code_polluant"))


def clean_measurements(bronze: DataFrame, day: str | Column | None = None, processed_at: bool = True,
                       observe_input=None) -> DataFrame:
    """Bronze records -> Silver measurements.

    ``day``: a day as text, or a date column (such as a scalar subquery). Either way other days are
    dropped before the deduplication: the day is a function of its key.

    ``observe_input``: an ``Observation`` that collects, during the same job, the rows in
    scope and the invalid / valid counts before deduplication (E15 without extra passes)."""
    by_column = isinstance(day, Column)
    t = typed(bronze if by_column else day_filter(bronze, day))
    if by_column:
        t = t.filter(F.col("date_mesure") == day)
    if observe_input is not None:
        t = t.observe(observe_input, F.count(F.lit(1)).alias("rows_in_scope"),
                      F.count_if(F.col("validite") == "-1").alias("rows_invalid"),
                      F.count_if(F.col("validite") != "-1").alias("rows_valid"))
    df = deduplicate(valid_only(t))
    df = with_exceedance(df).select(*SILVER_COLUMNS)
    return df.withColumn("_processed_at", F.current_timestamp()) if processed_at else df


def hourly_measurements(readings: DataFrame) -> DataFrame:
    """Typed readings in the shape of the hourly measurement table (before its key is enforced)."""
    return with_exceedance(readings).select(
        F.col("code_site").alias("code_station"), "code_polluant", "horodatage", "valeur",
        F.col("validite").try_cast("smallint").alias("validite"), "depassement", "_ingested_at")


def exceedance_distribution(silver: DataFrame) -> DataFrame:
    """Rows per exceedance class, NULL class included."""
    return silver.groupBy("depassement").agg(F.count(F.lit(1)).alias("nb"))


def run_metrics(bronze: DataFrame, day: str | None = None) -> DataFrame:
    """Rows read, rows in scope, invalid rows, duplicates removed, rows written - in one
    pass (one conditional aggregate) instead of one count job per figure."""
    t = typed(bronze)
    in_scope = F.lit(True)
    if day:
        in_scope = F.coalesce(F.col("date_debut").startswith(day.replace("-", "/")), F.lit(False))
    invalid = in_scope & F.coalesce(F.col("validite") == "-1", F.lit(False))
    kept = in_scope & F.coalesce(F.col("validite") != "-1", F.lit(False))
    key = F.when(kept, F.struct(*[F.col(k) for k in DEDUP_KEYS]))
    m = t.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(in_scope).alias("rows_in_scope"),
        F.count_if(invalid).alias("rows_invalid"),
        F.count_if(kept).alias("rows_valid"),
        F.count_distinct(key).alias("rows_written"),
    )
    return m.withColumn("duplicates_removed", F.col("rows_valid") - F.col("rows_written"))
