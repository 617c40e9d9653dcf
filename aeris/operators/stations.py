"""Station reference: distinct stations, commune extraction, geocoding join, upsert,
seed insert, coverage (F2, B14-B16, D3-D5, E14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.constants import POLLUTANT_SEED
from aeris.functions import geo_point, with_commune
from aeris.operators.joins import left_join_dimension
from aeris.schemas import POLLUTANT_SCHEMA

STATION_ATTRS = ["nom_site", "organisme", "code_zas", "zas", "type_implantation", "type_influence"]
UPSERT_COLUMNS = ["nom", "type_station", "type_influence", "latitude", "longitude"]


def distinct_stations(readings: DataFrame) -> DataFrame:
    """one row per ``code_site`` of valid readings, deduplicated or not (any reading names the
    station). The survivor is the smallest attribute tuple, so the result is deterministic; ``min``
    aggregates partially before the shuffle."""
    best = F.min(F.struct(*[F.col(c) for c in STATION_ATTRS])).alias("_s")
    return readings.groupBy("code_site").agg(best).select("code_site", *[F.col(f"_s.{c}").alias(c) for c in STATION_ATTRS])


def gazetteer_by_commune(gazetteer: DataFrame) -> DataFrame:
    """One gazetteer entry per lower-case commune (smallest label first), i.e. the lookup
    the geocoder would cache."""
    g = gazetteer.withColumn("_key", F.lower("commune"))
    best = F.min(F.struct("label", "contexte", "longitude", "latitude")).alias("_g")
    return g.groupBy("_key").agg(best).select(
        "_key", F.col("_g.label").alias("commune_label"), F.col("_g.contexte").alias("contexte"),
        F.col("_g.longitude").alias("longitude"), F.col("_g.latitude").alias("latitude"))


def geocode(stations: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """D3: commune from the station name (B14), looked up once per distinct lower-case
    commune in the gazetteer (left equi-join; Catalyst / AQE broadcast the gazetteer side
    when its size is under the threshold, sort-merge otherwise)."""
    s = with_commune(stations, "nom_site", "zas", "commune_extraite")
    s = s.withColumn("_key", F.lower("commune_extraite"))
    out = left_join_dimension(s, gazetteer_by_commune(gazetteer), "_key").drop("_key")
    return out.withColumn("geocode_ok", F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def to_station_rows(records: DataFrame) -> DataFrame:
    """Geocoded records -> station table rows (the load does not set ``code_region``)."""
    return records.select(
        F.col("code_site").alias("code_station"), F.col("nom_site").alias("nom"),
        F.lit(None).cast("string").alias("code_region"),
        F.col("type_implantation").alias("type_station"), "type_influence", "latitude", "longitude")


def with_geometry(stations: DataFrame) -> DataFrame:
    """Point geometry from the coordinates."""
    return stations.withColumn("geom", geo_point("longitude", "latitude"))


def upsert(base: DataFrame, updates: DataFrame, key: str = "code_station",
           columns: list[str] | None = None) -> DataFrame:
    """Insert-or-update by key. On a match the update wins on every listed column
    (a NULL coordinate replaces a known one); unlisted columns keep the base value; new
    keys are inserted with unlisted columns NULL. ``updates`` must be unique on ``key``.

    Parquet has no MERGE: write the result to a new path, never over the path being read."""
    columns = columns or UPSERT_COLUMNS
    u = updates.select(F.col(key), *[F.col(c).alias(f"_u_{c}") for c in columns], F.lit(True).alias("_matched"))
    j = base.join(u, key, "full_outer")
    out = []
    for c in base.columns:
        if c == key:
            out.append(F.col(key))
        elif c in columns:
            out.append(F.when(F.col("_matched"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def pollutant_seed(spark) -> DataFrame:
    return spark.createDataFrame(POLLUTANT_SEED, POLLUTANT_SCHEMA)


def insert_missing(base: DataFrame, seed: DataFrame, key: str = "code_polluant") -> DataFrame:
    """Add the seed rows whose key is absent from ``base`` (existing rows untouched)."""
    return base.unionByName(seed.join(base.select(key), key, "left_anti"))


def known_pollutants(exceedances: DataFrame, seed: DataFrame) -> DataFrame:
    """Pollutant rows as an earlier load would hold them: those that have exceeded, with their attributes."""
    return seed.join(exceedances.select("code_polluant").distinct(), "code_polluant", "left_semi")


def geocoding_coverage(records: DataFrame) -> DataFrame:
    """Distinct communes located / total, stations located / total, floor percent
    (NULL when there is no station)."""
    key = F.lower("commune_extraite")
    ok = F.col("geocode_ok")
    return records.agg(
        F.count_distinct(F.when(ok, key)).alias("communes_localisees"),
        F.count_distinct(key).alias("communes_total"),
        F.count_if(ok).alias("stations_localisees"),
        F.count(F.lit(1)).alias("stations_total"),
    ).withColumn("pct_stations_localisees",
                 F.when(F.col("stations_total") > 0,
                        F.floor(F.col("stations_localisees") * 100 / F.col("stations_total")).cast("bigint")))
