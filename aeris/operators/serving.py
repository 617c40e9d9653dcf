"""Gold -> serving tables and the five parameterised reads.

Sort order is always stated with its NULL placement: a PostgreSQL ``DESC`` puts NULLs
first, Spark's default puts them last. Rows tied on the documented keys are ordered by
the natural key so ``LIMIT`` keeps a deterministic set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.operators.joins import left_join_dimension
from aeris.schemas import SERVING_EXCEEDANCE_COLUMNS, SERVING_INDEX_COLUMNS, SERVING_MEANS_COLUMNS

MEANS_LIMIT = 2000
EXCEEDANCE_LIMIT = 1000


def serving_index(index: DataFrame, stations: DataFrame) -> DataFrame:
    """D1 + B13: daily index with the station coordinates (left join), ``date_mesure`` -> ``jour``."""
    coords = stations.select(F.col("code_station").alias("code_site"), "latitude", "longitude")
    return (left_join_dimension(index.withColumnRenamed("date_mesure", "jour"), coords, "code_site")
            .select(*SERVING_INDEX_COLUMNS))


def serving_means(means: DataFrame) -> DataFrame:
    return means.withColumnRenamed("date_mesure", "jour").select(*SERVING_MEANS_COLUMNS)


def serving_exceedances(exceedances: DataFrame) -> DataFrame:
    return exceedances.withColumnRenamed("date_mesure", "jour").select(*SERVING_EXCEEDANCE_COLUMNS)


def located(df: DataFrame, lat: str = "latitude") -> DataFrame:
    """Rows with coordinates."""
    return df.filter(F.col(lat).isNotNull())


def equality_filters(df: DataFrame, **conditions) -> DataFrame:
    """AND of the given equality filters; a ``None`` value means no filter."""
    for c, v in conditions.items():
        if v is not None and v != "":
            df = df.filter(F.col(c) == F.lit(v))
    return df


def list_stations(stations: DataFrame) -> DataFrame:
    """located stations by name."""
    return (located(stations)
            .select("code_station", "nom", "type_station", "type_influence", "latitude", "longitude")
            .orderBy(F.col("nom").asc_nulls_last(), F.col("code_station").asc_nulls_last()))


def _as_day(day: str | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def list_indices(index_serving: DataFrame, day: str | Column | None = None) -> DataFrame:
    """located station-day indices; all days by ``jour DESC, indice DESC``, one day by ``indice DESC``."""
    df = located(index_serving)
    order = [F.col("indice_atmo").desc_nulls_first(), F.col("code_site").asc_nulls_last()]
    if day is not None:
        df = df.filter(F.col("jour") == _as_day(day))
    else:
        order = [F.col("jour").desc_nulls_first()] + order
    return df.orderBy(*order)


def list_means(means_serving: DataFrame, pollutant: str | None = None, day: str | Column | None = None,
               limit: int | None = MEANS_LIMIT) -> DataFrame:
    """daily means by ``jour DESC, moyenne DESC`` capped at ``limit`` rows (top-k:
    TakeOrderedAndProject keeps ``limit`` rows per task, never the whole table)."""
    df = equality_filters(means_serving, code_polluant=pollutant)
    if day is not None:
        df = df.filter(F.col("jour") == _as_day(day))
    df = df.orderBy(F.col("jour").desc_nulls_first(), F.col("moyenne").desc_nulls_first(),
                    F.col("code_site").asc_nulls_last(), F.col("code_polluant").asc_nulls_last(),
                    F.col("nom_site").asc_nulls_last(), F.col("unite").asc_nulls_last())
    return df.limit(limit) if limit else df


def list_exceedances(exc_serving: DataFrame, day: str | Column | None = None,
                     limit: int | None = EXCEEDANCE_LIMIT) -> DataFrame:
    """exceedances by ``horodatage DESC``; capped at ``limit`` only when no day is given. The day is
    filtered before the sort, so a day is always whole."""
    df = exc_serving
    if day is not None:
        df = df.filter(F.col("jour") == _as_day(day))
    df = df.orderBy(F.col("horodatage").desc_nulls_first(), F.col("code_site").asc_nulls_last(),
                    F.col("code_polluant").asc_nulls_last(), F.col("valeur").desc_nulls_first())
    return df.limit(limit) if (limit and day is None) else df


def global_stats(stations: DataFrame, index_serving: DataFrame, exc_serving: DataFrame) -> DataFrame:
    """E5: stations, located stations, distinct days, alert and info counts - one
    aggregate over the union of the three inputs (no cross join of single-row results)."""
    parts = (
        stations.select(F.lit("st").alias("_t"), F.col("latitude").isNotNull().alias("_loc"),
                        F.lit(None).cast("date").alias("_jour"), F.lit(None).cast("string").alias("_dep"))
        .unionByName(index_serving.select(F.lit("ix").alias("_t"), F.lit(False).alias("_loc"),
                                          F.col("jour").alias("_jour"), F.lit(None).cast("string").alias("_dep")))
        .unionByName(exc_serving.select(F.lit("ex").alias("_t"), F.lit(False).alias("_loc"),
                                        F.lit(None).cast("date").alias("_jour"), F.col("depassement").alias("_dep")))
    )
    t = F.col("_t")
    return parts.agg(
        F.count_if(t == "st").alias("nb_stations"),
        F.count_if((t == "st") & F.col("_loc")).alias("nb_stations_geolocalisees"),
        F.count_distinct(F.when(t == "ix", F.col("_jour"))).alias("nb_jours_donnees"),
        F.count_if((t == "ex") & (F.col("_dep") == "alerte")).alias("nb_depassements_alerte"),
        F.count_if((t == "ex") & (F.col("_dep") == "info")).alias("nb_depassements_info"),
    )


def label_distribution(index_serving: DataFrame) -> DataFrame:
    """Station-days per label, ordered by the lowest index of the label (NULL last)."""
    return (index_serving.groupBy("qualificatif")
            .agg(F.count(F.lit(1)).alias("n"), F.min("indice_atmo").alias("_min"))
            .orderBy(F.col("_min").asc_nulls_last())
            .select("qualificatif", "n"))
