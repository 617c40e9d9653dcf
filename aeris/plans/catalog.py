"""Catalog of registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` through the binding and runs the
whole medallion plan on them (no row caps, id subsets or prefixes); a ``limit`` appears
only where the operator is a top-k or preview by definition."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.constants import LOCALISED_LABELS
from aeris.operators import analytics as A
from aeris.operators import constraints as K
from aeris.operators import geocoding as GC
from aeris.operators import gold as G
from aeris.operators import incremental as IN
from aeris.operators import quality as Q
from aeris.operators import serving as S
from aeris.operators import silver as SV
from aeris.operators import stations as ST
from aeris.plans.domain import Domain
from aeris.schemas import SILVER_COLUMNS, TEXT_LIMITS
from aeris.session import apply_defaults
from aeris.sources import binding
from aeris.sources.csv_source import csv_lines, parse_csv_lines, source_to_bronze
from aeris.streaming import parse_messages, publish_frame

# Parameters of the registered queries (what a user of the views would pick).
POLLUTANT = "NO2"
LABEL = "Moyen"
LANG = "en"
LANGS = (*LOCALISED_LABELS, "it")  # every language, and one without labels
DAY = "2024-01-15"
STAMP = "2024-02-01T00:00:00.000000Z"
SEARCH = {"text": "SUPPLIER#", "qualities": [1, 2, 3], "pollutant": "NO2", "influence": "Industrielle"}


def _is_late() -> Column:
    """Records with an odd last digit of their second come in the late batch (so keys meet in both)."""
    return F.coalesce(F.substring("_ingested_at", 19, 1).try_cast("int") % 2 == 1, F.lit(False))


class Views:
    """Serving-level views derived from a :class:`Domain`."""

    def __init__(self, d: Domain):
        self.d = d

    @cached_property
    def index_serving(self) -> DataFrame:
        return S.serving_index(self.d.index, self.d.stations)

    @cached_property
    def means_serving(self) -> DataFrame:
        return S.serving_means(self.d.means)

    @cached_property
    def exc_serving(self) -> DataFrame:
        return S.serving_exceedances(self.d.exceedances)

    # Silver before and after a batch of late records
    @cached_property
    def early(self) -> DataFrame:
        return SV.clean_measurements(self.d.bronze.where(~_is_late()), processed_at=False)

    @cached_property
    def merged(self) -> DataFrame:
        return IN.merged_readings(self.early, IN.arrived(self.d.bronze.where(_is_late())))

    # what a load of the serving tables accepts and refuses
    @cached_property
    def judged_index(self) -> DataFrame:
        return K.judge(self.index_serving, K.CONTRACTS["gold_indice_journalier"])

    @cached_property
    def judged_means(self) -> DataFrame:
        return K.judge(self.means_serving, K.CONTRACTS["gold_moyennes_journalieres"])

    # the latest day, cut out before the deduplication
    @cached_property
    def index_day(self) -> DataFrame:
        return G.daily_index(G.daily_means(self.d.silver_latest))

    @cached_property
    def ds(self) -> DataFrame:
        return A.day_stations(self.index_day, self.d.stations)


def _with_reasons(judged: DataFrame) -> DataFrame:
    return judged.withColumn("motifs", F.concat_ws(";", K.REASONS)).drop(K.REASONS)


def _q(fn: Callable[[Domain, Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        d = Domain(apply_defaults(spark), sf_dir)
        return fn(d, Views(d))
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[Domain, Views], DataFrame]] = {
    # --- medallion --------------------------------------------------------------------
    "daily_index": lambda d, v: d.index,
    "daily_means": lambda d, v: d.means,
    "bronze_records": lambda d, v: d.bronze,
    "silver_measurements": lambda d, v: d.silver,
    "silver_one_day": lambda d, v: SV.clean_measurements(d.bronze, day=DAY, processed_at=False),
    "exceedance_distribution": lambda d, v: SV.exceedance_distribution(d.silver),
    "silver_run_metrics": lambda d, v: SV.run_metrics(d.bronze),
    "exceedance_mart": lambda d, v: d.exceedances,
    "index_distribution": lambda d, v: G.index_distribution(d.index),
    "sample_means": lambda d, v: G.sample_means(d.means),
    "station_sub_indices": lambda d, v: G.sub_index_table(d.means),
    # --- serving ----------------------------------------------------------------------
    "serving_index": lambda d, v: v.index_serving,
    "list_stations": lambda d, v: S.list_stations(d.stations),
    "list_indices_all_days": lambda d, v: S.list_indices(v.index_serving),
    "list_indices_latest_day": lambda d, v: S.list_indices(S.serving_index(v.index_day, d.stations), day=d.latest),
    "list_indices_day": lambda d, v: S.list_indices(
        S.serving_index(G.daily_index(G.daily_means(d.silver_on(DAY))), d.stations), day=DAY),
    "list_means_day": lambda d, v: S.list_means(
        S.serving_means(G.daily_means(d.silver_on(DAY))), pollutant=POLLUTANT, day=DAY),
    "list_means_pollutant": lambda d, v: S.list_means(v.means_serving, pollutant=POLLUTANT),
    "list_means_all": lambda d, v: S.list_means(v.means_serving),
    "list_exceedances": lambda d, v: S.list_exceedances(v.exc_serving),
    "list_exceedances_latest_day": lambda d, v: S.list_exceedances(
        S.serving_exceedances(G.exceedance_mart(d.silver_latest)), day=d.latest),
    "list_exceedances_day": lambda d, v: S.list_exceedances(
        S.serving_exceedances(G.exceedance_mart(d.silver_on(DAY))), day=DAY),
    "global_stats": lambda d, v: S.global_stats(d.stations, v.index_serving, v.exc_serving),
    "label_distribution": lambda d, v: S.label_distribution(v.index_serving),
    # --- analytics --------------------------------------------------------------------
    "day_stations": lambda d, v: v.ds,
    "mean_index": lambda d, v: A.mean_index(v.ds),
    "count_by_pollutant": lambda d, v: A.count_by_pollutant(v.ds),
    "exceedances_by_pollutant": lambda d, v: A.exceedances_by_pollutant(v.exc_serving),
    "exceedances_by_day": lambda d, v: A.exceedances_by_day(v.exc_serving),
    "stations_by_influence": lambda d, v: A.stations_by_influence(v.ds),
    "good_share": lambda d, v: A.good_share(v.index_serving),
    "dominant_pollutant": lambda d, v: A.dominant_pollutant(v.ds),
    "total_exceedances": lambda d, v: A.total_exceedances(v.exc_serving),
    "most_exposed": lambda d, v: A.most_exposed(v.means_serving, POLLUTANT),
    "station_ranking": lambda d, v: A.ranking(v.ds),
    "worst_and_best": lambda d, v: A.worst_and_best(v.ds),
    "filter_options": lambda d, v: A.filter_options(v.ds),
    "exceedance_table": lambda d, v: A.exceedance_table(S.list_exceedances(v.exc_serving, limit=None)),
    "recent_exceedances": lambda d, v: A.recent_exceedances(S.list_exceedances(v.exc_serving)),
    "label_filter": lambda d, v: A.label_filter(v.ds, LABEL),
    "station_search": lambda d, v: A.search_stations(v.ds, **SEARCH),
    "display_attributes": lambda d, v: A.with_display(v.ds),
    "localised_labels": lambda d, v: A.with_localised_label(v.index_serving, LANG),
    "localised_labels_all": lambda d, v: A.with_localised_labels(v.index_serving, LANGS),
    "normalised_index_records": lambda d, v: A.normalise_index_records(v.index_serving),
    "question_routing": lambda d, v: A.route_questions(d.questions, v.ds),
    "city_lookup": lambda d, v: A.city_lookup(d.questions, v.ds),
    # --- station reference --------------------------------------------------------------
    "distinct_stations": lambda d, v: ST.distinct_stations(d.valid_readings).orderBy("code_site"),
    "geocoded_stations": lambda d, v: d.station_records,
    "geocoded_approximate": lambda d, v: GC.geocode_approximate(
        binding.bind_misspelt(ST.distinct_stations(d.valid_readings)), d.gazetteer),
    "station_geometry": lambda d, v: ST.with_geometry(d.stations).select(
        "code_station", F.col("geom.lon").alias("geom_lon"), F.col("geom.lat").alias("geom_lat"),
        F.col("geom.srid").alias("geom_srid")),
    "station_upsert": lambda d, v: ST.upsert(d.station_base, d.stations),
    "pollutant_dimension": lambda d, v: ST.insert_missing(
        ST.known_pollutants(d.exceedances, ST.pollutant_seed(d.spark)), ST.pollutant_seed(d.spark)),
    "geocoding_coverage": lambda d, v: ST.geocoding_coverage(d.station_records),
    # --- data quality -------------------------------------------------------------------
    "uniqueness_report": lambda d, v: Q.mart_keys_report(d.silver).unionByName(Q.uniqueness_report({
        "mesure_station_polluant_heure": (d.valid_readings, ["code_site", "code_polluant", "horodatage"]),
    })),
    "referential_report": lambda d, v: Q.referential_report({
        "station_region": (ST.upsert(d.station_base, d.stations), d.regions, "code_region", "code_region"),
        "mesure_station": (d.valid_readings, d.station_base, "code_site", "code_station"),
        "source_polluant": (d.source_rows.select("Polluant"), ST.pollutant_seed(d.spark), "Polluant", "code_polluant"),
    }),
    "not_null_report": lambda d, v: Q.not_null_report({
        "station": (ST.upsert(d.station_base, d.stations), ["code_station", "nom"]),
        "region": (d.regions, ["code_region", "nom"]),
        "polluant": (ST.pollutant_seed(d.spark), ["code_polluant", "libelle", "unite"]),
        "mesure": (d.silver, ["code_site", "horodatage"]),
        "indice": (v.index_serving, ["jour"]),
    }),
    "text_length_report": lambda d, v: Q.text_length_report({
        "indice": (v.index_serving, TEXT_LIMITS["indice"]),
        "moyennes": (v.means_serving, TEXT_LIMITS["moyennes"]),
        "depassements": (v.exc_serving, TEXT_LIMITS["depassements"]),
        "station": (ST.upsert(d.station_base, d.stations), TEXT_LIMITS["station"]),
        "region": (d.regions, TEXT_LIMITS["region"]),
        "polluant": (ST.pollutant_seed(d.spark), TEXT_LIMITS["polluant"]),
    }),
    "non_empty_report": lambda d, v: Q.mart_rows_report(d.silver),
    # --- late readings merged into marts ---------------------------
    "merged_silver": lambda d, v: v.merged.select(*SILVER_COLUMNS),
    "merged_means": lambda d, v: IN.means_of_state(IN.updated_state(IN.means_state(v.early), v.merged)),
    # --- loads behind constraints ---------------------------------------------------------
    "accepted_index": lambda d, v: K.accepted(v.judged_index),
    "quarantined_index": lambda d, v: _with_reasons(K.quarantined(v.judged_index)),
    "accepted_means": lambda d, v: K.accepted(v.judged_means),
    "quarantined_means": lambda d, v: _with_reasons(K.quarantined(v.judged_means)),
    "judged_exceedances": lambda d, v: _with_reasons(K.judge(v.exc_serving, K.CONTRACTS["gold_depassements"])),
    "judged_stations": lambda d, v: _with_reasons(K.judge(
        ST.upsert(d.station_base, d.stations), K.CONTRACTS["station"], {"region": d.regions})),
    "judged_measurements": lambda d, v: _with_reasons(K.judge(
        SV.hourly_measurements(d.valid_readings), K.CONTRACTS["mesure_horaire"],
        {"station": d.station_base, "polluant": ST.pollutant_seed(d.spark)})),
    # --- stream side ----------------------------------------------------------------------
    "published_messages": lambda d, v: publish_frame(d.bronze),
    "bronze_from_messages": lambda d, v: parse_messages(publish_frame(d.bronze)),
    # --- source side ----------------------------------------------------------------------
    "csv_records": lambda d, v: source_to_bronze(parse_csv_lines(csv_lines(d.source_rows)), ingested_at=STAMP),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _q(fn) for name, fn in QUERIES.items()}
