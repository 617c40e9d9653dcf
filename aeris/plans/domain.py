"""Lazy domain views over a directory of driver tables (binding + medallion layers).

Each property is a DataFrame *plan*; nothing runs until an action. Queries in the
catalog compose these plans, so Catalyst sees one tree from the Parquet scans to the
result (pruning and pushdown reach the scans)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from aeris.operators import gold, silver, stations
from aeris.operators.analytics import latest_measurement_day
from aeris.sources import binding
from aeris.sources.csv_source import source_to_bronze


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return binding.table(self.spark, self.sf_dir, name)

    # --- Bronze / Silver / Gold ---------------------------------------------------
    @cached_property
    def source_rows(self) -> DataFrame:
        return binding.bind_source_rows(self.table("events"))

    @cached_property
    def bronze(self) -> DataFrame:
        return source_to_bronze(self.source_rows)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.clean_measurements(self.bronze, processed_at=False)

    @cached_property
    def valid_readings(self) -> DataFrame:
        """Typed, valid Bronze rows before deduplication."""
        return silver.valid_only(silver.typed(self.bronze))

    @cached_property
    def latest(self) -> Column:
        return latest_measurement_day(self.valid_readings)

    @cached_property
    def silver_latest(self) -> DataFrame:
        """Silver of the latest day; other days go before the deduplication."""
        return silver.clean_measurements(self.bronze, day=self.latest, processed_at=False)

    def silver_on(self, day: str) -> DataFrame:
        """Silver of a fixed day; other days go before the deduplication."""
        return silver.clean_measurements(self.bronze, day=day, processed_at=False)

    @cached_property
    def means(self) -> DataFrame:
        return gold.daily_means(self.silver)

    @cached_property
    def index(self) -> DataFrame:
        return gold.daily_index(self.means)

    @cached_property
    def exceedances(self) -> DataFrame:
        return gold.exceedance_mart(self.silver)

    # --- reference data -----------------------------------------------------------
    @cached_property
    def gazetteer(self) -> DataFrame:
        return binding.bind_gazetteer(self.table("supplier"))

    @cached_property
    def station_base(self) -> DataFrame:
        return binding.bind_station_base(self.table("supplier"))

    @cached_property
    def regions(self) -> DataFrame:
        return binding.bind_regions(self.table("nation"))

    @cached_property
    def questions(self) -> DataFrame:
        return binding.bind_questions(self.table("conversations"))

    @cached_property
    def station_records(self) -> DataFrame:
        """Distinct stations, geocoded (F2 -> B14 -> D3)."""
        return stations.geocode(stations.distinct_stations(self.valid_readings), self.gazetteer)

    @cached_property
    def stations(self) -> DataFrame:
        """The station table as the serving layer holds it."""
        return stations.to_station_rows(self.station_records)
