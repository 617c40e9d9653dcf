"""Readers and writers."""

from aeris.sources.csv_source import (
    bad_lines, daily_source_path, good_lines, lines_by_file, read_csv_with_lineage, read_measurements_csv, source_to_bronze,
)
from aeris.sources.lake import (
    bronze_records, bronze_rejects, lake_path, latest_day, object_store_conf, of_days, partition_values, read_day, read_bronze_json, read_bronze_lines,
    read_documents, read_mart, write_clustered, write_documents, write_partitioned,
)
from aeris.sources.snapshots import read_snapshot, replace_snapshot, vacuum, versions
from aeris.sources.tables import read_table, write_table

__all__ = [
    "bad_lines", "good_lines", "lines_by_file", "read_csv_with_lineage", "bronze_records", "bronze_rejects", "read_bronze_lines", "write_clustered",
    "daily_source_path", "read_measurements_csv", "source_to_bronze",
    "lake_path", "latest_day", "object_store_conf", "of_days", "partition_values", "read_day", "read_bronze_json", "read_documents", "read_mart", "write_documents", "write_partitioned",
    "read_snapshot", "replace_snapshot", "vacuum", "versions",
    "read_table", "write_table",
]
