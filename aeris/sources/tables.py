"""Serving-table adapter (A6, A7): JDBC when a URL is given, Parquet twin otherwise."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from aeris.sources.snapshots import read_snapshot, replace_snapshot


def _jdbc_props() -> dict[str, str]:
    props = {}
    for key, env in (("user", "AERIS_DB_USER"), ("password", "AERIS_DB_PASSWORD"), ("driver", "AERIS_DB_DRIVER")):
        if os.environ.get(env):
            props[key] = os.environ[env]
    return props


def read_table(spark: SparkSession, table: str, columns: list[str] | None = None, *,
               jdbc_url: str | None = None, root: str | None = None, num_partitions: int | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None) -> DataFrame:
    """Read a serving table with column projection (pushed into the JDBC query or the
    Parquet scan). Large JDBC tables can be split by a numeric column."""
    if jdbc_url:
        r = spark.read.format("jdbc").option("url", jdbc_url).option("dbtable", table)
        for k, v in _jdbc_props().items():
            r = r.option(k, v)
        if num_partitions and partition_column:
            r = (r.option("numPartitions", num_partitions).option("partitionColumn", partition_column)
                 .option("lowerBound", lower).option("upperBound", upper))
        df = r.load()
    else:
        df = read_snapshot(spark, f"{root.rstrip('/')}/{table}")
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, table: str, *, jdbc_url: str | None = None, root: str | None = None,
                connections: int = 8, batch_rows: int = 10_000) -> None:
    """Overwrite a serving table. JDBC truncates (keeps the declared DDL and keys) and holds
    ``connections`` at most, whatever the number of partitions; the Parquet twin publishes a new version, so its
    readers never see a gap or half a table."""
    if jdbc_url:
        w = df.write.mode("overwrite").format("jdbc").option("url", jdbc_url).option("dbtable", table)
        w = w.option("truncate", "true").option("numPartitions", connections).option("batchsize", batch_rows)
        for k, v in _jdbc_props().items():
            w = w.option(k, v)
        w.save()
    else:
        replace_snapshot(df, f"{root.rstrip('/')}/{table}")
