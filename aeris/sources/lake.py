"""Data-lake zones: Bronze JSON lines, partitioned Parquet marts, documents."""

from __future__ import annotations

import os
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.functions import event_date_partition
from aeris.schemas import BRONZE_SCHEMA
from aeris.sources.csv_source import CORRUPT, SOURCE_FILE
from aeris.sources.snapshots import replace_snapshot, snapshot_folder
from pyspark.sql.types import StringType, StructField, StructType


def lake_path(zone: str, prefix: str = "", root: str | None = None) -> str:
    """A10: ``{root}/{zone}/{prefix}``; root defaults to ``s3a://`` buckets named by zone."""
    base = f"{root.rstrip('/')}/{zone}" if root else f"s3a://{zone}"
    return f"{base}/{prefix}" if prefix else base


def object_store_conf(endpoint: str | None = None, access_key: str | None = None,
                      secret_key: str | None = None, path_style: bool = True) -> dict[str, str]:
    """A10: S3A settings for an object store. Values come from the arguments or the
    environment (``AERIS_S3_ENDPOINT``, ``AERIS_S3_ACCESS_KEY``, ``AERIS_S3_SECRET_KEY``);
    there are no credentials in code. Pass the result to ``build_session(extra=...)``."""
    endpoint = endpoint or os.environ.get("AERIS_S3_ENDPOINT")
    access_key = access_key or os.environ.get("AERIS_S3_ACCESS_KEY")
    secret_key = secret_key or os.environ.get("AERIS_S3_SECRET_KEY")
    conf = {"spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
            "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower()}
    if endpoint:
        if not endpoint.startswith("http"):
            endpoint = f"http://{endpoint}"
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
        conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(endpoint.startswith("https")).lower()
    if access_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
    if secret_key:
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def read_bronze_json(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """A3: JSON-lines Bronze zone, partitioned ``date=YYYY-MM-DD`` (or ``inconnue``).
    Explicit all-text schema; with ``day`` the partition filter prunes directories. Lines that are no JSON object
    are left out: :func:`read_bronze_lines` has them, :func:`bronze_rejects` gives them with their files."""
    return bronze_records(read_bronze_lines(spark, path, day))


def read_bronze_lines(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Every line of the zone: the records' columns, ``_corrupt_record`` (the line, where it is no JSON object) and ``_fichier``.

    Lines are read as text and parsed by an expression, so a query may look at rejects alone (Spark's JSON reader refuses
    that). Blank lines are left out. Where the folders have no ``date``, it is taken from the records (B4)."""
    lines = spark.read.text(path)
    partitioned = "date" in lines.columns
    if partitioned:
        lines = lines.withColumn("date", F.col("date").cast("string"))
        lines = lines.filter(F.col("date") == day) if day else lines
    schema = StructType([*BRONZE_SCHEMA.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.where(F.trim("value") != "").select(parsed.alias("r"), *(["date"] if partitioned else []), "value", F.col("_metadata.file_path").alias(SOURCE_FILE))
    line = F.when(F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull(), F.col("value"))
    date = F.col("date") if partitioned else event_date_partition(F.coalesce(F.col("r.date_debut"), F.lit("")))
    rows = rows.select(*[F.col(f"r.{f.name}") for f in BRONZE_SCHEMA.fields], date.alias("date"), line.alias(CORRUPT), SOURCE_FILE)
    return rows.filter(F.col("date") == day) if day and not partitioned else rows


def bronze_records(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, SOURCE_FILE)


def bronze_rejects(lines: DataFrame) -> DataFrame:
    """Lines that are no records, with the file each is in."""
    return lines.filter(F.col(CORRUPT).isNotNull()).select(SOURCE_FILE, F.col(CORRUPT).alias("ligne"))


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A4: a Parquet mart (column pruning and filter pushdown happen at the scan)."""
    return spark.read.parquet(path)


def partition_values(spark: SparkSession, path: str, column: str = "date_mesure") -> list[str]:
    """Values of the partitions under ``path``, from its folder names alone: no file is opened. Rows without a value aren't listed."""
    jvm = spark._jvm  # noqa: SLF001  (Spark's Python API has no file operations)
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.exists(place):
        return []
    names = [unquote(s.getPath().getName()) for s in fs.listStatus(place) if s.isDirectory()]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return sorted(v for v in values if v != "__HIVE_DEFAULT_PARTITION__")


def drop_partitions(spark: SparkSession, path: str, values: list[str], column: str = "date_mesure") -> None:
    """Delete whole partitions (those that a dynamic overwrite has no rows for)."""
    jvm = spark._jvm  # noqa: SLF001
    for value in values:
        place = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={value}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)  # noqa: SLF001


def latest_day(spark: SparkSession, path: str, column: str = "date_mesure") -> str | None:
    """The latest day that ``path`` has a partition of (C2 for readers of the marts): a listing instead of a scan for the maximum."""
    days = [v for v in partition_values(spark, path, column) if re.fullmatch(r"\d{4}-\d{2}-\d{2}", v)]
    return max(days, default=None)


def read_day(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """One day of a mart, the latest by default; other days' files are neither listed in the scan nor read. Without any day: no rows."""
    day = day or latest_day(spark, path)
    mart = read_mart(spark, path)
    return mart.filter(F.col("date_mesure") == F.lit(day).cast("date")) if day else mart.filter(F.lit(False))


def of_days(mart: DataFrame, days: DataFrame, column: str = "date_mesure") -> DataFrame:
    """The rows of ``mart`` on the days that ``days`` (any table with that column, filtered as one likes) holds. The semi-join
    lets Spark prune the partitions of ``mart`` at run time by the days found."""
    return mart.join(days.select(column).where(F.col(column).isNotNull()).distinct(), column, "left_semi")


def write_partitioned(df: DataFrame, path: str, partition_col: str = "date_mesure",
                      mode: str = "overwrite", dynamic: bool = True, max_records_per_file: int | None = 1_000_000) -> None:
    """A5: Parquet write partitioned by ``partition_col``.

    ``dynamic=True`` replaces only the partitions present in ``df`` (a one-day rebuild
    keeps the other days); ``dynamic=False`` is the static overwrite that replaces the
    whole table.

    Rows are rebalanced on the partition value: adaptive execution packs small days
    together and splits a large one (or all rows without a day) by measured size, so a day is written by as many
    tasks as it needs and files keep the advisory size."""
    w = df.hint("rebalance", F.col(partition_col)).write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.partitionBy(partition_col).parquet(path)


def write_clustered(df: DataFrame, path: str, by: tuple[str, ...] = ("jour", "code_site"), bloom: tuple[str, ...] = ("code_site",),
                    partition_cols: tuple[str, ...] = (), row_group_bytes: int = 16 << 20) -> None:
    """Serving layout for reads of one day or one site (F4-F6): files hold ranges of ``by`` and are sorted by it, so that a read by its first column
    skips files and row groups by their least and greatest values, and row groups carry Bloom filters of the columns ``bloom`` (or
    their dictionaries), so that a read of one value skips those that haven't it. Ranges are split by sampled sizes; a value that
    many rows share is spread by the columns after it."""
    w = df.repartitionByRange(*partition_cols, *by).sortWithinPartitions(*partition_cols, *by).write
    for column in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{column}", "true")
    w.option("parquet.block.size", row_group_bytes).partitionBy(*partition_cols).parquet(path)


def write_documents(df: DataFrame, path: str, key: str = "code_site") -> None:
    """Replace the whole document collection; each document's ``_id`` is its key. Readers see the old
    collection until the new one stands."""
    replace_snapshot(df.withColumn("_id", F.col(key)), path, write=lambda rows, folder: rows.write.json(folder))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The collection as it was last replaced."""
    return spark.read.json(snapshot_folder(spark, path))
