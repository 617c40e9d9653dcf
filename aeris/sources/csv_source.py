"""Daily source CSV (A1, A2) and its projection to Bronze records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aeris.constants import POLLUTANT_CODES, UNIT_NORMALISATION
from aeris.functions import event_date_partition
from aeris.functions._util import ident, literal_map_sql, sql_literal
from aeris.schemas import BRONZE_COLUMNS, SOURCE_COLUMNS, SOURCE_SCHEMA

# Bronze field <- source CSV header
_FIELD_SOURCES: dict[str, str] = {
    "date_debut": "Date de début",
    "date_fin": "Date de fin",
    "organisme": "Organisme",
    "code_zas": "code zas",
    "zas": "Zas",
    "code_site": "code site",
    "nom_site": "nom site",
    "type_implantation": "type d'implantation",
    "type_influence": "type d'influence",
    "type_valeur": "type de valeur",
    "valeur": "valeur",
    "valeur_brute": "valeur brute",
    "code_qualite": "code qualité",
    "validite": "validité",
}


def daily_source_path(base: str, day: str) -> str:
    """A2: location of the daily file ``{base}/{year}/FR_E2_{day}.csv``."""
    return f"{base.rstrip('/')}/{day[:4]}/FR_E2_{day}.csv"


def read_measurements_csv(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """A1: ``;``-separated, quoted, header, UTF-8 (a leading BOM is dropped by the reader).
    All 23 columns are read as text with an explicit schema (no inference)."""
    p = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.schema(SOURCE_SCHEMA)
            .option("sep", ";").option("header", True).option("quote", '"')
            .option("encoding", "UTF-8").option("enforceSchema", True)
            .csv(p))


CSV_OPTIONS = {"sep": ";", "quote": '"'}
CORRUPT, SOURCE_FILE, SOURCE_TIME = "_corrupt_record", "_fichier", "_modifie"


def read_csv_with_lineage(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """A1 with lineage (B3): the 23 columns, the file a line came from and when that was written, and the whole line in
    ``_corrupt_record`` where it hasn't 23 fields. Use :func:`good_lines` and :func:`bad_lines` on the result.

    Lines are read as text and parsed by an expression, so a query may look at rejects alone (Spark's CSV reader refuses that).
    A leading BOM, blank lines and header lines are no records and are left out."""
    p = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(p).select(
        F.regexp_replace("value", "^\\uFEFF", "").alias("line"), F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_modification_time").alias(SOURCE_TIME))
    parsed = F.from_csv(F.col("line"), f"{SOURCE_DDL}, {CORRUPT} STRING", CSV_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.where(F.trim("line") != "").select(parsed.alias("r"), SOURCE_FILE, SOURCE_TIME).select("r.*", SOURCE_FILE, SOURCE_TIME)
    first, other = SOURCE_COLUMNS[0], SOURCE_COLUMNS[-1]
    return rows.where(~(F.col(ident(first)).eqNullSafe(first) & F.col(ident(other)).eqNullSafe(other)))


def good_lines(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_lines(rows: DataFrame) -> DataFrame:
    """The lines that aren't records, as they are, with their file."""
    return rows.filter(F.col(CORRUPT).isNotNull()).select(SOURCE_FILE, F.col(CORRUPT).alias("ligne"))


def lines_by_file(rows: DataFrame) -> DataFrame:
    """Lines read and rejected of each file (files without lines are absent)."""
    return rows.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("lues"), F.count(CORRUPT).alias("rejetees"))


SOURCE_DDL = ", ".join(f"{ident(c)} STRING" for c in SOURCE_COLUMNS)


def csv_lines(src: DataFrame, column: str = "line") -> DataFrame:
    """Source rows as lines of the daily file, every field quoted."""
    return src.select(F.to_csv(F.struct(*SOURCE_COLUMNS), CSV_OPTIONS | {"quoteAll": "true", "emptyValue": ""}).alias(column))


def parse_csv_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """A1 on lines that are already rows (a stream of lines, a text table): the 23 columns as text."""
    parsed = F.from_csv(F.col(column), SOURCE_DDL, CSV_OPTIONS)
    return lines.select(parsed.alias("r")).select("r.*")


def source_to_bronze(src: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Source rows -> Bronze records: trim every field (missing -> ""), keep the six
    regulated pollutants (C1), map the code (B1), normalise the unit (B2), stamp
    ``_ingested_at`` (B3, ISO-8601 UTC text) and add the event-date partition ``date`` (B4).

    If ``src`` already carries ``_ingested_at`` it is kept (replays stay reproducible).
    Each output column is one SQL expression (a single JVM parse per column)."""
    def text(header: str) -> str:
        return f"coalesce(trim({ident(header)}), '')"

    label, unit = text("Polluant"), text("unité de mesure")
    if "_ingested_at" in src.columns:
        stamp = "`_ingested_at`"
    elif ingested_at is not None:
        stamp = sql_literal(ingested_at)
    else:
        stamp = "date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\")"
    exprs = {name: text(header) for name, header in _FIELD_SOURCES.items()}
    exprs["polluant_source"] = label
    exprs["code_polluant"] = f"{literal_map_sql(POLLUTANT_CODES)}[{label}]"
    exprs["unite_source"] = unit
    exprs["unite"] = f"coalesce({literal_map_sql(UNIT_NORMALISATION)}[{unit}], {unit})"
    exprs["_ingested_at"] = stamp
    keep = label + " IN (" + ", ".join(sql_literal(k) for k in POLLUTANT_CODES) + ")"
    out = src.filter(F.expr(keep)).select(*[F.expr(exprs[c]).alias(c) for c in BRONZE_COLUMNS])
    return out.withColumn("date", event_date_partition("date_debut"))
