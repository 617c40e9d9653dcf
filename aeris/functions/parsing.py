"""Parsing of raw text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeris.constants import SOURCE_TS_PATTERN, UNKNOWN_DATE
from aeris.functions._util import col


def event_date_partition(date_debut: str | Column = "date_debut") -> Column:
    """``YYYY/MM/DD ...`` -> ``YYYY-MM-DD`` (first 10 characters, '/' -> '-'),
    ``inconnue`` when missing or shorter than 10 characters."""
    d = col(date_debut)
    return (F.when(F.length(d) >= 10, F.translate(F.substring(d, 1, 10), "/", "-"))
            .otherwise(F.lit(UNKNOWN_DATE)))


def to_reading(text: str | Column) -> Column:
    """Text -> double; unparsable -> NULL. NaN and +/-inf are treated as NULL
    too (a NaN would otherwise compare >= every threshold in Spark)."""
    return finite(col(text).try_cast("double"))


def finite(value: str | Column) -> Column:
    """The value, NULL for NaN and +/-inf."""
    v = col(value)
    return F.when(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(v)


def parse_source_timestamp(text: str | Column) -> Column:
    """``yyyy/MM/dd HH:mm:ss`` -> wall-clock timestamp. The source gives local hours without a
    zone, so the text goes straight to TIMESTAMP_NTZ: through a zoned timestamp, hours that
    the session's zone skips or repeats would move. Malformed -> NULL (never raises)."""
    t = col(text)
    return F.when(t.rlike(SOURCE_TS_PATTERN), F.translate(t, "/", "-").try_cast("timestamp_ntz"))


def measurement_date(ts: str | Column = "horodatage") -> Column:
    """Calendar day of the measurement."""
    return F.to_date(col(ts))
