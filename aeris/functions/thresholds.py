"""Exceedance class by regulatory thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeris.constants import THRESHOLDS
from aeris.functions._util import ident, sql_literal


def exceedance_class(value: str = "valeur", pollutant: str = "code_polluant") -> Column:
    """``alerte`` when value >= alert threshold, else ``info`` when >= information threshold, else
    NULL, over two columns. Uses the hourly, unclamped value."""
    v, p = ident(value), ident(pollutant)
    cases = [f"WHEN {p} = {sql_literal(code)} AND {v} >= {sql_literal(limits[i])} THEN '{name}'"
             for name, i in (("alerte", 1), ("info", 0)) for code, limits in THRESHOLDS.items() if limits[i] is not None]
    return F.expr(f"CASE {' '.join(cases)} ELSE CAST(NULL AS STRING) END")
