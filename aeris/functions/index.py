"""Air-quality index expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeris.constants import INDEX_GRID, INDEX_LABELS, INDEX_LEVELS
from aeris.functions._util import col, ident, lookup, sql_literal


def clamp_negative(value: str | Column = "valeur") -> Column:
    """Negative readings count as 0 in aggregates; NULL stays NULL."""
    v = col(value)
    return F.when(v < 0, F.lit(0.0)).otherwise(v)


def round_half_up(value: str | Column, digits: int = 2) -> Column:
    """Half-up rounding of a double (Spark ``round`` semantics)."""
    return F.round(col(value), digits)


def sub_index(mean: str = "moyenne", pollutant: str = "code_polluant") -> Column:
    """B11 over two columns: smallest level whose inclusive upper bound is not exceeded by the daily
    mean; level 6 above the last bound; NULL for an unknown pollutant or a NULL mean."""
    m, p = ident(mean), ident(pollutant)
    branches = []
    for code, bounds in INDEX_GRID.items():
        levels = " ".join(f"WHEN {m} <= {sql_literal(float(b))} THEN {lvl}" for lvl, b in enumerate(bounds, start=1))
        branches.append(f"WHEN {p} = {sql_literal(code)} THEN CASE {levels} "
                        f"WHEN {m} IS NOT NULL AND NOT isnan({m}) THEN {INDEX_LEVELS} END")
    return F.expr("CAST(CASE " + " ".join(branches) + " END AS INT)")


def index_label(index: str | Column = "indice_atmo") -> Column:
    """Level -> label; NULL when the level is NULL."""
    return lookup(INDEX_LABELS, index)
