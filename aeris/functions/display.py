"""Display-side attributes computed as columns (B17-B19, D2 placeholder)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeris.constants import INDEX_COLOURS, LOCALISED_LABELS, MISSING_MARK, UNKNOWN_COLOUR
from aeris.functions._util import col, literal_map


def first_non_empty(*cols: str | Column, default: str | None = None) -> Column:
    """First value that is neither NULL nor the empty string."""
    parts = [F.nullif(col(c), F.lit("")) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def missing_as_mark(c: str | Column) -> Column:
    """NULL or empty attribute -> the placeholder mark."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(MISSING_MARK))


def index_colour(index: str | Column = "indice_atmo") -> Column:
    """Colour per index level, grey when unknown."""
    return F.coalesce(literal_map(INDEX_COLOURS)[col(index)], F.lit(UNKNOWN_COLOUR))


def marker_radius(index: str | Column = "indice_atmo") -> Column:
    """5 + 0.8 * min(index, 6); 5 when the index is NULL."""
    i = col(index)
    return F.when(i.isNull(), F.lit(5.0)).otherwise(F.lit(5.0) + F.lit(0.8) * F.least(i, F.lit(6)))


def localised_label(index: str | Column, lang: str | Column) -> Column:
    """(index, language) -> label; the 7th entry is the 'not measured' label for a
    NULL or out-of-range index; unknown languages fall back to French."""
    table = F.create_map(*[x for k, v in LOCALISED_LABELS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    labels = F.coalesce(table[col(lang)], table[F.lit("fr")])
    i = col(index)
    pos = F.when(i.between(1, 6), i).otherwise(F.lit(7))
    return F.element_at(labels, pos.cast("int"))
