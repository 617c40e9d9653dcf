"""Column expressions. Every function returns a ``pyspark.sql.Column`` built from
built-in functions only (no Python UDF); all but the higher-order ones stay inside whole-stage codegen."""

from aeris.functions.parsing import (
    event_date_partition, finite, parse_source_timestamp, to_reading, measurement_date,
)
from aeris.functions.thresholds import exceedance_class
from aeris.functions.index import clamp_negative, sub_index, index_label, round_half_up
from aeris.functions.geo import geo_point, with_commune, with_zone_name
from aeris.functions.display import (
    first_non_empty, index_colour, marker_radius, localised_label, missing_as_mark,
)
from aeris.functions.text import question_intent

__all__ = [
    "event_date_partition", "finite", "parse_source_timestamp", "to_reading", "measurement_date",
    "exceedance_class",
    "clamp_negative", "sub_index", "index_label", "round_half_up",
    "geo_point", "with_commune", "with_zone_name",
    "first_non_empty", "index_colour", "marker_radius", "localised_label", "missing_as_mark",
    "question_intent",
]
