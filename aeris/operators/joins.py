"""Join helper. Equi-joins to a dimension carry no hint: Catalyst broadcasts a side whose
estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE one whose measured
shuffle output is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``. Beyond that the join
stays a sort-merge join with skew splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame


def left_join_dimension(fact: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Left equi-join of a fact table to a dimension (broadcast decided by Catalyst / AQE)."""
    return fact.join(dim, on=on, how="left")
