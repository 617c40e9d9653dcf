"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from aeris.session import checkpoint_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under ``spark.checkpoint.dir`` and read back: its lineage ends in files that survive lost
    executors, and what it was read from may then be replaced."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/aeris-staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
