from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_literal(v) -> str:
    """Render a Python constant as a Spark SQL literal (doubles typed as DOUBLE)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal_map_sql(mapping: dict) -> str:
    return "map(" + ", ".join(f"{sql_literal(k)}, {sql_literal(v)}" for k, v in mapping.items()) + ")"


def literal_map(mapping: dict) -> Column:
    """A literal MAP expression (parsed once on the JVM side); Catalyst folds lookups."""
    return F.expr(literal_map_sql(mapping))


def lookup(mapping: dict, key: str | Column) -> Column:
    """``mapping[key]`` as one SQL expression when ``key`` is a column name."""
    if isinstance(key, str):
        return F.expr(f"{literal_map_sql(mapping)}[{ident(key)}]")
    return literal_map(mapping)[key]
