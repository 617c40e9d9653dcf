"""Data-quality rules from the declared constraints (V1-V5). Each check returns a small
report DataFrame: one row per rule, with the number of offending rows/keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.operators.gold import INDEX_KEYS, MEANS_KEYS


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """V1 detail: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def uniqueness_report(checks: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """V1: per rule, how many keys are duplicated and how many rows they cover."""
    parts = []
    for rule, (df, keys) in checks.items():
        d = duplicate_keys(df, keys)
        parts.append(d.agg(F.count(F.lit(1)).alias("cles_dupliquees"),
                           F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("lignes"))
                     .select(F.lit(rule).alias("regle"), "cles_dupliquees", "lignes"))
    return _union(parts)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """V2 detail: child rows whose non-NULL key has no parent (anti join; NULL keys exempt)."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(p, F.col(child_key) == F.col("_pk"), "left_anti")


def referential_report(checks: dict[str, tuple[DataFrame, DataFrame, str, str]]) -> DataFrame:
    """V2: per foreign key, the number of orphan rows."""
    parts = [orphans(c, p, ck, pk).agg(F.count(F.lit(1)).alias("orphelins")).select(F.lit(rule).alias("regle"),
                                                                                    "orphelins")
             for rule, (c, p, ck, pk) in checks.items()]
    return _union(parts)


def not_null_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """V3: NULL count per declared NOT NULL column (one pass per table)."""
    parts = []
    for name, (df, cols) in tables.items():
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stack = F.expr("stack({n}, {args}) as (colonne, nulls)".format(
            n=len(cols), args=", ".join(f"'{c}', `{c}`" for c in cols)))
        parts.append(agg.select(F.lit(name).alias("table"), stack))
    return _union(parts)


def text_length_report(tables: dict[str, tuple[DataFrame, dict[str, int]]]) -> DataFrame:
    """V4: values longer than the declared VARCHAR length, per column."""
    parts = []
    for name, (df, limits) in tables.items():
        cols = [c for c in limits if c in df.columns]
        agg = df.agg(*[F.count_if(F.length(F.col(c)) > limits[c]).alias(c) for c in cols])
        stack = F.expr("stack({n}, {args}) as (colonne, trop_longs)".format(
            n=len(cols), args=", ".join(f"'{c}', `{c}`" for c in cols)))
        parts.append(agg.select(F.lit(name).alias("table"), stack))
    return _union(parts)


def non_empty_report(marts: dict[str, DataFrame]) -> DataFrame:
    """V5: row count per mart and whether it is non-empty."""
    parts = [df.agg(F.count(F.lit(1)).alias("lignes")).select(F.lit(name).alias("mart"), "lignes")
             for name, df in marts.items()]
    return _union(parts).withColumn("ok", F.col("lignes") > 0)


def mart_rows_report(silver: DataFrame) -> DataFrame:
    """V5 for the marts of ``silver`` in one pass over it: the means' groups are counted inside the index's groups, and
    the exceedances inside the means'."""
    means = silver.groupBy(*MEANS_KEYS).agg(F.count_if(F.col("depassement").isNotNull()).alias("exceedances"))
    index = means.groupBy(*INDEX_KEYS).agg(F.count(F.lit(1)).alias("means"), F.sum("exceedances").alias("exceedances"))
    counts = index.agg(F.coalesce(F.sum("means"), F.lit(0)).alias("moyennes_journalieres"), F.count(F.lit(1)).alias("indice_journalier"),
                       F.coalesce(F.sum("exceedances"), F.lit(0)).alias("depassements"))
    rows = F.expr("stack(3, 'moyennes_journalieres', moyennes_journalieres, 'indice_journalier', indice_journalier, 'depassements', depassements) as (mart, lignes)")
    return counts.select(rows).withColumn("ok", F.col("lignes") > 0)


def mart_keys_report(silver: DataFrame) -> DataFrame:
    """V1 for the serving keys of the index and the means of ``silver``, in one pass over it."""
    means = silver.groupBy(*MEANS_KEYS).agg(F.lit(1).alias("one")).drop("one")
    by_key = means.groupBy("code_site", "code_polluant", "date_mesure").agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.struct("nom_site")).alias("names"))
    by_site = by_key.groupBy("code_site", "date_mesure").agg(
        F.count_if(F.col("n") > 1).alias("keys"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("rows"),
        F.size(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"))
    totals = by_site.agg(
        F.count_if(F.col("names") > 1).alias("index_keys"), F.coalesce(F.sum(F.when(F.col("names") > 1, F.col("names"))), F.lit(0)).cast("bigint").alias("index_rows"),
        F.coalesce(F.sum("keys"), F.lit(0)).alias("means_keys"), F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("means_rows"))
    return totals.select(F.expr("stack(2, 'indice_site_jour', index_keys, index_rows, 'moyennes_site_polluant_jour', means_keys, means_rows)"
                                " as (regle, cles_dupliquees, lignes)"))
