"""Silver -> Gold marts: daily statistics, daily index, exceedances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.functions import clamp_negative, index_label, round_half_up, sub_index

MEANS_KEYS = ["code_site", "nom_site", "code_polluant", "date_mesure", "unite"]
INDEX_KEYS = ["code_site", "nom_site", "date_mesure"]


def daily_means(silver: DataFrame, digits: int = 2) -> DataFrame:
    """Mean / min / max of the clamped readings (B10), rounded half-up to ``digits``,
    and the row count (NULL readings included), per site, name, pollutant, day and unit.
    Partial aggregation runs before the shuffle, so hot keys do not skew it. The mean's sum is taken in
    decimals, so that the order of rows can't move a rounding (in doubles beyond their range)."""
    v = clamp_negative("valeur")
    exact = F.sum(v.try_cast("decimal(28,10)")).cast("double") / F.nullif(F.count(v), F.lit(0))
    mean = F.when(F.max(F.abs(v)) < 1e17, exact).otherwise(F.avg(v))
    return (silver.groupBy(*MEANS_KEYS)
            .agg(round_half_up(mean, digits).alias("moyenne"),
                 round_half_up(F.min(v), digits).alias("minimum"),
                 round_half_up(F.max(v), digits).alias("maximum"),
                 F.count(F.lit(1)).alias("nb_mesures")))


def with_sub_index(means: DataFrame) -> DataFrame:
    """B11 per daily mean."""
    return means.withColumn("sous_indice", sub_index("moyenne", "code_polluant"))


def daily_index(means: DataFrame) -> DataFrame:
    """E2 + B12: station-day index = highest sub-index; the responsible pollutant is the
    one reaching it (alphabetically first on ties); NULL index, pollutant and label when
    every sub-index is NULL."""
    s = F.col("sous_indice")
    rank_key = F.when(s.isNotNull(), F.struct((-s).alias("neg"), F.col("code_polluant").alias("p")))
    return (with_sub_index(means).groupBy(*INDEX_KEYS)
            .agg(F.max(s).alias("indice_atmo"),
                 F.min_by("code_polluant", rank_key).alias("polluant_resp"))
            .withColumn("qualificatif", index_label("indice_atmo"))
            .select(*INDEX_KEYS, "indice_atmo", "polluant_resp", "qualificatif"))


def sub_index_table(means: DataFrame) -> DataFrame:
    """Per station and day, the sub-index of each regulated pollutant as columns (the real
    per-pollutant detail behind the station index). The pivot values are the fixed codes,
    so no extra job discovers them; a pollutant not measured that day is NULL."""
    from aeris.constants import INDEX_GRID
    codes = list(INDEX_GRID)
    return (with_sub_index(means).groupBy("code_site", "date_mesure")
            .pivot("code_polluant", codes).agg(F.max("sous_indice"))
            .select("code_site", "date_mesure", *[F.col(c).alias(f"sous_indice_{c.lower()}") for c in codes]))


def exceedance_mart(silver: DataFrame) -> DataFrame:
    """C4: the exceedance records."""
    return (silver.filter(F.col("depassement").isNotNull())
            .select("code_site", "nom_site", "code_polluant", "horodatage", "date_mesure", "valeur", "unite",
                    "depassement"))


def index_distribution(index: DataFrame) -> DataFrame:
    """Station-days per index level and label."""
    return (index.groupBy("indice_atmo", "qualificatif").agg(F.count(F.lit(1)).alias("nb"))
            .orderBy(F.col("indice_atmo").asc_nulls_first()))


def sample_means(means: DataFrame, n: int = 10) -> DataFrame:
    """first ``n`` daily means by site and pollutant (a preview; the limit is the feature)."""
    return (means.orderBy(F.col("code_site").asc_nulls_first(), F.col("code_polluant").asc_nulls_first(),
                          F.col("date_mesure").asc_nulls_first(), F.col("nom_site").asc_nulls_first(),
                          F.col("unite").asc_nulls_first())
            .select("code_site", "code_polluant", "moyenne", "minimum", "maximum", "nb_mesures")
            .limit(n))
