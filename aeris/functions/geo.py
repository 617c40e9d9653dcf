"""Station geography."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.constants import COMPOUND_PREFIXES, NOISE_WORDS, NON_COMMUNE_PATTERN, ZONE_PREFIXES
from aeris.functions._util import col


def with_zone_name(df: DataFrame, zone: str = "zas", out: str = "zone_name") -> DataFrame:
    """The zone without its prefixes (removed in order, anywhere), stripped, in title case: a letter is
    upper-cased when the character before it is not a letter (``ST MARTIN D'HERES`` -> ``St Martin D'Heres``).

    The characters are a column of their own, so they are split once and not for every character."""
    z = F.coalesce(F.col(zone), F.lit(""))
    for prefix in ZONE_PREFIXES:
        z = F.replace(z, F.lit(prefix), F.lit(""))
    chars = F.col("__chars")
    after_letter = lambda i: F.coalesce(F.get(chars, i - 1).rlike(r"^\p{L}$"), F.lit(False))
    titled = F.transform(chars, lambda ch, i: F.when(after_letter(i), F.lower(ch)).otherwise(F.upper(ch)))
    return (df.withColumn("__chars", F.split(F.regexp_replace(z, r"^\s+|\s+$", ""), ""))
            .withColumn(out, F.array_join(titled, "")).drop("__chars"))


def with_commune(df: DataFrame, name: str = "nom_site", zone: str = "zas", out: str = "commune_extraite") -> DataFrame:
    """Commune candidate from a station name.

    ``_`` and ``-`` become spaces and the name is split on white space. A road code or a noise word in
    first position falls back to the cleaned zone name; a compound prefix (St, Saint, Le, ...)
    keeps the following words up to the first noise word; otherwise the first word is the
    commune. An empty name falls back to the zone. Words are split once, in a projection of their own."""
    words, rest, stop = F.col("__words"), F.col("__rest"), F.col("__stop")
    first = F.get(words, 0)
    noise = F.array(*[F.lit(w) for w in NOISE_WORDS])
    split = F.filter(F.split(F.translate(F.coalesce(F.col(name), F.lit("")), "_-", "  "), r"\s+"), lambda w: w != "")
    kept = F.when(stop == 0, F.size(rest)).otherwise(stop - 1).cast("int")
    commune = (
        F.when(F.size(words) == 0, F.col("__zone"))
        .when(first.rlike("(?i)" + NON_COMMUNE_PATTERN) | F.array_contains(noise, F.lower(first)), F.col("__zone"))
        .when(F.lower(first).isin(*COMPOUND_PREFIXES) & (F.size(words) > 1),
              F.array_join(F.concat(F.array(first), F.slice(rest, F.lit(1), kept)), " "))
        .otherwise(first)
    )
    return (
        with_zone_name(df, zone, "__zone").withColumn("__words", split)
        .withColumn("__rest", F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))))
        .withColumn("__stop", F.array_position(F.transform(rest, lambda w: F.array_contains(noise, F.lower(w))), True))
        .withColumn(out, commune).drop("__zone", "__words", "__rest", "__stop")
    )


def geo_point(lon: str | Column = "longitude", lat: str | Column = "latitude", srid: int = 4326) -> Column:
    """Point struct (lon, lat, srid), NULL unless both coordinates are present."""
    x, y = col(lon), col(lat)
    return F.when(x.isNotNull() & y.isNotNull(),
                  F.struct(x.alias("lon"), y.alias("lat"), F.lit(srid).alias("srid")))
