"""Binding of the driver's generic tables to the air-quality domain (test scaffolding).

No air-quality data ships with the test tables, so they are projected into the domain
shapes; every operator takes any DataFrame with the right columns.

* ``events``   -> daily source CSV rows: ``user_id`` is the site, ``ts`` truncated to the
  hour is the measurement start (hour duplicates are real duplicates), ``value`` the
  reading, ``event_type`` the pollutant label (``error`` -> C6H6, dropped by C1).
  ``k`` from ``props`` reaches the other branches: SO2 and CO (k%19), invalid flags (k%10=0 -> ``-1``), empty
  readings (k%17=0), negative readings (k%13=0), empty validity (k%23=0), other unit spellings (k%7=0, CO, k%29=0
  an unknown one longer than its column), missing and impossible hours (k%37=0, k%41=0) and renamed sites (k%31=0).
  Site names cycle through a plain name, a compound one, a road code, a noise word and none.
* ``supplier`` -> station base rows (every 17th with a region that doesn't exist) and the gazetteer: plain, compound
  and zone names; suppliers with a negative balance have no coordinates (exact binary fractions otherwise).
* ``nation``   -> regions.  ``conversations`` (all turns) -> questions: the text after an opening that
  goes through all intents by ``(conv_id + turn) % 12``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.functions._util import literal_map_sql, sql_literal
from aeris.schemas import SOURCE_COLUMNS

# Binding choices (scaffolding, not domain rules).
EVENT_LABELS = {"view": "O3", "purchase": "PM10", "signup": "PM2.5", "click": "NO2", "error": "C6H6"}
SITE_KINDS = ("Urbaine", "Periurbaine", "Rurale")
INFLUENCES = ("Fond", "Trafic", "Industrielle", "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: tuple[str, ...], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _pick_sql(values: tuple[str, ...], key: str) -> str:
    arr = ", ".join(sql_literal(v) for v in values)
    return f"element_at(array({arr}), CAST({key} % {len(values)} + 1 AS INT))"


def supplier_name(number: str) -> str:
    return f"concat('Supplier#', lpad(CAST({number} AS STRING), 9, '0'))"


SITE_NAME = (f"concat(CASE user_id % 8 WHEN 3 THEN concat('Saint ', {supplier_name('user_id')}, ' Centre') "
             f"WHEN 4 THEN concat('A7 ', {supplier_name('user_id')}) WHEN 5 THEN concat('Rocade_Sud-', CAST(user_id AS STRING)) "
             f"WHEN 6 THEN '' ELSE {supplier_name('user_id')} END, CASE WHEN _k % 31 = 0 THEN ' Bis' ELSE '' END)")


def bind_source_rows(events: DataFrame) -> DataFrame:
    """``events`` -> source CSV rows (23 text columns) + deterministic ``_ingested_at``.
    ``k`` is parsed from the JSON once per row, in its own projection."""
    events = events.select("ts", "user_id", "event_type", "value",
                           F.expr("TRY_CAST(get_json_object(props, '$.k') AS INT)").alias("_k"))
    k = "_k"
    hour = "date_trunc('hour', ts)"
    start = (f"CASE WHEN {k} % 37 = 0 THEN '' WHEN {k} % 41 = 0 THEN '2024/99/99 00:00:00' "
             f"ELSE date_format({hour}, 'yyyy/MM/dd HH:mm:ss') END")
    value_text = (f"CASE WHEN {k} % 17 = 0 THEN '' WHEN {k} % 13 = 0 THEN CAST(0.0D - value AS STRING) "
                  "ELSE CAST(value AS STRING) END")
    cols = {
        "Date de début": start,
        "Date de fin": f"date_format({hour} + INTERVAL 1 HOUR, 'yyyy/MM/dd HH:mm:ss')",
        "Organisme": "concat('AASQA ', CAST(user_id % 13 AS STRING))",
        "code zas": "concat('FRZAG', lpad(CAST(user_id % 25 AS STRING), 2, '0'))",
        "Zas": "concat(element_at(array('ZAG ', 'ZAR ', 'ZA '), CAST(user_id % 3 + 1 AS INT)), 'NATION ', CAST(user_id % 25 AS STRING))",
        "code site": "CAST(user_id AS STRING)",
        "nom site": SITE_NAME,
        "type d'implantation": _pick_sql(SITE_KINDS, "user_id"),
        "Polluant": f"CASE WHEN {k} % 19 = 1 THEN 'SO2' WHEN {k} % 19 = 2 THEN 'CO' ELSE {literal_map_sql(EVENT_LABELS)}[event_type] END",
        "type d'influence": _pick_sql(INFLUENCES, "user_id"),
        "discriminant": "'A'",
        "Réglementaire": "'Oui'",
        "type d'évaluation": "'mesures fixes'",
        "procédure de mesure": "'auto'",
        "type de valeur": "'moyenne horaire brute'",
        "valeur": value_text,
        "valeur brute": value_text,
        "unité de mesure": (f"CASE WHEN {k} % 29 = 0 THEN 'parties par milliard (ppb)' WHEN {k} % 19 = 2 THEN 'mg-m3' "
                            f"WHEN {k} % 7 = 0 THEN 'µg/m3' ELSE 'µg-m3' END"),
        "taux de saisie": "''",
        "couverture temporelle": "''",
        "couverture de données": "''",
        "code qualité": "'A'",
        "validité": f"CASE WHEN {k} % 10 = 0 THEN '-1' WHEN {k} % 23 = 0 THEN '' ELSE '1' END",
    }
    return events.select(*[F.expr(cols[c]).alias(c) for c in SOURCE_COLUMNS],
                         F.expr("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")").alias("_ingested_at"))


def _lat(s: DataFrame) -> Column:
    return F.lit(41.0) + (F.col("s_suppkey") % 64).cast("double") * F.lit(0.125)


def _lon(s: DataFrame) -> Column:
    return F.lit(-4.5) + (F.col("s_nationkey") % 25).cast("double") * F.lit(0.5)


def bind_gazetteer(supplier: DataFrame) -> DataFrame:
    """``supplier`` -> gazetteer (commune, label, contexte, longitude, latitude): its name, a compound form of it
    and its nation as communes."""
    located = F.col("s_acctbal") >= 0
    names = F.array(F.col("s_name"), F.concat(F.lit("Saint "), F.col("s_name")), F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")))
    return supplier.select(F.explode(names).alias("commune"), F.col("s_name").alias("label"),
                           F.concat(F.lit("region "), F.col("s_nationkey").cast("string")).alias("contexte"),
                           F.when(located, _lon(supplier)).alias("longitude"), F.when(located, _lat(supplier)).alias("latitude"))


def bind_misspelt(stations: DataFrame) -> DataFrame:
    """Stations whose names are written as people write them, by code: a letter left out, Saint abbreviated, accents, two wrong
    letters, only the first word."""
    kind = F.col("code_site").try_cast("long") % 6
    name = F.col("nom_site")
    return stations.withColumn("nom_site", F.when(kind == 1, F.replace(name, F.lit("Supplier"), F.lit("Suplier")))
                               .when(kind == 3, F.replace(F.replace(name, F.lit("Saint"), F.lit("St")), F.lit("Supplier"), F.lit("Süppliér")))
                               .when(kind == 4, F.replace(name, F.lit("Supplier"), F.lit("Sapplyer")))
                               .when(kind == 5, F.split_part(name, F.lit("#"), F.lit(1))).otherwise(name))


def bind_station_base(supplier: DataFrame) -> DataFrame:
    """``supplier`` -> station rows as a previous load left them (with ``code_region``)."""
    located = F.col("s_acctbal") >= 0
    return supplier.select(
        F.col("s_suppkey").cast("string").alias("code_station"),
        F.col("s_name").alias("nom"),
        F.when(F.col("s_suppkey") % 17 == 0, "99").otherwise(F.col("s_nationkey").cast("string")).alias("code_region"),
        _pick(SITE_KINDS, F.col("s_suppkey")).alias("type_station"),
        _pick(INFLUENCES, F.col("s_suppkey")).alias("type_influence"),
        F.when(located, _lat(supplier)).alias("latitude"),
        F.when(located, _lon(supplier)).alias("longitude"),
    )


def bind_regions(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").cast("string").alias("code_region"), F.col("n_name").alias("nom"))


#: Openings of the bound questions, one for each intent; the last two of the cycle have none.
OPENINGS = ("Combien de stations ? ", "Où sont les alertes ? ", "La station la plus polluée ? ", "La meilleure ? ", "Quel polluant ? ",
            "Qualité de l'air ? ", "Bonjour ! ", "Help! ", "", "")


def bind_questions(conversations: DataFrame) -> DataFrame:
    number = (F.col("conv_id") + F.col("turn")).cast("long")
    city = F.concat(F.lit("A "), F.expr(supplier_name("(conv_id * 3 + turn) % 120")), F.lit(" ? "))
    opening = F.element_at(F.array(*[F.lit(x) for x in OPENINGS], city, F.lower(city)), (number % (len(OPENINGS) + 2) + 1).cast("int"))
    return conversations.select("conv_id", "turn", F.concat(opening, F.coalesce(F.col("text"), F.lit(""))).alias("question"))
