"""Column expressions on small fixtures: index levels, exceedance classes, intents, communes, display."""

from pyspark.sql import functions as F

from aeris.functions import (
    exceedance_class, first_non_empty, index_colour, localised_label, marker_radius, parse_source_timestamp, question_intent,
    sub_index, with_commune, with_zone_name,
)


def test_index_levels_and_exceedance_classes(spark):
    rows = [(p, v) for p in ("NO2", "O3", "PM10", "PM25", "SO2", "CO", "XX")
            for v in (None, -1.0, 0.0, 20.0, 40.0, 50.0, 80.0, 100.0, 180.0, 200.0, 240.0, 400.0, 500.0, 1e6)]
    df = spark.createDataFrame(rows, "code_polluant string, moyenne double").withColumn("valeur", F.col("moyenne"))
    levels = {(r[0], r[1]): r[2] for r in df.select("code_polluant", "moyenne", sub_index("moyenne", "code_polluant")).collect()}
    assert [levels["NO2", v] for v in (None, -1.0, 40.0, 50.0, 100.0, 200.0, 240.0, 400.0)] == [None, 1, 1, 2, 3, 4, 5, 6]
    assert levels["CO", 20.0] == 5 and levels["PM25", 80.0] == 6 and levels["XX", 20.0] is None
    classes = [r[0] for r in df.select(exceedance_class("valeur", "code_polluant")).collect()]
    assert classes.count("alerte") == 17 and classes.count("info") == 6


def test_intents(spark):
    qs = ["Combien de stations ?", "how many stations", "alerte", "Überschreitung", "la plus polluée",
          "best place", "polluant", "qualité", "hi there", "help me", "rien du tout", None, "STATION COMBIEN"]
    df = spark.createDataFrame([(q,) for q in qs], "question string")
    expected = ["count", "count", "alerts", "alerts", "worst", "best", "pollutant", "quality", "greeting", "help", None, None, "count"]
    assert [r[0] for r in df.select(question_intent("question", True)).collect()] == expected
    without = [r[0] for r in df.select(question_intent("question", F.lit(False))).collect()]
    assert without == [None if e in ("best", "pollutant") else e for e in expected]  # these need an index


def test_communes_of_odd_names(spark):
    cases = [("Saint-Etienne Sud", "ZAR ST ETIENNE", "Saint Etienne"), ("le  havre centre", "ZA LE HAVRE", "le havre"), (None, None, ""),
             ("RD934 X", "ZAG  AIX-EN-PROVENCE ", "Aix-En-Provence"), ("  ", "ZAG élan'ville", "Élan'Ville"), ("Saint", "Z", "Saint")]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "nom_site string, zas string")
    assert [r.commune_extraite for r in with_commune(df).collect()] == [c for _, _, c in cases]
    assert with_zone_name(df, "zas").columns == ["nom_site", "zas", "zone_name"]


def test_source_hours_do_not_move_with_the_session_zone(spark):
    texts = ["2026/03/29 02:00:00", "2026/03/29 03:00:00", "2026/10/25 02:30:00", "2024/99/99 00:00:00", "2026-03-29 02:00:00", "2026/3/29 2:00:00", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        got = [r[0] for r in df.select(parse_source_timestamp("t").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2026-03-29 02:00:00", "2026-03-29 03:00:00", "2026-10-25 02:30:00", None, None, None, None, None]


def test_display_attributes(spark):
    df = spark.createDataFrame([(1, ""), (6, "x"), (None, None), (9, "y")], "indice_atmo int, nom string")
    rows = df.select(index_colour("indice_atmo"), marker_radius("indice_atmo"),
                     localised_label("indice_atmo", F.lit("de")), localised_label("indice_atmo", F.lit("??")),
                     first_non_empty("nom", default="Station")).collect()
    assert [r[0] for r in rows] == ["#50CCAA", "#7D2181", "#8A94A6", "#8A94A6"]
    assert [r[1] for r in rows] == [5.8, 5.0 + 0.8 * 6, 5.0, 5.0 + 0.8 * 6]
    assert [r[2] for r in rows] == ["Gut", "Extrem schlecht", "Nicht gemessen", "Nicht gemessen"]
    assert rows[0][3] == "Bon"                 # unknown language falls back to French
    assert [r[4] for r in rows] == ["Station", "x", "Station", "y"]
