"""Fixture tests for the Silver and Gold jobs (the reference has none)."""

from datetime import date

from pyspark.sql import functions as F

from aeris.operators import gold, quality, silver
from aeris.schemas import BRONZE_COLUMNS

BASE = dict(date_debut="2026/07/01 10:00:00", date_fin="2026/07/01 11:00:00", organisme="O", code_zas="Z",
            zas="ZAG X", code_site="S1", nom_site="Site 1", type_implantation="Urbaine", polluant_source="NO2",
            code_polluant="NO2", type_influence="Fond", type_valeur="h", valeur="10", valeur_brute="10",
            unite_source="µg-m3", unite="ug/m3", code_qualite="A", validite="1", _ingested_at="2026-07-01T10:05:00")


def bronze(spark, *overrides):
    rows = [tuple({**BASE, **o}[c] for c in BRONZE_COLUMNS) for o in overrides]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in BRONZE_COLUMNS))


def test_dirty_values_validity_and_dedup(spark):
    b = bronze(spark,
               dict(code_site="A", valeur=""),
               dict(code_site="B", valeur="12,4"),
               dict(code_site="C", valeur="NaN"),
               dict(code_site="D", valeur="-0.8"),
               dict(code_site="E", validite=None),
               dict(code_site="F", validite="-1"),
               dict(code_site="G", validite="4"),
               dict(code_site="H", date_debut="not a date"),
               dict(code_site="I", _ingested_at="2026-07-01T10:06:00", valeur="5"),
               dict(code_site="I", _ingested_at="2026-07-01T10:05:00", valeur="7"),
               dict(code_site="J"), dict(code_site="J"))
    s = {r.code_site: r for r in silver.clean_measurements(b).collect()}
    assert s["A"].valeur is None and s["B"].valeur is None and s["C"].valeur is None
    assert s["D"].valeur == -0.8
    assert "E" not in s and "F" not in s          # NULL and -1 validity dropped
    assert s["G"].validite == "4"
    assert s["H"].horodatage is None and s["H"].date_mesure is None
    assert s["I"].valeur == 7.0                    # first ingested survives
    assert len([r for r in silver.clean_measurements(b).collect() if r.code_site == "J"]) == 1
    m = silver.run_metrics(b).first()
    assert (m.rows_read, m.rows_invalid, m.rows_valid) == (12, 1, 10)
    assert m.duplicates_removed == 2 and m.rows_written == 8


def test_null_keys_are_equal_in_dedup(spark):
    b = bronze(spark, dict(date_debut="bad", valeur="1"), dict(date_debut="worse", valeur="2"))
    assert silver.clean_measurements(b).count() == 1


def test_threshold_edges(spark):
    cases = [("NO2", 199.99, None), ("NO2", 200, "info"), ("NO2", 400, "alerte"), ("O3", 180, "info"),
             ("O3", 239.9, "info"), ("O3", 240, "alerte"), ("PM10", 49.9, None), ("PM10", 50, "info"),
             ("PM10", 80, "alerte"), ("SO2", 300, "info"), ("SO2", 500, "alerte"), ("PM25", 10000, None),
             ("CO", 10000, None)]
    b = bronze(spark, *[dict(code_site=f"S{i}", code_polluant=p, valeur=str(v)) for i, (p, v, _) in enumerate(cases)])
    got = {r.code_site: r.depassement for r in silver.clean_measurements(b).collect()}
    assert [got[f"S{i}"] for i in range(len(cases))] == [c[2] for c in cases]


def test_day_filter(spark):
    b = bronze(spark, dict(code_site="A"), dict(code_site="B", date_debut="2026/07/02 10:00:00"))
    assert [r.code_site for r in silver.clean_measurements(b, day="2026-07-02").collect()] == ["B"]


def means_of(spark, rows):
    df = spark.createDataFrame(rows, "code_site string, nom_site string, code_polluant string, date_mesure date, "
                                     "unite string, valeur double")
    return gold.daily_means(df)


D = date(2026, 7, 1)


def test_daily_means_clamp_round_count(spark):
    m = means_of(spark, [("S", "n", "NO2", D, "u", -3.0), ("S", "n", "NO2", D, "u", 1.015),
                         ("S", "n", "NO2", D, "u", None)]).first()
    assert m.minimum == 0.0 and m.maximum == 1.02 and m.nb_mesures == 3
    assert m.moyenne == 0.51  # (0 + 1.015) / 2 = 0.5075 -> half up


def test_index_ties_and_all_null(spark):
    rows = [("T", "t", "NO2", D, "u", 100.0), ("T", "t", "O3", D, "u", 120.0),   # both level 3 -> NO2
            ("N", "n", "NO2", D, "u", None),                                     # all NULL
            ("P", "p", "PM10", D, "u", 10.0), ("P", "p", "PM25", D, "u", None)]  # one NULL
    idx = {r.code_site: r for r in gold.daily_index(means_of(spark, rows)).collect()}
    assert (idx["T"].indice_atmo, idx["T"].polluant_resp, idx["T"].qualificatif) == (3, "NO2", "Degrade")
    assert (idx["N"].indice_atmo, idx["N"].polluant_resp, idx["N"].qualificatif) == (None, None, None)
    assert (idx["P"].indice_atmo, idx["P"].polluant_resp) == (1, "PM10")


def test_renamed_site_is_caught_by_uniqueness(spark):
    rows = [("S", "old", "NO2", D, "ug/m3", 1.0), ("S", "new", "NO2", D, "ug/m3", 2.0),
            ("S", "new", "NO2", D, "mg/m3", 2.0)]
    m = means_of(spark, rows)
    assert m.count() == 3
    rep = quality.uniqueness_report({"m": (m, ["code_site", "code_polluant", "date_mesure"])}).first()
    assert rep.cles_dupliquees == 1 and rep.lignes == 3
    assert gold.daily_index(m).count() == 2


def test_exceedance_mart_and_distribution(spark):
    b = bronze(spark, dict(code_site="A", valeur="450"), dict(code_site="B", valeur="250"), dict(code_site="C"))
    s = silver.clean_measurements(b)
    assert sorted(r.depassement for r in gold.exceedance_mart(s).collect()) == ["alerte", "info"]
    dist = {r.depassement: r.nb for r in silver.exceedance_distribution(s).collect()}
    assert dist == {"alerte": 1, "info": 1, None: 1}
    assert s.filter(F.col("_processed_at").isNotNull()).count() == 3


def test_run_metrics_one_day_and_codes(spark):
    b = bronze(spark, dict(code_site="A"), dict(code_site="B", validite="-1"),
               dict(code_site="C", date_debut="2026/07/02 10:00:00"), dict(code_site="C", date_debut="2026/07/02 10:00:00"))
    m = silver.run_metrics(b, day="2026-07-02").first()
    assert (m.rows_read, m.rows_in_scope, m.rows_invalid, m.rows_written, m.duplicates_removed) == (4, 2, 0, 1, 1)


def test_hours_that_a_zone_skips_stay_two_readings(spark):
    b = bronze(spark, dict(date_debut="2026/03/29 02:00:00"), dict(date_debut="2026/03/29 03:00:00"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        assert silver.clean_measurements(b).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_day_column_filters_before_the_deduplication(spark):
    b = bronze(spark, dict(code_site="A"), dict(code_site="A"), dict(code_site="B", date_debut="2026/07/02 10:00:00"))
    day = F.lit("2026-07-01").cast("date")
    assert [r.code_site for r in silver.clean_measurements(b, day=day).collect()] == ["A"]


def test_survivor_of_equal_times_is_the_same_in_any_order(spark):
    rows = [dict(nom_site=n, unite=u) for n in ("b", "a") for u in ("y", "x")]
    for order in (rows, rows[::-1]):
        r = silver.clean_measurements(bronze(spark, *order)).first()
        assert (r.nom_site, r.unite) == ("a", "x")
