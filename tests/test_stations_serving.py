"""Station reference, serving reads and analytics on small fixtures."""

from datetime import date

from pyspark.sql import functions as F

from aeris.operators import analytics, serving, stations
from aeris.schemas import GAZETTEER_SCHEMA, STATION_SCHEMA


def test_upsert_semantics(spark):
    base = spark.createDataFrame(
        [("1", "Old", "11", "Urbaine", "Fond", 45.0, 5.0), ("2", "Same", "22", "Rurale", "", 44.0, 4.0),
         ("3", "Gone coords", "33", "Urbaine", "Fond", 43.0, 3.0)], STATION_SCHEMA)
    upd = spark.createDataFrame(
        [("1", "New", None, "Trafic", "Trafic", 46.0, 6.0), ("3", "Gone coords", None, "Urbaine", "Fond", None, None),
         ("4", "Brand new", None, "Rurale", "Fond", 42.0, 2.0)], STATION_SCHEMA)
    got = {r.code_station: r for r in stations.upsert(base, upd).collect()}
    assert (got["1"].nom, got["1"].code_region, got["1"].latitude) == ("New", "11", 46.0)
    assert got["2"].nom == "Same" and got["2"].code_region == "22"
    assert got["3"].latitude is None and got["3"].code_region == "33"
    assert got["4"].code_region is None and got["4"].nom == "Brand new"


def test_insert_missing_seed(spark):
    base = spark.createDataFrame([("NO2", "custom", "ug/m3", 1.0, 2.0)],
                                 "code_polluant string, libelle string, unite string, seuil_info double, seuil_alerte double")
    out = {r.code_polluant: r for r in stations.insert_missing(base, stations.pollutant_seed(spark)).collect()}
    assert len(out) == 6 and out["NO2"].libelle == "custom" and out["PM25"].seuil_info is None


def test_geocode_coverage_and_geometry(spark):
    st = spark.createDataFrame([("A", "Lyon Centre", "ZAG LYON"), ("B", "A7 SUD", "ZAG LYON"),
                                ("C", "Nowhere", "ZAG X"), ("D", "lyon_gerland", "ZAG LYON")],
                               "code_site string, nom_site string, zas string")
    st = st.withColumn("type_implantation", F.lit("Urbaine")).withColumn("type_influence", F.lit("Fond"))
    gaz = spark.createDataFrame([("LYON", "Lyon", "69", 4.8, 45.7), ("lyon", "Lyon 2", "69", 4.9, 45.8)],
                                GAZETTEER_SCHEMA)
    rec = {r.code_site: r for r in stations.geocode(st, gaz).collect()}
    assert rec["A"].commune_extraite == "Lyon" and rec["A"].geocode_ok and rec["A"].commune_label == "Lyon"
    assert rec["B"].commune_extraite == "Lyon" and rec["D"].commune_extraite == "lyon"
    assert not rec["C"].geocode_ok
    cov = stations.geocoding_coverage(stations.geocode(st, gaz)).first()
    assert (cov.communes_localisees, cov.communes_total, cov.stations_localisees, cov.stations_total,
            cov.pct_stations_localisees) == (1, 2, 3, 4, 75)
    empty = stations.geocoding_coverage(stations.geocode(st.limit(0), gaz)).first()
    assert empty.pct_stations_localisees is None
    rows = stations.with_geometry(stations.to_station_rows(stations.geocode(st, gaz))).collect()
    g = {r.code_station: r.geom for r in rows}
    assert g["A"].srid == 4326 and g["A"].lon == 4.8 and g["C"] is None


def _index_serving(spark):
    D1, D2 = date(2026, 7, 1), date(2026, 7, 2)
    return spark.createDataFrame(
        [("1", "Lyon Centre", D2, 4, "Mauvais", "O3", 45.0, 4.0), ("2", "Paris", D2, None, None, None, 48.0, 2.0),
         ("3", "Metz", D2, 4, "Mauvais", "NO2", 49.0, 6.0), ("4", "Nice", D2, 1, "Bon", "PM10", None, None),
         ("5", "Brest", D1, 6, "Extremement mauvais", "PM10", 48.0, -4.0)],
        "code_site string, nom_site string, jour date, indice_atmo int, qualificatif string, polluant_resp string, "
        "latitude double, longitude double")


def test_index_list_null_order_and_day(spark):
    idx = _index_serving(spark)
    all_days = [r.code_site for r in serving.list_indices(idx).collect()]
    assert all_days == ["2", "1", "3", "5"]     # NULL index first under DESC, unlocated dropped
    one = [r.code_site for r in serving.list_indices(idx, day="2026-07-01").collect()]
    assert one == ["5"]
    assert [r.code_site for r in serving.list_indices(idx, day=idx.select(F.min("jour")).scalar()).collect()] == ["5"]


def test_a_day_of_exceedances_is_whole(spark):
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("code_site"), F.lit("n").alias("nom_site"), F.lit("NO2").alias("code_polluant"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("horodatage"),
        F.when(F.col("id") < 2500, F.lit(date(2026, 7, 1))).otherwise(F.lit(date(2026, 7, 2))).alias("jour"),
        F.lit(300.0).alias("valeur"), F.lit("u").alias("unite"), F.lit("info").alias("depassement"))
    assert serving.list_exceedances(rows, day="2026-07-01").count() == 2500
    assert serving.list_exceedances(rows).count() == 1000
    assert analytics.exceedance_table(serving.list_exceedances(rows, limit=None)).count() == 3000


def test_day_stations_and_views(spark):
    idx = _index_serving(spark)
    st = spark.createDataFrame([("1", "Lyon Centre", None, "Urbaine", "", 45.0, 4.0),
                                ("3", "Metz", None, None, "Trafic", 49.0, 6.0)], STATION_SCHEMA)
    ds = day_view(idx, st)
    rows = {r.code_station: r for r in ds.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"].type_influence == "—" and rows["2"].type_station == "—"
    assert [r.code_station for r in analytics.ranking(ds).collect()] == ["1", "3"]
    wb = {r.kind: r.code_station for r in analytics.worst_and_best(ds).collect()}
    assert wb == {"worst": "1", "best": "1"}
    assert analytics.mean_index(ds).first()[0] == 4.0
    assert analytics.mean_index(ds.limit(0)).first()[0] == 0.0
    assert [r.code_station for r in analytics.search_stations(ds, text="LYON").collect()] == ["1"]
    assert analytics.search_stations(ds, qualities=[1, 2]).count() == 0
    assert analytics.label_filter(ds, "Tous").count() == 3
    assert analytics.good_share(idx).first()[0] == 20


def day_view(index_serving, station_rows):
    """The latest day's view: the serving index holds the daily index and the coordinates of one fixture."""
    index = index_serving.filter(F.col("jour") == date(2026, 7, 2)).withColumnRenamed("jour", "date_mesure")
    coords = index.select(F.col("code_site").alias("code_station"), "latitude", "longitude")
    table = coords.join(station_rows.select("code_station", "type_station", "type_influence"), "code_station", "left")
    return analytics.day_stations(index.drop("latitude", "longitude"), table)


def test_question_routing(spark):
    idx = _index_serving(spark)
    st = spark.createDataFrame([("1", "Lyon Centre", None, "Urbaine", "Fond", 45.0, 4.0)], STATION_SCHEMA)
    ds = day_view(idx, st)
    qs = spark.createDataFrame(
        [(1, 0, "Combien de stations ?"), (2, 0, "Où sont les alertes ?"), (3, 0, "Station la plus polluée ?"),
         (4, 0, "Quelle est la meilleure ?"), (5, 0, "Qualité de l'air aujourd'hui ?"), (6, 0, "Bonjour"),
         (7, 0, "help"), (8, 0, "Et à Lyon ?"), (9, 0, "Et à Metz ?"), (10, 0, "rien")],
        "conv_id long, turn long, question string")
    got = {r.conv_id: (r.intent, r.code_station) for r in analytics.route_questions(qs, ds).collect()}
    assert got[1][0] == "count" and got[2][0] == "alerts" and got[3][0] == "worst"
    assert got[4][0] == "best" and got[5][0] == "quality" and got[6][0] == "greeting"
    assert got[7][0] == "help" and got[8] == ("city", "1") and got[9][0] == "city" and got[10][0] == "default"
    assert [r.conv_id for r in analytics.city_lookup(qs, ds).orderBy("conv_id").collect()] == [8, 9]
    assert analytics.city_lookup(qs, ds.limit(0)).count() == 0


def test_topk_lists_with_nulls(spark):
    D = date(2026, 7, 1)
    means = spark.createDataFrame(
        [(f"S{i}", "n", "NO2", D, None if i % 5 == 0 else float(i % 7), 0.0, 1.0, 1, "u") for i in range(30)],
        "code_site string, nom_site string, code_polluant string, jour date, moyenne double, minimum double, "
        "maximum double, nb_mesures long, unite string")
    top = serving.list_means(means, limit=8).collect()
    assert [r.moyenne for r in top[:6]] == [None] * 6    # NULLs first under DESC (reference order)
    exposed = analytics.most_exposed(means, "NO2", n=3).collect()
    assert [r.moyenne for r in exposed] == [6.0, 6.0, 6.0]


def test_city_lookup_matches_brute_force(spark):
    import random
    rng = random.Random(7)
    alphabet = "abé "
    names = []
    for i in range(40):
        first = "".join(rng.choice("abé") for _ in range(rng.randint(2, 7)))
        names.append((f"C{i:02d}", f"{first.upper()} Site", rng.choice([None, 1, 2, 3, 4])))
    ds = spark.createDataFrame(names, "code_station string, nom string, indice int")
    texts = [(k, 0, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for k in range(150)]
    qs = spark.createDataFrame(texts, "conv_id long, turn long, question string")

    def rank(code, ind):
        return (ind is not None, -(ind or 0), code)

    expect = {}
    for k, _, text in texts:
        hits = [(rank(c, ind), c) for c, nom, ind in names
                if len(nom.lower().split(" ")[0]) >= 4 and nom.lower().split(" ")[0] in text.lower()]
        if hits:
            expect[k] = min(hits)[1]
    assert {r.conv_id: r.code_station for r in analytics.city_lookup(qs, ds).collect()} == expect
    assert len(expect) > 20


def test_a_long_token_meets_the_words_through_their_filter(spark):
    """A token of a million letters without a space: its substrings pass one by one, and only possible words are shuffled."""
    from aeris.operators.analytics import city_lookup
    ds = spark.createDataFrame([("1", "Metz-Centre", 3), ("2", "Anglet", 2), ("3", "Aix", 1)], "code_station string, nom string, indice int")
    long = "x" * 500_000 + "anglet" + "y" * 500_000
    questions = spark.createDataFrame([(1, 0, long), (2, 0, "a Metz-centre ?"), (3, 0, "aix"), (4, 0, None)], "conv_id long, turn long, question string")
    found = city_lookup(questions, ds)
    assert {r.conv_id: (r.code_station, r.mot) for r in found.collect()} == {1: ("2", "anglet"), 2: ("1", "metz-centre")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Generate explode"):] if "Generate explode" in plan else ""
    filters = [line for line in plan.splitlines() if "Filter" in line and "bit_get" in line]
    assert filters and "Subquery" in plan and below  # the filter is on the exploded substrings, ahead of the join's exchange
