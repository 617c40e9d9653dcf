"""Ranked approximate geocoding against known misspellings and against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from aeris.operators.geocoding import best_places, geocode_approximate, place_name

GAZETTEER = "commune string, label string, contexte string, longitude double, latitude double"
STATIONS = "code_site string, nom_site string, zas string"


@pytest.fixture(scope="module")
def gazetteer(spark):
    names = ["Grenoble", "Mérignac", "Saint-Denis", "Saint-Martin-d'Hères", "Aix-en-Provence", "Aix-les-Bains", "Évreux", "Le Havre", "Metz", "Metzervisse",
             "Lyon", "Roubaix", "Bœrsch", "Sainte-Marie-aux-Mines"]
    return spark.createDataFrame([(n, n, "", float(i), 45.0) for i, n in enumerate(names)], GAZETTEER)


@pytest.mark.parametrize("site, label, par, edits", [
    ("Grenoble Les Frenes", "Grenoble", "exact", 0),
    ("Grenobel", "Grenoble", "orthographe", 1),          # one letter left out of the entry, in front of another
    ("Grennoble", "Grenoble", "orthographe", 1),
    ("Gernoble", "Grenoble", None, None),                 # 8 letters allow one edit; swapped letters are two
    ("Merignac - Magudas", "Mérignac", "exact", 0),       # a missing accent is no edit
    ("St Denis Stade", "Saint-Denis", "exact", 0),
    ("ST MARTIN D HERES", "Saint-Martin-d'Hères", "exact", 0),
    ("Ste Marie aux Minse", "Sainte-Marie-aux-Mines", "orthographe", 2),
    ("Aix", "Aix-en-Provence", "premiers mots", None),    # ties by label
    ("BOERSCH", "Bœrsch", "exact", 0),
    ("Evreux Centre", "Évreux", "exact", 0),
    ("Roubex", None, None, None),                         # 6 letters allow one edit
    ("Mettz", "Metz", "orthographe", 1),
    ("Lion", "Lyon", "orthographe", 1),
    ("Xyz", None, None, None),
])
def test_misspelt_names(spark, gazetteer, site, label, par, edits):
    row = geocode_approximate(spark.createDataFrame([("1", site, "ZAG NOWHERE")], STATIONS), gazetteer).first()
    if site == "Gernoble":
        assert row.commune_label is None and not row.geocode_ok
        return
    if site == "Grenobel":  # el for le: two edits of 8 letters, so no answer
        assert row.commune_label is None
        return
    assert (row.commune_label, row.par, row.edits) == (label, par, edits)
    assert row.geocode_ok == (label is not None)


def test_answers_against_all_pairs(spark):
    rnd = random.Random(4)
    name = lambda: "".join(rnd.choices("abé ", k=rnd.randint(1, 12)))  # noqa: E731  dense: many ties, runs of equal letters, empty names
    entries = spark.createDataFrame([(name(), f"L{rnd.randint(0, 40)}", "c", None if i % 7 == 0 else float(i), 1.0) for i in range(250)] + [(None, "L0", "c", 1.0, 1.0)], GAZETTEER)
    asked = spark.createDataFrame([(name(),) for _ in range(250)] + [(None,)], "raw string").select(place_name(F.col("raw")).alias("name"))
    got = {r.name: tuple(r)[1:] for r in best_places(asked, entries).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    low = lambda v: (v is not None, v)  # noqa: E731  nulls first
    known = {}
    for r in entries.withColumn("name", place_name(F.col("commune"))).collect():
        if r.name:
            known[r.name] = min(known.get(r.name, (r.label, r.contexte, r.longitude, r.latitude)), (r.label, r.contexte, r.longitude, r.latitude), key=lambda p: tuple(map(low, p)))
    want = {}
    for q in {r.name for r in asked.collect()} - {""}:
        allowed = 0 if len(q) < 4 else 1 if len(q) < 9 else 2
        answers = []
        for entry, place in known.items():
            d = distance(q, entry)
            if d <= allowed:
                answers.append((d, place))
            elif len(q) >= 3 and entry.startswith(q + " "):
                answers.append((3, place))
        if answers:
            rank, place = min(answers, key=lambda x: (x[0], *map(low, x[1])))
            want[q] = (*place, rank if rank < 3 else None, "exact" if rank == 0 else "orthographe" if rank < 3 else "premiers mots")
    assert got == want and {v[-1] for v in want.values()} == {"exact", "orthographe", "premiers mots"}


def test_plan_has_no_pair_list(spark, gazetteer):
    stations = spark.createDataFrame([("1", "Grenoble", ""), ("2", None, None)], STATIONS)
    out = geocode_approximate(stations, gazetteer)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r.code_site: r.commune_label for r in out.collect()} == {"1": "Grenoble", "2": None}
    assert geocode_approximate(stations, gazetteer.limit(0)).where("geocode_ok").count() == 0
    assert geocode_approximate(stations.limit(0), gazetteer).count() == 0


def test_keys_of_names_are_not_broadcast(spark, tmp_path):
    """A file's size says little about the keys that its names make, so no side of them goes through the driver."""
    places = [(f"Commune {i:06d}", f"C{i}", "c", 1.0, 2.0) for i in range(300)]
    spark.createDataFrame(places, GAZETTEER).write.parquet(f"{tmp_path}/gazetteer")
    spark.createDataFrame([("Comune 000007",), ("Comane 000008",), ("Commune 000009",), ("Commune",)], "name string").write.parquet(f"{tmp_path}/asked")
    asked = spark.read.parquet(f"{tmp_path}/asked").select(F.lower("name").alias("name"))
    out = best_places(asked, spark.read.parquet(f"{tmp_path}/gazetteer"))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.name: (r.commune_label, r.edits, r.par) for r in out.collect()} == {
        "comune 000007": ("C7", 1, "orthographe"), "comane 000008": ("C8", 2, "orthographe"), "commune 000009": ("C9", 0, "exact"),
        "commune": ("C0", None, "premiers mots")}
