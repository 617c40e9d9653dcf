"""The reference's commune-extraction assertions, replayed on the Spark expression."""

import pytest

from aeris.functions import with_commune, with_zone_name

# Names, zones and the communes they must give.
CASES = [
    ("CARPENTRAS", "ZAG AVIGNON", "CARPENTRAS"),
    ("ANGLET", "ZAG BAYONNE", "ANGLET"),
    ("Roubaix Serres", "ZAG LILLE", "Roubaix"),
    ("Grenoble Les Frenes", "ZAG GRENOBLE", "Grenoble"),
    ("Merignac - Magudas", "ZAG BORDEAUX", "Merignac"),
    ("Bordeaux_GAUTIER", "ZAG BORDEAUX", "Bordeaux"),
    ("A7 SUD LYONNAIS", "ZAG LYON", "Lyon"),
    ("N118 Sud", "ZAG PARIS", "Paris"),
    ("ZI Estuaire Adour", "ZAG BAYONNE", "Bayonne"),
    ("St Martin d'Heres", "ZAG GRENOBLE", "St Martin d'Heres"),
    ("St Denis Stade", "ZAG PARIS", "St Denis"),
    ("", "ZAG METZ", "Metz"),
]


@pytest.fixture(scope="module")
def communes(spark):
    df = spark.createDataFrame([(a, b) for a, b, _ in CASES], "nom_site string, zas string")
    return [r.commune_extraite for r in with_commune(df).collect()]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_commune(communes, i):
    assert communes[i] == CASES[i][2]


def test_zone_title_case(spark):
    df = spark.createDataFrame([("ZAG ST MARTIN D'HERES",), ("ZAR  grenoble-nord ",), ("ZA lyon",), (None,)],
                               "z string")
    got = [r.zone_name for r in with_zone_name(df, "z").collect()]
    assert got == ["St Martin D'Heres", "Grenoble-Nord", "Lyon", ""]
