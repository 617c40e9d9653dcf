"""The reference's index assertions, replayed on the Spark sub-index expression."""

import math

from aeris.constants import INDEX_GRID, INDEX_LABELS
from aeris.functions import index_label, sub_index


def level(spark, pollutant, mean):
    df = spark.createDataFrame([(pollutant, float(mean))], "code_polluant string, moyenne double")
    return df.select(sub_index("moyenne", "code_polluant")).first()[0]


def test_o3_degraded(spark):
    assert level(spark, "O3", 101.37) == 3


def test_no2_good(spark):
    assert level(spark, "NO2", 30.0) == 1


def test_pm25_fair(spark):
    assert level(spark, "PM25", 18.15) == 2


def test_pm10_exact_bound(spark):
    assert level(spark, "PM10", 20.0) == 1
    assert level(spark, "PM10", 20.1) == 2


def test_extreme_values(spark):
    assert level(spark, "O3", 500.0) == 6
    assert level(spark, "PM10", 1000.0) == 6


def test_grid_complete():
    for pollutant, bounds in INDEX_GRID.items():
        assert len(bounds) == 5, pollutant  # levels 1..5 bounded, 6 above
        assert list(bounds) == sorted(bounds)


def test_labels_complete(spark):
    assert set(INDEX_LABELS) == {1, 2, 3, 4, 5, 6}
    df = spark.createDataFrame([(i,) for i in range(1, 7)] + [(None,)], "indice_atmo int")
    got = [r[0] for r in df.select(index_label("indice_atmo")).collect()]
    assert got == [INDEX_LABELS[i] for i in range(1, 7)] + [None]


def test_every_bound_and_just_above(spark):
    rows, expect = [], []
    for p, bounds in INDEX_GRID.items():
        for lvl, b in enumerate(bounds, start=1):
            rows += [(p, float(b)), (p, float(b) + 0.01)]
            expect += [lvl, lvl + 1]
    rows += [("C6H6", 1.0), ("NO2", None), ("NO2", math.inf)]
    expect += [None, None, 6]
    df = spark.createDataFrame(rows, "code_polluant string, moyenne double")
    got = [r[0] for r in df.select(sub_index("moyenne", "code_polluant")).collect()]
    assert got == expect
