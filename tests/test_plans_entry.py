"""Driver entry points and physical-plan properties of the registered queries."""

import pytest

import __spark_entry__ as E
from aeris.operators import analytics as A
from aeris.plans import catalog, oracle
from aeris.session import checkpoint_dir

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["code_site", "nom_site", "date_mesure", "indice_atmo", "polluant_resp", "qualificatif"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(oracle.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plans_have_no_python_and_building_them_reads_footers_only(spark, name):
    spark.sparkContext.setJobGroup(f"build-{name}", "build")
    df = catalog.queries()[name](spark, SF)
    tracker = spark.sparkContext.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup(f"build-{name}")
             for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
    assert tasks == [1] * len(tasks) and len(tasks) <= 4  # the schema of each table read
    text = plan_text(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in text, (name, node)


def test_scan_prunes_columns_and_station_join_is_broadcast(spark):
    df = E.queries()["serving_index"](spark, SF)
    df.collect()  # AQE settles the final plan on execution
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text or "BroadcastExchange" in text
    events_scan = [ln for ln in text.splitlines() if "events.parquet" in ln or "ReadSchema" in ln]
    assert all("event_id" not in ln for ln in events_scan if "ReadSchema: struct<ts" in ln)


def test_dedup_uses_partial_group_limit(spark):
    text = E.queries()["silver_measurements"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text


def test_day_views_filter_the_day_below_one_deduplication(spark):
    for name in ("day_stations", "list_indices_latest_day", "list_exceedances_latest_day"):
        lines = plan_text(catalog.queries()[name](spark, SF)).splitlines()
        windows = [i for i, line in enumerate(lines) if " Window [" in line]
        days = [i for i, line in enumerate(lines) if "Subquery subquery" in line]  # the latest day, in a filter of the scan
        assert len(windows) == 1 and days and min(days) > windows[0], name


def test_fixed_days_are_filtered_below_the_deduplication(spark):
    for name in ("list_indices_day", "list_means_day", "list_exceedances_day", "silver_one_day"):
        lines = plan_text(catalog.queries()[name](spark, SF)).splitlines()
        windows = [i for i, line in enumerate(lines) if " Window [" in line]
        days = [i for i, line in enumerate(lines) if "Filter" in line and "2024/01/15" in line]
        assert len(windows) == 1 and days and min(days) > windows[0], name


def test_reports_deduplicate_once(spark):
    for name in ("uniqueness_report", "non_empty_report"):
        assert plan_text(catalog.queries()[name](spark, SF)).count(" Window [") == 1, name


def test_every_term_of_the_station_search_excludes_some(spark):
    ds = catalog.Views(catalog.Domain(spark, "/root/testdata/sf0.01")).ds.collect()
    stations = spark.createDataFrame(ds)
    found = A.search_stations(stations, **catalog.SEARCH).count()
    assert found > 0
    for term in catalog.SEARCH:
        assert A.search_stations(stations, **{k: v for k, v in catalog.SEARCH.items() if k != term}).count() > found, term


def test_a_missing_shared_folder_is_an_error_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        checkpoint_dir(Session())
