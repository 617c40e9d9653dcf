"""Late readings merged into the marts, against a rebuild; reading one day's files only."""

import os
import random
from datetime import date

from pyspark.sql import functions as F

from aeris.operators import gold, incremental, silver
from aeris.plans import jobs
from aeris.schemas import BRONZE_SCHEMA, SILVER_COLUMNS
from aeris.sources import latest_day, of_days, partition_values, read_day, read_mart
from aeris.sources.snapshots import Files
from tests.test_jobs_streaming import record


def frame(spark, records):
    return spark.createDataFrame([tuple(r.get(f.name) for f in BRONZE_SCHEMA.fields) for r in records], BRONZE_SCHEMA)


def random_records(rnd, n, days):
    out = []
    for _ in range(n):
        r = record(f"2026-07-{rnd.choice(days):02d}", site=f"S{rnd.randint(1, 4)}", value=rnd.choice(["", "-3", "12.345", "260", "41", "nan", "7.125", "1e18"]),
                   ingested=f"2026-08-01T00:00:{rnd.randint(0, 59):02d}")
        r |= {"code_polluant": rnd.choice(["NO2", "O3"]), "validite": rnd.choice(["1", "1", "1", "-1", ""]), "nom_site": rnd.choice(["Site", "Renamed"]),
              "date_debut": r["date_debut"][:11] + f"{rnd.randint(0, 5):02d}:00:00"}
        if rnd.random() < 0.03:
            r["date_debut"] = ""
        out.append(r)
    return out


def marts(spark, silver_path, gold_path):
    read = {"silver": read_mart(spark, silver_path).select(*SILVER_COLUMNS)}
    for name, columns in (("moyennes_journalieres", [*gold.MEANS_KEYS, "moyenne", "minimum", "maximum", "nb_mesures"]),
                          ("indice_journalier", [*gold.INDEX_KEYS, "indice_atmo", "polluant_resp", "qualificatif"]),
                          ("depassements", ["code_site", "nom_site", "code_polluant", "horodatage", "date_mesure", "valeur", "unite", "depassement"])):
        read[name] = read_mart(spark, f"{gold_path}/{name}").select(*columns)
    return {name: sorted(map(repr, df.collect())) for name, df in read.items()}


def rebuilt(spark, records):
    s = silver.clean_measurements(frame(spark, records), processed_at=False)
    means = gold.daily_means(s)
    tables = {"silver": s, "moyennes_journalieres": means, "indice_journalier": gold.daily_index(means), "depassements": gold.exceedance_mart(s)}
    return {name: sorted(map(repr, df.collect())) for name, df in tables.items()}


def files_of(path, day):
    folder = os.path.join(path, f"date_mesure={day}")
    return {f: os.stat(os.path.join(folder, f)).st_mtime_ns for f in os.listdir(folder) if f.endswith(".parquet")}


def test_batches_equal_a_rebuild_and_leave_other_days_alone(spark, tmp_path):
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    rnd = random.Random(8)
    batches = [random_records(rnd, 60, [1, 2, 3]), random_records(rnd, 30, [2, 4]), random_records(rnd, 20, [4])]
    batches.append(batches[0][:10])  # a replay
    so_far, replaced = [], 0
    for i, batch in enumerate(batches):
        before = {p: files_of(p, "2026-07-01") for p in (silver_path, f"{gold_path}/moyennes_journalieres")} if i in (1, 2) else None
        done = jobs.add_readings(frame(spark, batch), silver_path, gold_path)
        so_far += batch
        replaced += done["replaced"]
        assert marts(spark, silver_path, gold_path) == rebuilt(spark, so_far)
        if before:
            assert before == {p: files_of(p, "2026-07-01") for p in before}
    assert replaced > 0 and done == {"days": done["days"], "added": 0, "replaced": 0}
    assert jobs.add_readings(frame(spark, []), silver_path, gold_path) == {"days": 0, "added": 0, "replaced": 0}


def test_an_interrupted_run_is_mended_by_the_next(spark, tmp_path, monkeypatch):
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    rnd = random.Random(2)
    first, second = random_records(rnd, 40, [1, 2]), random_records(rnd, 40, [2, 3])
    jobs.add_readings(frame(spark, first), silver_path, gold_path)
    write = jobs.write_partitioned

    def lost(df, path, *args, **kwargs):
        if path.endswith("etat_moyennes"):
            raise OSError("lost after Silver was written")
        write(df, path, *args, **kwargs)

    monkeypatch.setattr(jobs, "write_partitioned", lost)
    try:
        jobs.add_readings(frame(spark, second), silver_path, gold_path)
        raise AssertionError("not reached")
    except OSError:
        pass
    monkeypatch.setattr(jobs, "write_partitioned", write)
    assert len(Files(spark, f"{gold_path}/_journal").names("runs")) == 1
    jobs.add_readings(frame(spark, second), silver_path, gold_path)  # the same batch again: nothing is counted twice
    assert marts(spark, silver_path, gold_path) == rebuilt(spark, first + second)
    assert Files(spark, f"{gold_path}/_journal").names("runs") == []


def test_a_day_s_last_exceedance_can_go(spark, tmp_path):
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    high, low = record("2026-07-01", value="500", ingested="2026-08-02"), record("2026-07-01", value="5", ingested="2026-08-01")
    jobs.add_readings(frame(spark, [high, record("2026-07-02", value="450")]), silver_path, gold_path)
    assert partition_values(spark, f"{gold_path}/depassements") == ["2026-07-01", "2026-07-02"]
    assert jobs.add_readings(frame(spark, [low]), silver_path, gold_path) == {"days": 1, "added": 0, "replaced": 1}
    assert marts(spark, silver_path, gold_path) == rebuilt(spark, [high, low, record("2026-07-02", value="450")])


def test_states_merge_to_the_daily_means(spark):
    rnd = random.Random(5)
    s = silver.clean_measurements(frame(spark, random_records(rnd, 300, [1, 2])), processed_at=False).withColumn("_k", F.xxhash64("horodatage") % 3)
    parts = [incremental.means_state(s.where(F.col("_k") == k)) for k in (-2, -1, 0, 1, 2)]
    merged = incremental.means_of_state(incremental.merge_states(*parts))
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, gold.daily_means(s).select(*merged.columns).collect()))


def files_read(df):
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif hasattr(node, "plan") and "QueryStage" in name:
            todo.append(node.plan())
        if name.startswith("Scan parquet"):
            found.append(int(node.metrics().apply("numFiles").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_the_latest_day_is_read_from_its_files_alone(spark, tmp_path):
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    records = [record(f"2026-07-{d:02d}", site=f"S{s}", value=str(100 * s)) for d in range(1, 8) for s in (1, 3)]
    records.append(dict(record("2026-07-01"), date_debut=""))  # a reading without a day has the default partition
    jobs.add_readings(frame(spark, records), silver_path, gold_path)
    index = f"{gold_path}/indice_journalier"
    assert latest_day(spark, index) == "2026-07-07" and len(partition_values(spark, index)) == 7
    spark.sparkContext.setJobGroup("listing", "listing")
    latest_day(spark, index)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("listing")  # no job at all
    day = read_day(spark, index)
    assert {r.date_mesure for r in day.collect()} == {date(2026, 7, 7)}
    whole = len(os.listdir(os.path.join(index, "date_mesure=2026-07-07")))
    assert 1 <= files_read(read_day(spark, index))[0] <= whole
    assert files_read(read_mart(spark, index))[0] >= 8
    assert latest_day(spark, str(tmp_path / "nowhere")) is None


def test_partitions_are_pruned_by_the_days_that_another_table_holds(spark, tmp_path):
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    records = [record(f"2026-07-{d:02d}", site="S1", value="500" if d == 4 else "5") for d in range(1, 8)]
    jobs.add_readings(frame(spark, records), silver_path, gold_path)
    bad_days = read_mart(spark, f"{gold_path}/indice_journalier").where("indice_atmo >= 5")
    found = of_days(read_mart(spark, silver_path), bad_days)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
    assert [(r.date_mesure, r.valeur) for r in found.collect()] == [(date(2026, 7, 4), 500.0)]
    assert min(files_read(of_days(read_mart(spark, silver_path), bad_days))) == 1
