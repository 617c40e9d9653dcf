"""Loads behind constraints, snapshots that replace a table without a gap, and the jobs that use both."""

import json

import pytest
from pyspark.sql import functions as F

from aeris.operators.constraints import CONTRACTS, REASONS, Contract, QuarantineExceeded, accepted, judge, quarantined
from aeris.plans import jobs
from aeris.sources import read_documents, read_snapshot, replace_snapshot, vacuum, versions, write_documents
from aeris.sources.snapshots import CommitConflict, NoSnapshot, Files, snapshot_folder
from tests.test_jobs_streaming import record

INDEX = "code_site string, nom_site string, jour date, indice_atmo int, qualificatif string, polluant_resp string, latitude double, longitude double"


def index_rows(spark, rows):
    import datetime
    full = [(s, n, datetime.date(2026, 7, d) if d else None, i, "Bon", "NO2", None, None) for s, n, d, i in rows]
    return spark.createDataFrame(full, INDEX)


def test_reasons_and_first_of_a_key(spark):
    df = index_rows(spark, [("S1", "B", 1, 2), ("S1", "A", 1, 3), ("S1", "A" * 201, 1, 1), ("S2", "x", 1, 40_000), ("S" * 21, "y" * 201, 2, -40_000),
                            (None, "n", 1, 1), (None, "n", 1, 1), ("S3", "n", None, 1), ("S3", "n", None, 1), ("S4", "same", 4, 1), ("S4", "same", 4, 1), ("S4", "same", 4, 1)])
    judged = judge(df, CONTRACTS["gold_indice_journalier"])
    got = sorted((str(r.code_site)[:3], str(r.nom_site)[:2], str(r.jour), tuple(r[REASONS])) for r in judged.collect())
    dup = ("doublon:code_site,jour",)
    assert got == sorted([
        ("S1", "A", "2026-07-01", ()), ("S1", "B", "2026-07-01", dup), ("S1", "AA", "2026-07-01", ("trop_long:nom_site",)),  # a refused row shadows none
        ("S2", "x", "2026-07-01", ("hors_bornes:indice_atmo",)),
        ("SSS", "yy", "2026-07-02", ("trop_long:code_site", "trop_long:nom_site", "hors_bornes:indice_atmo")),
        ("Non", "n", "2026-07-01", ()), ("Non", "n", "2026-07-01", ()), ("S3", "n", "None", ()), ("S3", "n", "None", ()),  # a null is no duplicate
        ("S4", "sa", "2026-07-04", ()), ("S4", "sa", "2026-07-04", dup), ("S4", "sa", "2026-07-04", dup)])
    assert accepted(judged).columns == df.columns
    assert sorted(map(str, accepted(judged).union(quarantined(judged).drop(REASONS)).collect())) == sorted(map(str, df.collect()))
    assert judge(df.limit(0), CONTRACTS["gold_indice_journalier"]).count() == 0


def test_parents_missing_values_and_order(spark):
    contract = Contract("t", not_null=("a.b",), unique=(("k",),), references={"k": "p"}, order=("late",))
    df = spark.createDataFrame([(1, "x", 5), (1, "a", 9), (2, "x", 1), (None, "x", 1), (3, None, 1), (3, "x", 7)], "k long, `a.b` string, late int")
    parents = {"p": spark.createDataFrame([(1,), (1,), (3,), (None,)], "k long")}
    got = {(r.k, r["a.b"], r.late): tuple(r[REASONS]) for r in judge(df, contract, parents).collect()}
    assert got == {(1, "x", 5): (), (1, "a", 9): ("doublon:k",), (2, "x", 1): ("sans_parent:k",), (None, "x", 1): (), (3, None, 1): ("manquant:a.b",), (3, "x", 7): ()}


def test_a_hot_key_is_spread(spark):
    """90 % of the rows hold one key: one is accepted, and no window meets more than a share of them."""
    df = spark.range(0, 20_000, 1, 32).select(F.when(F.col("id") % 10 > 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    judged = judge(df, Contract("t", unique=(("k",),)))
    assert accepted(judged).where("k = -1").collect() == [(-1, 1)]
    assert quarantined(judged).count() == 17_999
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and plan.count("Range (") == 1  # one pass over the input


def test_snapshots_replace_without_a_gap(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(NoSnapshot):
        read_snapshot(spark, path)
    assert versions(spark, path) == [] and replace_snapshot(spark.range(3).toDF("x"), path) == 1
    old = read_snapshot(spark, path)
    assert replace_snapshot(old.union(old), path) == 2  # reads what it replaces
    assert (old.count(), read_snapshot(spark, path).count(), read_snapshot(spark, path, 1).count()) == (3, 6, 3)

    def half(rows, folder):
        rows.write.parquet(folder)
        raise OSError("lost the writer")

    def refuse():
        raise QuarantineExceeded("too many")

    for broken in ({"write": half}, {"check": refuse}):
        with pytest.raises((OSError, QuarantineExceeded)):
            replace_snapshot(spark.range(99).toDF("x"), path, **broken)
        assert versions(spark, path) == [1, 2] and read_snapshot(spark, path).count() == 6
    assert replace_snapshot(spark.range(1).toDF("x"), path) == 3
    gone = vacuum(spark, path, keep=2)
    assert len(gone) == 3 and versions(spark, path) == [2, 3]  # version 1 and what two failed writers left
    with pytest.raises(NoSnapshot):
        read_snapshot(spark, path, 1)
    assert read_snapshot(spark, path, 2).count() == 6 and read_snapshot(spark, path).count() == 1
    with pytest.raises(ValueError):
        vacuum(spark, path, keep=0)


def test_two_writers_of_one_version(spark, tmp_path):
    path = str(tmp_path / "table")
    replace_snapshot(spark.range(1).toDF("x"), path)

    def overtaken():
        replace_snapshot(spark.range(2).toDF("x"), path)

    with pytest.raises(CommitConflict):
        replace_snapshot(spark.range(7).toDF("x"), path, check=overtaken)
    assert versions(spark, path) == [1, 2] and read_snapshot(spark, path).count() == 2
    assert Files(spark, path).names("staged") == []


def test_documents_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "docs")
    write_documents(spark.createDataFrame([("1", "x"), ("2", "y")], "code_site string, nom string"), path)
    write_documents(spark.createDataFrame([("1", "z")], "code_site string, nom string"), path)
    assert [(r._id, r.nom) for r in read_documents(spark, path).collect()] == [("1", "z")]


def test_load_is_published_or_given_up(spark, tmp_path):
    root = str(tmp_path / "serving")
    good = index_rows(spark, [("S1", "A", 1, 3), ("S2", "A", 1, 3), ("S2", "B", 1, 4)])
    assert jobs.load_table(good, "gold_indice_journalier", root, most_refused=0.4) == {"version": 1, "lues": 3, "refusees": 1}
    bad = index_rows(spark, [("S9", "A" * 300, 1, 3), ("S8", "A", 1, 3)])
    with pytest.raises(QuarantineExceeded, match="1 of 2 rows"):
        jobs.load_table(bad, "gold_indice_journalier", root, most_refused=0.4)
    assert sorted(r.code_site for r in jobs.loaded_table(spark, "gold_indice_journalier", root).collect()) == ["S1", "S2"]
    refused = jobs.loaded_table(spark, "gold_indice_journalier", root, refused=True).collect()
    assert [(r.code_site, r.nom_site, r[REASONS]) for r in refused] == [("S2", "B", ["doublon:code_site,jour"])]
    plan = jobs.loaded_table(spark, "gold_indice_journalier", root)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan  # the other part isn't read


def test_every_job_from_the_command_line(spark, tmp_path, capsys):
    root = tmp_path / "lake"
    messages = tmp_path / "messages"
    messages.mkdir()
    rows = [record("2026-07-01", value="250"), record("2026-07-01", site="S2"), dict(record("2026-07-01", site="S2"), nom_site="Renamed", date_debut="2026/07/01 12:00:00")]
    (messages / "a.txt").write_text("\n".join([*map(json.dumps, rows), "{broken"]) + "\n")
    spark.createDataFrame([("Sites", "Sites", "", 1.0, 2.0)], "commune string, label string, contexte string, longitude double, latitude double").write.parquet(str(tmp_path / "gazetteer"))
    base = ["--root", str(root)]
    jobs.main(["stream-to-bronze", *base, "--messages", str(messages), "--checkpoint", str(tmp_path / "progress")])
    assert [r.value for r in spark.read.text(str(root / "rejects")).collect()] == ["{broken"]
    jobs.main(["bronze-to-silver", *base])
    jobs.main(["silver-to-gold", *base])
    jobs.main(["station-reference", *base, "--gazetteer", str(tmp_path / "gazetteer"), "--approximate"])
    jobs.main(["station-reference", *base, "--gazetteer", str(tmp_path / "gazetteer")])  # goes on from the published table
    jobs.main(["gold-to-serving", *base, "--most-refused", "0.5"])
    assert "refusees" in capsys.readouterr().out
    assert versions(spark, str(root / "stations")) == [1, 2]
    assert "versions/000000000002" in snapshot_folder(spark, str(root / "stations"))
    served = jobs.loaded_table(spark, "gold_indice_journalier", str(root / "serving"))
    assert sorted(r.code_site for r in served.collect()) == ["S1", "S2"]
    assert jobs.loaded_table(spark, "gold_indice_journalier", str(root / "serving"), refused=True).count() == 1
    with pytest.raises(SystemExit):
        jobs.main(["station-reference", *base])


