"""Deduplication and run counts on the stream, across restarts."""

import json

import pytest

from aeris.plans import jobs
from aeris.streaming import stream_metrics, stream_to_bronze, stream_to_silver
from aeris.streaming.bronze_sink import read_message_files
from tests.test_jobs_streaming import record


def put(folder, name, records, more=()):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([*map(json.dumps, records), *more]) + "\n", encoding="utf-8")


def test_a_replay_across_a_restart_is_one_row(spark, tmp_path):
    source, out, progress = tmp_path / "m", str(tmp_path / "silver"), str(tmp_path / "progress")

    def run():
        query = stream_to_silver(read_message_files(spark, str(source)), out, progress)
        query.awaitTermination(180)
        return query

    first = record("2026-07-01", ingested="2026-07-02T00:00:00")
    put(source, "a.txt", [dict(first, validite="-1"), first, first, record("2026-07-01", site="S2", ingested="2026-07-02T00:00:01"), dict(first, date_debut=""), dict(first, _ingested_at="?")])
    run()
    assert spark.read.parquet(out).count() == 3
    put(source, "b.txt", [dict(first, valeur="99", _ingested_at="2026-07-02T05:00:00"), record("2026-07-02", ingested="2026-07-02T06:00:00"), dict(first, date_debut="")])
    query = run()  # a new query on the same progress: the keys it has seen are in its state
    rows = spark.read.parquet(out).collect()
    assert sorted((r.code_site, str(r.horodatage), r.valeur) for r in rows) == [
        ("S1", "2026-07-01 10:00:00", 10.0), ("S1", "2026-07-02 10:00:00", 10.0), ("S1", "None", 10.0), ("S2", "2026-07-01 10:00:00", 10.0)]
    assert any(op["operatorName"] == "dedupeWithinWatermark" for op in query.lastProgress["stateOperators"])
    put(source, "c.txt", [record("2020-01-01", ingested="2026-07-02T07:00:00")])  # measured long ago, ingested now: not late
    run()
    assert spark.read.parquet(out).count() == 5


def test_counts_of_a_drained_run(spark, tmp_path):
    source = tmp_path / "m"
    for i in range(3):
        put(source, f"{i}.txt", [record("2026-07-01", site=f"S{i}"), record("2026-07-02")], more=["{broken", "[1]"][: i])
    messages = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(source))
    query = stream_to_bronze(messages, str(tmp_path / "bronze"), str(tmp_path / "p"))
    query.awaitTermination(180)
    counts = stream_metrics(query)
    assert counts == {"lues": 9, "posees": 6, "rejetees": 3, "lots": 3}
    assert spark.read.json(str(tmp_path / "bronze")).count() == counts["posees"]
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with pytest.raises(RuntimeError, match="numRecentProgressUpdates"):
            stream_metrics(query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_the_job_counts_only_what_is_new(spark, tmp_path):
    source = tmp_path / "m"
    put(source, "a.txt", [record("2026-07-01")], more=["{broken"])
    run = lambda: jobs.stream_messages(spark, str(source), str(tmp_path / "b"), str(tmp_path / "r"), str(tmp_path / "p"))
    assert run() == {"lues": 2, "posees": 1, "rejetees": 1, "lots": 1}
    put(source, "b.txt", [record("2026-07-01", site="S2")])
    assert run() == {"lues": 1, "posees": 1, "rejetees": 0, "lots": 1}
    assert spark.read.text(str(tmp_path / "r")).count() == 1
