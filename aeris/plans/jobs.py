"""Batch jobs that materialise the medallion zones (each job ends in a written table,
which is also the lineage cut for the next job).

bronze_to_silver   Bronze JSON  -> Silver Parquet (partitioned by date_mesure)
silver_to_gold     Silver       -> three Gold marts
gold_to_serving    Gold + stations -> serving tables (JDBC or Parquet twin)
add_readings       late Bronze records -> the Silver and Gold of the days they fall on, nothing else read
load_serving       the same behind the declared constraints: accepted and quarantined rows, published as a whole or not at all
station_reference  Silver + gazetteer (+ previous station table) -> station table + documents
stream_to_bronze   messages (files) -> Bronze, drained once
"""

from __future__ import annotations

import argparse
import uuid
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aeris.operators import constraints, geocoding, gold, incremental, serving, silver, stations
from aeris.sources.csv_source import CORRUPT
from aeris.sources.lake import (
    bronze_records, drop_partitions, lake_path, partition_values, read_bronze_json, read_bronze_lines, read_mart, write_clustered,
    write_documents, write_partitioned,
)
from aeris.sources.scratch import staged
from aeris.session import apply_defaults
from aeris.sources.snapshots import Files, NoSnapshot, read_snapshot, replace_snapshot
from aeris.sources.tables import write_table
from aeris.streaming import read_message_files, stream_metrics, stream_rejects, stream_to_bronze


def _overwrite_mode(day: str | None, overwrite: str | None) -> bool:
    """Dynamic partition overwrite by default when one day is rebuilt (a static overwrite
    would erase every other day); static stays selectable."""
    if overwrite is None:
        return bool(day)
    return overwrite == "dynamic"


def bronze_to_silver(spark: SparkSession, bronze_path: str, silver_path: str, day: str | None = None,
                     overwrite: str | None = None) -> dict:
    """Clean one day (or everything) and write Silver; returns the run metrics (E15: records
    read, lines rejected, in scope, invalid, valid, duplicates removed, written, exceedance counts), all observed
    during the write job itself - no extra pass over Bronze."""
    lines = read_bronze_lines(spark, bronze_path, day)
    obs_read, obs_in, obs_out = Observation("bronze_read"), Observation("bronze_in"), Observation("silver_out")
    bronze = bronze_records(lines.observe(obs_read, F.count(CORRUPT).alias("rows_rejected"), (F.count(F.lit(1)) - F.count(CORRUPT)).alias("rows_read")))
    out = silver.clean_measurements(bronze, day=day, observe_input=obs_in)
    out = out.observe(obs_out, F.count(F.lit(1)).alias("rows_written"),
                      F.count_if(F.col("depassement") == "alerte").alias("alerte"),
                      F.count_if(F.col("depassement") == "info").alias("info"))
    write_partitioned(out, silver_path, "date_mesure", dynamic=_overwrite_mode(day, overwrite))
    metrics = {**obs_read.get, **obs_in.get, **obs_out.get}
    metrics["duplicates_removed"] = metrics["rows_valid"] - metrics["rows_written"]
    return metrics


def silver_to_gold(spark: SparkSession, silver_path: str, gold_path: str, day: str | None = None,
                   overwrite: str | None = None) -> dict:
    """Write the daily means, then derive the index from the written means mart (the
    aggregation is not recomputed), and the exceedance mart."""
    s = read_mart(spark, silver_path)
    if day:
        s = s.filter(F.col("date_mesure") == F.lit(day).cast("date"))
    dynamic = _overwrite_mode(day, overwrite)
    means_path, index_path, exc_path = (f"{gold_path}/moyennes_journalieres", f"{gold_path}/indice_journalier",
                                        f"{gold_path}/depassements")
    write_partitioned(gold.daily_means(s), means_path, dynamic=dynamic)
    means = read_mart(spark, means_path)
    if day:
        means = means.filter(F.col("date_mesure") == F.lit(day).cast("date"))
    write_partitioned(gold.daily_index(means), index_path, dynamic=dynamic)
    write_partitioned(gold.exceedance_mart(s), exc_path, dynamic=dynamic)
    return {"moyennes_journalieres": means_path, "indice_journalier": index_path, "depassements": exc_path}


def gold_to_serving(spark: SparkSession, gold_path: str, station_table: DataFrame, *, root: str | None = None,
                    jdbc_url: str | None = None) -> None:
    """Load the serving tables: index with station coordinates, means, exceedances."""
    idx = serving.serving_index(read_mart(spark, f"{gold_path}/indice_journalier"), station_table)
    write_table(idx, "gold_indice_journalier", root=root, jdbc_url=jdbc_url)
    write_table(serving.serving_means(read_mart(spark, f"{gold_path}/moyennes_journalieres")),
                "gold_moyennes_journalieres", root=root, jdbc_url=jdbc_url)
    write_table(serving.serving_exceedances(read_mart(spark, f"{gold_path}/depassements")),
                "gold_depassements", root=root, jdbc_url=jdbc_url)


def _on_days(rows: DataFrame, days: list) -> DataFrame:
    """Rows of the days (``None``: those without one), by the partition column."""
    known = [d for d in days if d is not None]
    condition = F.col("date_mesure").isin(known) if known else F.lit(False)
    return rows.where(condition | F.col("date_mesure").isNull() if None in days else condition)


def add_readings(bronze: DataFrame, silver_path: str, gold_path: str) -> dict:
    """Merge a batch of Bronze records into Silver and the Gold marts; the result equals a rebuild of all.

    Only the batch's days are read and written: their Silver rows (for the deduplication) and their states, from which means and index
    are derived. A day without a state, or one that an interrupted run was writing (its journal is still there), is computed
    from its Silver rows, so a failed run is mended by the next. One writer at a time. The days of a batch are listed on the driver."""
    spark = bronze.sparkSession
    paths = {name: f"{gold_path}/{name}" for name in ("etat_moyennes", "moyennes_journalieres", "indice_journalier", "depassements")}
    journal = Files(spark, f"{gold_path}/_journal")
    open_runs = journal.names("runs")
    interrupted = {date.fromisoformat(d) if d else None for run in open_runs for d in journal.read(f"runs/{run}").split(",")}

    batch = staged(incremental.arrived(bronze).withColumn("_processed_at", F.current_timestamp()), "batch")
    days = sorted({r["date_mesure"] for r in batch.select("date_mesure").distinct().collect()} | interrupted, key=str)
    if not days:
        return {"days": 0, "added": 0, "replaced": 0}
    have_silver = bool(Files(spark, silver_path).names(""))
    stored = _on_days(read_mart(spark, silver_path), days) if have_silver else batch.limit(0)
    merged = staged(incremental.merged_readings(stored, batch), "merged")
    counts = merged.groupBy("date_mesure").agg(
        F.count_if((F.col(incremental.ORIGIN) == incremental.ARRIVED) & F.col("remplacee").isNull()).alias("added"),
        F.count_if(F.col("remplacee").isNotNull()).alias("replaced"), F.count_if(F.col("depassement").isNotNull()).alias("exceedances")).collect()  # a row a day

    with_state = {date.fromisoformat(d) for d in partition_values(spark, paths["etat_moyennes"])} - interrupted
    known, fresh = [d for d in days if d in with_state], [d for d in days if d not in with_state]
    state = incremental.means_state(_on_days(merged, fresh)).select(*incremental.STATE_COLUMNS)
    if known:
        before = _on_days(read_mart(spark, paths["etat_moyennes"]), known)
        state = state.unionByName(incremental.updated_state(before, _on_days(merged, known)))
    state = staged(state, "state")

    run = f"runs/{uuid.uuid4().hex}"
    journal.write(run, ",".join(d.isoformat() if d else "" for d in days))
    silver_rows = merged.drop(incremental.ORIGIN, "remplacee")
    changed = [r["date_mesure"] for r in counts if r["replaced"]]
    write_partitioned(_on_days(silver_rows, changed), silver_path)  # days where a stored reading gave way
    new = merged.where(F.col(incremental.ORIGIN) == incremental.ARRIVED)
    write_partitioned(_on_days(new, [d for d in days if d not in changed]).drop(incremental.ORIGIN, "remplacee"), silver_path, mode="append")
    means = incremental.means_of_state(state)
    write_partitioned(state, paths["etat_moyennes"])
    write_partitioned(means, paths["moyennes_journalieres"])
    write_partitioned(gold.daily_index(means), paths["indice_journalier"])
    write_partitioned(gold.exceedance_mart(silver_rows), paths["depassements"])
    quiet = {r["date_mesure"].isoformat() for r in counts if r["date_mesure"] and not r["exceedances"]}
    drop_partitions(spark, paths["depassements"], sorted(quiet & set(partition_values(spark, paths["depassements"]))))
    for done in (*[f"runs/{r}" for r in open_runs], run):
        journal.fs.delete(journal.at(done), False)
    return {"days": len(days), "added": sum(r["added"] for r in counts), "replaced": sum(r["replaced"] for r in counts)}


PART = "_part"


def load_table(df: DataFrame, table: str, root: str, parents: dict[str, DataFrame] | None = None, most_refused: float = 1.0) -> dict:
    """Judge ``df`` by its contract and replace ``{root}/{table}`` by the result: accepted and quarantined rows are partitions
    of one new version, clustered by day and site. ``df`` is computed once, into a staged table that ranges are then sampled from. When
    more than the share ``most_refused`` is refused, :class:`QuarantineExceeded` is raised and readers keep the version
    they have. Returns the version and the counts observed while staging."""
    counts = Observation(f"load_{table}")
    judged = staged(constraints.observed(constraints.judge(df, constraints.CONTRACTS[table], parents), counts), table)
    constraints.check_share(counts.get, most_refused, table)
    part = F.when(F.size(constraints.REASONS) == 0, "acceptees").otherwise("refusees")
    version = replace_snapshot(judged.withColumn(PART, part), f"{root.rstrip('/')}/{table}",
                               write=lambda rows, folder: write_clustered(rows, folder, partition_cols=(PART,)))
    return {"version": version, **counts.get}


def loaded_table(spark: SparkSession, table: str, root: str, refused: bool = False) -> DataFrame:
    """The accepted rows of the latest version (or the quarantined ones, with their reasons); the other part isn't read."""
    rows = read_snapshot(spark, f"{root.rstrip('/')}/{table}").where(F.col(PART) == ("refusees" if refused else "acceptees"))
    return rows.drop(PART) if refused else rows.drop(PART, constraints.REASONS)


def load_serving(spark: SparkSession, gold_path: str, station_table: DataFrame, root: str, *, most_refused: float = 1.0,
                 jdbc_url: str | None = None) -> dict[str, dict]:
    """The three serving tables behind their constraints. With ``jdbc_url`` the database gets the accepted rows of each
    table once its new version stands, so it is never sent what it would refuse."""
    index = serving.serving_index(read_mart(spark, f"{gold_path}/indice_journalier"), station_table)
    tables = {
        "gold_indice_journalier": index,
        "gold_moyennes_journalieres": serving.serving_means(read_mart(spark, f"{gold_path}/moyennes_journalieres")),
        "gold_depassements": serving.serving_exceedances(read_mart(spark, f"{gold_path}/depassements")),
    }
    done = {}
    for name, rows in tables.items():
        done[name] = load_table(rows, name, root, most_refused=most_refused)
        if jdbc_url:
            write_table(loaded_table(spark, name, root), name, jdbc_url=jdbc_url)
    return done


def station_reference(spark: SparkSession, silver_path: str, gazetteer: DataFrame, out_path: str,
                      previous: DataFrame | None = None, documents_path: str | None = None,
                      approximate: bool = False) -> DataFrame:
    """Distinct stations -> commune -> gazetteer coordinates -> upsert into the previous station table (by
    default the version published before); published as the next version of ``out_path``, so readers see the old table until the new
    one stands. ``approximate``: misspelt communes get the gazetteer's best answer."""
    locate = geocoding.geocode_approximate if approximate else stations.geocode
    records = locate(stations.distinct_stations(read_mart(spark, silver_path)), gazetteer)
    rows = stations.to_station_rows(records)
    if previous is None:
        try:
            previous = read_snapshot(spark, out_path).drop("geom")
        except NoSnapshot:
            pass
    table = stations.upsert(previous, rows) if previous is not None else rows
    replace_snapshot(stations.with_geometry(table), out_path)
    if documents_path:
        write_documents(records, documents_path, key="code_site")
    return read_snapshot(spark, out_path)


def stream_messages(spark: SparkSession, source: str, bronze_path: str, rejects_path: str, checkpoint: str | None = None) -> dict:
    """Drain the message files under ``source`` into Bronze and what isn't a record into the rejects; a later run goes on
    where this one stopped. Returns this run's counts (E15 of the stream)."""
    stops = [f"{checkpoint}/{part}" if checkpoint else None for part in ("bronze", "rejects")]
    running = [stream_to_bronze(read_message_files(spark, source), bronze_path, stops[0]),
               stream_rejects(read_message_files(spark, source), rejects_path, stops[1])]
    for query in running:
        query.awaitTermination()
    return stream_metrics(running[0])


def main(argv: list[str] | None = None) -> None:
    """``python -m aeris.plans.jobs JOB --root LAKE``: ``bronze-to-silver`` and ``silver-to-gold`` take ``--date YYYY-MM-DD`` and
    ``--overwrite static``, ``add-readings`` takes ``--batch FOLDER``, ``station-reference`` takes ``--gazetteer PARQUET`` and ``--approximate``, ``gold-to-serving`` takes ``--most-refused SHARE`` and
    ``--jdbc-url``, ``stream-to-bronze`` takes ``--messages FOLDER`` and ``--checkpoint``."""
    parser = argparse.ArgumentParser(description="Medallion jobs over the zones under one root")
    parser.add_argument("job", choices=["bronze-to-silver", "silver-to-gold", "add-readings", "station-reference", "gold-to-serving", "stream-to-bronze"])
    parser.add_argument("--root", required=True)
    parser.add_argument("--date", help="rebuild one day only (YYYY-MM-DD)")
    parser.add_argument("--overwrite", choices=["dynamic", "static"])
    parser.add_argument("--gazetteer", help="Parquet folder: commune, label, contexte, longitude, latitude")
    parser.add_argument("--approximate", action="store_true", help="answer misspelt communes too")
    parser.add_argument("--most-refused", type=float, default=1.0, help="share of refused rows at which a load is given up")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--batch", help="folder of late Bronze records")
    parser.add_argument("--messages", help="folder of message files")
    parser.add_argument("--checkpoint", help="folder of the stream's progress (default: under spark.checkpoint.dir)")
    args = parser.parse_args(argv)
    needed = {"station-reference": "gazetteer", "stream-to-bronze": "messages", "add-readings": "batch"}.get(args.job)
    if needed and not getattr(args, needed):
        parser.error(f"{args.job} needs --{needed}")
    spark = apply_defaults(SparkSession.builder.appName(args.job).getOrCreate())
    zone = lambda name: lake_path(name, root=args.root)
    if args.job == "bronze-to-silver":
        print(bronze_to_silver(spark, zone("bronze"), zone("silver"), args.date, args.overwrite))
    elif args.job == "silver-to-gold":
        print(silver_to_gold(spark, zone("silver"), zone("gold"), args.date, args.overwrite))
    elif args.job == "add-readings":
        print(add_readings(read_bronze_json(spark, args.batch), zone("silver"), zone("gold")))
    elif args.job == "station-reference":
        table = station_reference(spark, zone("silver"), read_mart(spark, args.gazetteer), zone("stations"), documents_path=zone("documents"),
                                  approximate=args.approximate)
        print({"stations": table.count(), "located": table.where("latitude is not null and longitude is not null").count()})
    elif args.job == "gold-to-serving":
        print(load_serving(spark, zone("gold"), read_snapshot(spark, zone("stations")), zone("serving"), most_refused=args.most_refused, jdbc_url=args.jdbc_url))
    else:
        print(stream_messages(spark, args.messages, zone("bronze"), zone("rejects"), args.checkpoint))


if __name__ == "__main__":
    main()
