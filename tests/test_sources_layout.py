"""Lineage and rejects of the batch readers; the serving layout."""

import json

from pyspark.sql import functions as F

from aeris.plans import jobs
from aeris.schemas import SOURCE_COLUMNS
from aeris.sources import (
    bad_lines, bronze_rejects, good_lines, lines_by_file, read_bronze_json, read_bronze_lines, read_csv_with_lineage, source_to_bronze, write_clustered,
)
from tests.test_incremental import files_read
from tests.test_jobs_streaming import record


def csv_line(**values):
    return ";".join(f'"{values.get(c, "x")}"' for c in SOURCE_COLUMNS)


def test_csv_rejects_have_their_file(spark, tmp_path):
    header = ";".join(f'"{c}"' for c in SOURCE_COLUMNS)
    good = csv_line(**{"Polluant": "NO2", "code site": "S1"})
    (tmp_path / "a.csv").write_text("\ufeff" + "\n".join([header, good, "too;short", good + ";more", good]) + "\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("\n".join([header, good, "garbage"]) + "\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text(header + "\n", encoding="utf-8")
    rows = read_csv_with_lineage(spark, [str(tmp_path / f"{n}.csv") for n in "abc"])
    rejects = sorted((r._fichier.rsplit("/", 1)[1], r.ligne) for r in bad_lines(rows).collect())
    assert rejects == [("a.csv", good + ";more"), ("a.csv", "too;short"), ("b.csv", "garbage")]
    assert {r._fichier.rsplit("/", 1)[1]: (r.lues, r.rejetees) for r in lines_by_file(rows).collect()} == {"a.csv": (4, 2), "b.csv": (2, 1)}
    assert good_lines(rows).count() == 3 and good_lines(rows).select("_modifie").first()[0] is not None
    assert source_to_bronze(good_lines(rows)).count() == 3


def test_bronze_rejects_are_counted_and_keep_their_file(spark, tmp_path):
    day = tmp_path / "bronze" / "date=2026-07-01"
    day.mkdir(parents=True)
    (day / "a.jsonl").write_text("\n".join([json.dumps(record("2026-07-01")), "{broken", "17"]) + "\n")
    (day / "b.jsonl").write_text("[]]\n" + json.dumps(record("2026-07-01", site="S2")) + "\n")
    bronze = str(tmp_path / "bronze")
    rejects = sorted((r._fichier.rsplit("/", 1)[1], r.ligne) for r in bronze_rejects(read_bronze_lines(spark, bronze)).collect())
    assert rejects == [("a.jsonl", "17"), ("a.jsonl", "{broken"), ("b.jsonl", "[]]")]
    assert read_bronze_json(spark, bronze).count() == 2
    metrics = jobs.bronze_to_silver(spark, bronze, str(tmp_path / "silver"))
    assert (metrics["rows_read"], metrics["rows_rejected"], metrics["rows_written"]) == (2, 3, 2)


def rows_scanned(df):
    df.collect()
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        if node.nodeName().startswith("Scan parquet"):
            return int(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]


def test_one_site_or_day_skips_row_groups(spark, tmp_path):
    """Sites come in no order within a day, so only filters of their values can tell that a row group has none."""
    n = 60_000
    df = spark.range(0, n, 1, 4).select(
        F.expr("date_add(DATE'2026-01-01', cast(id % 30 as int))").alias("jour"),
        F.concat(F.lit("S"), F.lpad(((F.col("id") * 7919) % 30_000).cast("string"), 18, "0")).alias("code_site"), F.rand(1).alias("valeur"))
    path = str(tmp_path / "serving")
    write_clustered(df, path, row_group_bytes=64 << 10)
    served = spark.read.parquet(path)
    assert served.count() == n
    site = df.select("code_site").where("code_site like '%123'").first()[0]
    one_site, one_day = served.where(F.col("code_site") == site), served.where("jour = DATE'2026-01-07'")
    assert one_site.count() == df.where(F.col("code_site") == site).count() and one_day.count() == n // 30
    assert rows_scanned(one_day) < n / 10
    assert rows_scanned(one_site) < n / 2
    assert files_read(served)
