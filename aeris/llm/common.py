"""Helpers shared by the operators: tables, the shared scratch folder, text expressions."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.session import checkpoint_dir

PACKAGE = Path(__file__).resolve().parent.parent

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """Ship this package to the Python workers, once for a Spark application.

    Tasks import it by name; without this every executor would need it on its PYTHONPATH."""
    sc = spark.sparkContext
    name = f"{PACKAGE.name}-{sc.applicationId}.zip"
    if name not in sc._python_includes:  # noqa: SLF001  (no public list of shipped files names Python's)
        path = Path(tempfile.mkdtemp(prefix=f"{PACKAGE.name}-")) / name  # on the driver; Spark serves it from there
        with zipfile.ZipFile(path, "w") as z:
            for file in sorted(PACKAGE.rglob("*.py")):
                z.write(file, file.relative_to(PACKAGE.parent))
        sc.addPyFile(str(path))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/aeris-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once as Parquet to the shared folder and read it back.
    The files survive lost executors; removing old folders is the caller's housekeeping."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(columns: list[str]) -> list[Column]:
    """Columns by name, whatever characters it has."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def unused(columns: list[str], *names: str) -> tuple[str, ...]:
    """``names``, lengthened where ``columns`` has one (in whatever case), so that no column of the caller's is replaced."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def with_computed(docs: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], names: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """``docs`` with columns ``names`` (of types ``kinds``) that ``task`` appends to its Arrow batches. Columns may have any name; the task
    sees ``text`` under its name, the others by place."""
    plain = docs.toDF(*["text" if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)])
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields]
    added = [f"_{len(docs.columns) + i} {kind}" for i, kind in enumerate(kinds)]
    return plain.mapInArrow(task, ", ".join([*fields, *added])).toDF(*docs.columns, *names)


def spread(rows: DataFrame, *columns: str) -> DataFrame:
    """Few narrow rows, each of which makes many, dealt over ``spark.sql.shuffle.partitions`` tasks (adaptive execution
    would put them together by their bytes)."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def lower_az(text: Column) -> Column:
    """A-Z lower-cased, every other character left alone (``lower`` is not: it maps all letters)."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def n_words(text: Column) -> Column:
    """Number of words of a text (0 for null), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5: the fold that fixes training and held-out rows (a null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5
