"""Tables replaced without a gap for readers: versioned snapshot folders and a commit published last.

``<path>/versions/<number>-<id>/`` holds one whole version, ``<path>/commits/<number>`` is a small file that names it. A writer fills a folder that
nobody reads, then publishes it by renaming a finished file to the commit of the next number. Readers take the largest commit, so
they see the old version until then and the new one after; a writer that fails leaves only a folder that no commit names. A
rename never replaces a commit: of two writers that race for a number one is refused. All file operations go through Hadoop's file
systems, so a path may be anywhere Spark can read. Folders of older versions stay for running readers until :func:`vacuum`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

KEPT = 3


class CommitConflict(RuntimeError):
    """Another writer published this version first."""


class NoSnapshot(FileNotFoundError):
    """Nothing has been published under the path."""


class Files:
    """File operations under one folder, on whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm  # noqa: SLF001  (Spark's Python API has no file operations)
        self.path = path.rstrip("/")
        self.hadoop = jvm.org.apache.hadoop.fs
        self.none = spark.sparkContext._gateway.new_array(self.hadoop.Options.Rename, 0)  # noqa: SLF001
        self.create = jvm.java.util.EnumSet.of(self.hadoop.CreateFlag.CREATE)
        self.options = spark.sparkContext._gateway.new_array(self.hadoop.Options.CreateOpts, 0)  # noqa: SLF001
        conf = spark._jsc.hadoopConfiguration()  # noqa: SLF001
        root = self.at("")
        self.fs = root.getFileSystem(conf)
        self.context = self.hadoop.FileContext.getFileContext(self.fs.makeQualified(root).toUri(), conf)

    def at(self, name: str):
        return self.hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        place = self.at(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(place)) if self.fs.exists(place) else []

    def write(self, name: str, text: str) -> None:
        self.fs.mkdirs(self.at(name).getParent())
        out = self.fs.create(self.at(name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """The file ``name`` holds ``text`` as a whole or doesn't exist; an existing one is never replaced."""
        staged = f"staged/{uuid.uuid4().hex}"
        self.write(staged, text)
        self.fs.mkdirs(self.at(name).getParent())
        try:
            self.context.rename(self.at(staged), self.at(name), self.none)
        except Py4JJavaError as error:
            self.fs.delete(self.at(staged), False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise CommitConflict(f"{self.path}: {name} was published by another writer") from error
            raise


def _numbers(files: Files) -> list[int]:
    return sorted(int(n) for n in files.names("commits") if n.isdigit())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    return _numbers(Files(spark, path))


def replace_snapshot(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] | None = None,
                     check: Callable[[], None] | None = None) -> int:
    """Write ``df`` as the next version and publish it; returns its number (from 1).

    ``write(df, folder)`` fills the folder (default: Parquet). ``check`` runs after the write and before the publication: if it
    raises, readers keep the old version. ``df`` may read the table that is replaced."""
    spark = df.sparkSession
    files = Files(spark, path)
    number = max(_numbers(files), default=0) + 1
    folder = f"{number:012d}-{uuid.uuid4().hex}"
    target = f"{files.path}/versions/{folder}"
    if write:
        write(df, target)
    else:
        df.write.parquet(target)
    if check:
        check()
    files.publish(f"commits/{number:012d}", folder)
    return number


def snapshot_folder(spark: SparkSession, path: str, version: int | None = None) -> str:
    """The folder of a version, the latest by default."""
    files = Files(spark, path)
    numbers = _numbers(files)
    if not numbers or (version is not None and version not in numbers):
        raise NoSnapshot(f"{path}: no version" + (f" {version}" if version is not None else ""))
    return f"{files.path}/versions/{files.read(f'commits/{version or numbers[-1]:012d}')}"


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The latest published version (or an older one that is kept). The frame stays on the files it found."""
    return spark.read.parquet(snapshot_folder(spark, path, version))


def vacuum(spark: SparkSession, path: str, keep: int = KEPT) -> list[str]:
    """Delete all but the ``keep`` latest versions, and folders of their numbers that no commit names (writers that failed or were
    overtaken); returns what went. Folders of numbers above the latest commit may belong to a running writer and stay."""
    if keep < 1:
        raise ValueError("the latest version can't be deleted")
    files = Files(spark, path)
    numbers = _numbers(files)
    kept = {files.read(f"commits/{n:012d}") for n in numbers[-keep:]}
    for n in numbers[:-keep]:
        files.fs.delete(files.at(f"commits/{n:012d}"), False)
    gone = [f for f in files.names("versions") if f not in kept and numbers and int(f.split("-")[0]) <= numbers[-1]]
    for folder in gone:
        files.fs.delete(files.at(f"versions/{folder}"), True)
    return gone
