"""Runs that append to a warehouse: written aside, seen as a whole once published.

A run writes every table it adds to into a folder of its own, ``_runs/run=<n>/<table>``. None of it is
seen before the run's marker ``_processed/run=<n>`` is complete: the marker is the commit. After it, the
files are moved into the tables' folders (``settle``), which may be broken off anywhere and is finished
by the next run. So a run killed at any write is simply made again: before the marker its folder is
overwritten and nothing of it is left; after the marker only the rest of the moves is made.

Rows are counted and checked while they are written (``observe``): a run whose rows break a declared
constraint is not published.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RUNS, MARKERS, SETTLED = "_runs", "_processed", "_SETTLED"
#: Tables that stay in their run's folder: only the latest published run's is read.
KEPT_ASIDE = ("pending",)
CREATED_AT = "created_at"

MARKER_SCHEMA = "load_id string, top_key long"


class ConstraintViolation(ValueError):
    """A run whose rows break declared constraints; ``counts`` has the violations by name."""

    def __init__(self, table: str, counts: dict[str, int]):
        super().__init__(f"{table}: not published, " + ", ".join(f"{n} {name}" for name, n in sorted(counts.items())))
        self.table, self.counts = table, counts


# ---- file-system helpers (Hadoop FileSystem through the session) -----------------

def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p) if s.isDirectory())


# ---- runs ---------------------------------------------------------------------------

def published_runs(spark: SparkSession, root: str) -> list[int]:
    folder = f"{root}/{MARKERS}"
    runs = [int(d.split("=", 1)[1]) for d in list_dirs(spark, folder) if d.startswith("run=")]
    return sorted(r for r in runs if path_exists(spark, f"{folder}/run={r}/_SUCCESS"))


def markers(spark: SparkSession, root: str) -> DataFrame:
    """(load_id, top_key, run) of every published run: one row per load it took."""
    runs = published_runs(spark, root)
    if not runs:
        return spark.createDataFrame([], f"{MARKER_SCHEMA}, run int")
    folder = f"{root}/{MARKERS}"
    return (spark.read.schema(f"{MARKER_SCHEMA}, run int").option("basePath", folder)
            .parquet(*[f"{folder}/run={r}" for r in runs]))


class Run(NamedTuple):
    """One append to the warehouse under ``root``."""
    spark: SparkSession
    root: str
    number: int

    @property
    def folder(self) -> str:
        return f"{self.root}/{RUNS}/run={self.number}"

    def clear(self) -> None:
        """Drop what an unpublished attempt at this run left."""
        fs, path = hadoop_fs(self.spark, self.folder)
        fs.delete(path, True)

    def stage(self, table: str, rows: DataFrame, partition_by: Sequence[str] = (), checks: dict[str, Column] | None = None,
              facts: dict[str, Column] | None = None, columns: Sequence[str] | None = None) -> tuple[DataFrame, dict]:
        """Write the run's rows of a table aside; (the rows as written, the observed ``facts``).

        ``columns`` are what is written, if ``checks`` look at more.

        ``checks`` are conditions no row may meet; they are counted in the write itself, and a
        violation raises ``ConstraintViolation``, so the run can't be published."""
        counted = {n: F.count_if(F.coalesce(c, F.lit(False))) for n, c in (checks or {}).items()} | (facts or {})
        observed = Observation()
        watched = rows.observe(observed, *[c.alias(n) for n, c in counted.items()]) if counted else rows
        watched = watched if columns is None else watched.select(*columns)
        path = f"{self.folder}/{table}"
        (watched.withColumn(CREATED_AT, F.current_timestamp()).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path))
        seen = observed.get if counted else {}
        broken = {n: seen[n] for n in (checks or {}) if seen[n]}
        if broken:
            raise ConstraintViolation(table, broken)
        return self.staged(table, watched.schema), {n: seen[n] for n in (facts or {})}

    def staged(self, table: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{table}")

    def publish(self, load_ids: Sequence[str | None], top_key: int) -> None:
        """The commit: from here on the run's rows belong to the warehouse."""
        rows = [(i, int(top_key)) for i in load_ids]
        (self.spark.createDataFrame(rows, MARKER_SCHEMA).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.root}/{MARKERS}/run={self.number}"))


def settle(spark: SparkSession, root: str, on_step: Callable[[str], None] = lambda step: None) -> None:
    """Move the files of published runs into their tables; finishes what an earlier attempt left.

    Runs are settled before the next one starts, so the newest settled run ends the search."""
    open_runs = []
    for run in reversed(published_runs(spark, root)):
        folder = f"{root}/{RUNS}/run={run}"
        if not path_exists(spark, folder) or path_exists(spark, f"{folder}/{SETTLED}"):
            break
        open_runs.append(folder)
    for folder in reversed(open_runs):
        fs, base = hadoop_fs(spark, folder)
        for table in list_dirs(spark, folder):
            if table not in KEPT_ASIDE:
                # "<table>-<part>": several parts of one table
                _move_files(spark, f"{folder}/{table}", f"{root}/{table.split('-')[0]}", on_step)
        fs.create(hadoop_fs(spark, f"{folder}/{SETTLED}")[1]).close()


def _move_files(spark: SparkSession, source: str, target: str, on_step: Callable[[str], None]) -> None:
    """Data files keep their (unique) names and partition folders; each is moved by one rename."""
    fs, folder = hadoop_fs(spark, source)
    fs.mkdirs(hadoop_fs(spark, target)[1])
    files = fs.listFiles(folder, True)
    prefix = len(str(fs.makeQualified(folder).toUri().getPath()).rstrip("/")) + 1
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = []
    while files.hasNext():
        found.append(files.next().getPath())
    for file in found:
        inside = str(file.toUri().getPath())[prefix:]
        if any(part[0] in "_." for part in inside.split("/")):
            continue   # the writer's own markers
        moved = path(f"{target}/{inside}")
        fs.mkdirs(moved.getParent())
        if not fs.rename(file, moved):
            raise OSError(f"could not move {file} to {moved}")
        on_step("move")


def read_or_none(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """A table by its declared schema, so a folder without data files is an empty table; None if there is no folder."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None
