"""Write-side load patterns: full refresh, incremental load, month partitions.

Full refresh
    Each load writes a new version directory (``<table>/load=<id>``); readers
    take the newest version that finished (has ``_SUCCESS``). A failed load
    leaves the previous version readable: the all-or-nothing behaviour of a
    truncate + insert in one transaction, without deleting before writing.

Incremental load
    Each landed batch is a folder ``load=<id>`` per staging table, complete once
    its marker under ``_loads`` exists. A run takes the *set* of complete loads
    it has not processed (no timestamps, so arrival order is free), appends new
    dimension rows, resolves the loads' events together with those still
    pending, and appends the ones whose event id was never loaded (asked of an
    index of ids in hash buckets, ``operators/id_index.py``). Valid events
    without a user or song stay pending until the dimension row arrives; only
    those that both are known for are resolved again. A run writes its rows aside
    and is seen as a whole once its marker exists (``publish.py``), so one that
    was killed at any write is simply run again, with the same result and keys.

Month partitions
    The fact written partitioned by ``year_month`` with dynamic partition
    overwrite: rewriting a month replaces that month's files only.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import id_index
from ..operators.fact import append_events
from ..operators.joins import lookup_join
from ..sources.staging import Staging
from .publish import Run, list_dirs, markers, path_exists, published_runs, read_or_none, settle
from .publish import hadoop_fs as _fs
from .warehouse import DIMENSIONS, FACT, Star, build_dims_delta, read_star


# ---- A6 full refresh ----------------------------------------------------------------

def full_refresh(df: DataFrame, table_root: str, load_id: str | None = None) -> str:
    """Write ``df`` as a new version of the table; returns the version path."""
    load_id = load_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]
    path = f"{table_root.rstrip('/')}/load={load_id}"
    df.write.mode("errorifexists").parquet(path)
    return path


def current_version(spark: SparkSession, table_root: str) -> str | None:
    """Newest completed version of a fully refreshed table."""
    root = table_root.rstrip("/")
    for name in reversed(list_dirs(spark, root)):
        if name.startswith("load=") and path_exists(spark, f"{root}/{name}/_SUCCESS"):
            return f"{root}/{name}"
    return None


def read_current(spark: SparkSession, table_root: str) -> DataFrame:
    path = current_version(spark, table_root)
    if path is None:
        raise FileNotFoundError(f"no completed load under {table_root}")
    return spark.read.parquet(path)


# ---- stream-key high water -------------------------------------------------------------

HIGH_WATER = "_key_high_water"


def key_high_water(spark: SparkSession, root: str, existing: DataFrame | None) -> int:
    """Largest stream key used or reserved so far: one row per published run and reservation.

    Only the first run over a fact that no run has written reads the fact's keys.
    """
    from ..operators.keys import max_key

    root = root.rstrip("/")
    top = markers(spark, root).agg(F.max("top_key")).collect()[0][0]
    if top is None:
        top = max_key(existing, "stream_key")
    if path_exists(spark, f"{root}/{HIGH_WATER}"):
        top = max(top, spark.read.parquet(f"{root}/{HIGH_WATER}").agg(F.max("max_key")).collect()[0][0] or 0)
    return int(top)


def reserve_keys(spark: SparkSession, root: str, load_id: int, top: int) -> None:
    """Set keys up to ``top`` aside for a writer outside the runs: later runs start above them."""
    (spark.createDataFrame([(int(load_id), int(top))], "load_id long, max_key long")
     .write.mode("append").parquet(f"{root.rstrip('/')}/{HIGH_WATER}"))


# ---- R1 incremental load --------------------------------------------------------------

STAGING_TABLES = ("stg_artists", "stg_songs", "stg_users", "stg_stream_events")


def land(staging: Staging, staging_root: str, loaded_at: dt.datetime | None = None,
         load_id: str | None = None) -> str:
    """Write one batch of staging rows, stamped with ``loaded_at``, as a load of its own; its id.

    The load counts from the moment its marker is written, after all tables."""
    spark = staging.events.sparkSession
    root = staging_root.rstrip("/")
    load_id = load_id or uuid.uuid4().hex
    stamp = F.lit(loaded_at or dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    for name in STAGING_TABLES:
        (staging.table(name).withColumn("loaded_at", stamp)
         .write.mode("overwrite").parquet(f"{root}/{name}/load={load_id}"))
    spark.createDataFrame([(load_id,)], "load_id string").write.mode("overwrite").parquet(f"{root}/_loads/{load_id}")
    return load_id


def complete_loads(spark: SparkSession, staging_root: str) -> set[str]:
    root = f"{staging_root.rstrip('/')}/_loads"
    return {d for d in list_dirs(spark, root) if path_exists(spark, f"{root}/{d}/_SUCCESS")}


def processed_runs(spark: SparkSession, warehouse_root: str) -> tuple[int, set[str]]:
    """The next run's number, and the loads that published runs took."""
    rows = markers(spark, warehouse_root.rstrip("/")).collect()   # one row per load
    return max((r["run"] + 1 for r in rows), default=0), {r["load_id"] for r in rows}


def existing_star(spark: SparkSession, root: str) -> Star:
    """Tables written so far, by their declared schemas; None for those without a folder."""
    return Star(*[read_or_none(spark, f"{root}/{n}", schemas.STAR[n]) for n in (*DIMENSIONS, FACT)])


def fact_writer(run: Run):
    """``write(rows)`` that stages new fact rows and their ids; ``top()`` is the largest key it wrote."""
    seen = {"top": None}
    missing = {f"null_{c}": F.col(c).isNull() for c in schemas.FACT_REQUIRED}

    def write(rows: DataFrame) -> DataFrame:
        new, facts = run.stage(FACT, rows, ["date_key"], checks=missing, facts={"top": F.max("stream_key")})
        seen["top"] = facts["top"]
        run.stage(id_index.TABLE, id_index.index_rows(new, "event_id"), [id_index.BUCKET])
        return new

    return write, lambda: seen["top"]


def loaded_ids(spark: SparkSession, root: str, events: DataFrame, fact: DataFrame | None, run: Run):
    """``known(ids)`` for a batch of ``events``: from the id index, reading the buckets of the batch only.

    A fact without an index (built in full) is indexed by this run first."""
    index = f"{root}/{id_index.TABLE}"
    if not path_exists(spark, index):
        if fact is None:
            return None
        # its ids become part of the index when the run is published
        base, _ = run.stage(f"{id_index.TABLE}-base", id_index.index_rows(fact, "event_id"), [id_index.BUCKET])
        return lambda ids: lookup_join(base.select("event_id"), ids.select("event_id").distinct(), "event_id", "left_semi", split_hot=False)
    buckets = id_index.touched_buckets(events, "event_id")
    return lambda ids: id_index.known_ids(spark, index, ids, "event_id", buckets)


def incremental_load(spark: SparkSession, staging_root: str, warehouse_root: str,
                     on_step: Callable[[str], None] = lambda step: None) -> Star:
    """Process the landed loads that no run has taken yet; append to the warehouse.

    ``on_step`` is called after each write with its name, for tests and progress."""
    root, stage = warehouse_root.rstrip("/"), staging_root.rstrip("/")
    settle(spark, root, on_step)
    number, taken = processed_runs(spark, root)
    loads = sorted(complete_loads(spark, stage) - taken)
    if not loads:
        return read_star(spark, root)
    run = Run(spark, root, number)
    run.clear()
    batch = Staging(*[spark.read.schema(schemas.STAGING[n]).parquet(*[f"{stage}/{n}/load={i}" for i in loads])
                      for n in STAGING_TABLES])
    old = existing_star(spark, root)
    if old.dim_date is not None and old.dim_date.isEmpty():
        old = old._replace(dim_date=None)
    delta = build_dims_delta(spark, batch, old)
    if old.dim_date is None:
        dates, _ = run.stage("dim_date", delta.dim_date)
    else:
        dates = old.dim_date
    on_step("dim_date")
    # New dimension rows: written once, so the same rows are appended and used below.
    now = {}
    for name in ("dim_artists", "dim_users", "dim_songs"):
        new, _ = run.stage(name, delta.table(name))
        now[name] = new if old.table(name) is None else old.table(name).unionByName(new)
        on_step(name)

    events = batch.events
    waiting = latest_pending(spark, root, number)
    if waiting is not None:
        known = lookup_join(waiting, now["dim_users"].select("user_id"), "user_id", "left_semi")
        retry = lookup_join(known, now["dim_songs"].select("song_id"), "song_id", "left_semi")
        still = (lookup_join(waiting, now["dim_users"].select("user_id"), "user_id", "left_anti")
                 .unionByName(lookup_join(known, now["dim_songs"].select("song_id"), "song_id", "left_anti")))
        events = events.unionByName(retry)
    start = key_high_water(spark, root, old.fact_streams)
    write, top = fact_writer(run)
    unresolved = append_events(events, now["dim_users"], now["dim_songs"], dates, old.fact_streams, start, write,
                               loaded_ids(spark, root, events, old.fact_streams, run))
    on_step("fact")
    if waiting is not None:
        unresolved = unresolved.unionByName(still).distinct()
    run.stage("pending", unresolved)
    on_step("pending")
    run.publish(loads, top() or start)
    on_step("marker")
    settle(spark, root, on_step)
    return read_star(spark, root)


FACT_PARENTS = {"user_key": "dim_users", "song_key": "dim_songs", "artist_key": "dim_artists", "date_key": "dim_date"}


def append_fact(spark: SparkSession, warehouse_root: str, rows: DataFrame) -> int:
    """Append fact rows that were keyed elsewhere; the number of rows.

    Foreign keys, required columns and unique new keys are checked in the write pass (each parent is looked
    up by a size-checked join). With any violation the load raises ``ConstraintViolation`` and is not published.
    """
    root = warehouse_root.rstrip("/")
    settle(spark, root)
    number, _ = processed_runs(spark, root)
    run = Run(spark, root, number)
    run.clear()
    star = existing_star(spark, root)
    checks = {f"null_{c}": F.col(c).isNull() for c in schemas.FACT_REQUIRED}
    start, flagged = key_high_water(spark, root, star.fact_streams), rows
    for column, parent in FACT_PARENTS.items():
        known = f"_known_{column}"
        parents = star.table(parent).select(column).where(F.col(column).isNotNull()).withColumn(known, F.lit(True))
        flagged = lookup_join(flagged, parents, column, "left", hot_from=rows)
        checks[f"orphan_{column}"] = F.col(column).isNotNull() & F.col(known).isNull()
    # Keys at or below the high water are taken, whatever row holds them.
    checks["taken_stream_key"] = F.coalesce(F.col("stream_key") <= start, F.lit(True))
    new, facts = run.stage(FACT, flagged, ["date_key"], checks, {"rows": F.count(F.lit(1)), "top": F.max("stream_key")}, schemas.FACT_COLUMNS)
    run.stage(id_index.TABLE, id_index.index_rows(new, "event_id"), [id_index.BUCKET])
    run.publish([None], facts["top"] or start)
    settle(spark, root)
    return facts["rows"]


def latest_pending(spark: SparkSession, root: str, before: int) -> DataFrame | None:
    """The events that the latest published run before ``before`` left waiting for a user or song."""
    for run in reversed(published_runs(spark, root)):
        if run < before:
            return read_or_none(spark, f"{Run(spark, root, run).folder}/pending", schemas.STG_EVENTS)
    return None


# ---- R2 month-partitioned fact ---------------------------------------------------------

def with_year_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn("year_month", F.call_function("div", F.col("date_key"), F.lit(100)).cast("int"))


def write_fact_by_month(fact: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write partitioned by ``year_month``; overwrite replaces only the months present."""
    (with_year_month(fact).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("year_month").parquet(path))
    return path
