"""Staging -> star schema, and its storage layout.

Layout under one root (a shared folder):

    stg_artists/ stg_songs/ stg_users/ stg_stream_events/   staging (Parquet)
    dim_date/ dim_artists/ dim_users/ dim_songs/            dimensions (Parquet)
    fact_streams/date_key=YYYYMMDD/                         fact, partitioned by day

The fact is partitioned by ``date_key`` so the report's date windows prune
partitions at planning time (static filter) or at run time (dynamic
partition pruning through the calendar join).
"""

from __future__ import annotations

import threading
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.dates import dim_date as make_dim_date
from ..operators.dimensions import build_dim_artists, build_dim_songs, build_dim_users
from ..operators.fact import build_fact_streams
from ..session import configure, scratch_path
from .parallel import run_all
from .publish import CREATED_AT, path_exists, read_or_none
from ..sources.staging import Staging

DIMENSIONS = ("dim_date", "dim_artists", "dim_users", "dim_songs")
FACT = "fact_streams"


class Star(NamedTuple):
    dim_date: DataFrame
    dim_artists: DataFrame
    dim_users: DataFrame
    dim_songs: DataFrame
    fact_streams: DataFrame

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


def build_dims_delta(spark: SparkSession, staging: Staging, existing: Star) -> Star:
    """New rows of each dimension (natural keys that ``existing`` lacks); no fact.

    A table that ``existing`` does not have yet is None there: each is decided
    on its own. Songs resolve artists against existing and new ones.
    """
    dates = existing.dim_date if existing.dim_date is not None else make_dim_date(spark)
    artists = build_dim_artists(staging.artists, existing.dim_artists)
    users = build_dim_users(staging.users, existing.dim_users)
    songs = build_dim_songs(staging.songs, _union(existing.dim_artists, artists), existing.dim_songs)
    return Star(dates, artists, users, songs, None)


def build_star_delta(spark: SparkSession, staging: Staging, existing: Star | None = None,
                     fact_partitions: int | None = None) -> Star:
    """Only the rows to add: new natural keys of each dimension, new event ids."""
    old = existing or Star(None, None, None, None, None)
    dims = build_dims_delta(spark, staging, old)
    new_fact = build_fact_streams(staging.events, _union(old.dim_users, dims.dim_users),
                                  _union(old.dim_songs, dims.dim_songs), dims.dim_date, old.fact_streams,
                                  num_partitions=fact_partitions)
    return dims._replace(fact_streams=new_fact)


def _union(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if existing is None else existing.select(*new.columns).unionByName(new)


def build_star(spark: SparkSession, staging: Staging, existing: Star | None = None,
               fact_partitions: int | None = None) -> Star:
    """The whole star schema after loading ``staging`` on top of ``existing``."""
    delta = build_star_delta(spark, staging, existing, fact_partitions)
    if existing is None:
        return delta
    return Star(existing.dim_date, *[_union(existing.table(n), delta.table(n))
                                     for n in ("dim_artists", "dim_users", "dim_songs",
                                               "fact_streams")])


def write_star(star: Star, root: str, mode: str = "overwrite") -> str:
    """Write the star schema, its rows stamped ``created_at``. The calendar is populated once: one that is there stays."""
    from ..operators.quality import assert_no_pii

    assert_no_pii(star)   # personal data never reaches the analytics layer
    root = root.rstrip("/")
    populated = path_exists(star.dim_date.sparkSession, f"{root}/dim_date/_SUCCESS")
    stamped = lambda n: star.table(n).withColumn(CREATED_AT, F.current_timestamp())
    writes = [(lambda n=name: stamped(n).write.mode(mode).parquet(f"{root}/{n}"))
              for name in DIMENSIONS if not (name == "dim_date" and populated)]
    # Rows are range-clustered by (date_key, event_id): few files per day.
    # A full replace of the fact (static): no day of an earlier build survives.
    writes.append(lambda: stamped(FACT).write.mode(mode)
                  .option("partitionOverwriteMode", "static").partitionBy("date_key")
                  .parquet(f"{root}/{FACT}"))
    run_all(writes, max_workers=len(writes))
    return root


def read_star(spark: SparkSession, root: str) -> Star:
    """The star schema by its declared schemas; a table that was never written is empty."""
    root = root.rstrip("/")

    def table(name: str) -> DataFrame:
        rows = read_or_none(spark, f"{root}/{name}", schemas.STAR[name])
        rows = spark.createDataFrame([], schemas.STAR[name]) if rows is None else rows
        return rows.select(*schemas.STAR[name].fieldNames())

    return Star(*[table(n) for n in (*DIMENSIONS, FACT)])


def write_staging(staging: Staging, root: str, mode: str = "overwrite") -> str:
    root = root.rstrip("/")
    run_all((lambda n=name: staging.table(n).write.mode(mode).parquet(f"{root}/{n}"))
            for name in ("stg_artists", "stg_songs", "stg_users", "stg_stream_events"))
    return root


# Warehouses already built in this application, by source folder. The
# registered queries share one build per session instead of rebuilding the
# star schema for each report.
_BUILT: dict[tuple[str, str], str] = {}
_BUILD_LOCK = threading.Lock()


def driver_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Build (once per application) the warehouse of the driver tables; its root.

    driver tables -> JSON Lines source files (``sources/``) -> JSON ingest with
    the loader's defaults -> staging Parquet (accepted / rejected partitions)
    -> star schema.
    """
    from ..sources.driver_tables import staging as driver_staging
    from ..sources.json_source import land_staging, write_sources
    from ..sources.staging import from_parquet

    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _BUILD_LOCK:
        root = _BUILT.get(key)
        if root is None:
            root = scratch_path(spark, "warehouse")
            write_sources(driver_staging(spark, sf_dir), f"{root}/sources")
            land_staging(spark, f"{root}/sources", root)
            star = build_star(spark, from_parquet(spark, root))
            write_star(star, root)
            _BUILT[key] = root
    return root


def driver_star(spark: SparkSession, sf_dir: str) -> Star:
    return read_star(spark, driver_warehouse(spark, sf_dir))


def driver_staging_tables(spark: SparkSession, sf_dir: str) -> Staging:
    from ..sources.staging import from_parquet
    return from_parquet(spark, driver_warehouse(spark, sf_dir))

