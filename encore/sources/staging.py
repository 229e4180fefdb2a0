"""The staging layer: four typed, permissive tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from .. import schemas


class Staging(NamedTuple):
    artists: DataFrame
    songs: DataFrame
    users: DataFrame
    events: DataFrame

    def table(self, name: str) -> DataFrame:
        return {"stg_artists": self.artists, "stg_songs": self.songs,
                "stg_users": self.users, "stg_stream_events": self.events}[name]


def conform(df: DataFrame, schema) -> DataFrame:
    """Select and cast to a declared schema (missing columns become NULL)."""
    from pyspark.sql import functions as F

    present = set(df.columns)
    cols = []
    for field in schema.fields:
        if field.name in present:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)


LOAD_STATUS = "_load_status"


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A staging table; of a status-partitioned landing, the accepted records."""
    from pyspark.sql import functions as F

    df = spark.read.parquet(path)
    if LOAD_STATUS in df.columns:
        df = df.where(F.col(LOAD_STATUS) == "accepted")
    return conform(df, schema)


def from_parquet(spark: SparkSession, root: str) -> Staging:
    """Read a staging layer that was landed as Parquet under ``root``."""
    root = root.rstrip("/")
    return Staging(
        artists=read_table(spark, f"{root}/stg_artists", schemas.STG_ARTISTS),
        songs=read_table(spark, f"{root}/stg_songs", schemas.STG_SONGS),
        users=read_table(spark, f"{root}/stg_users", schemas.STG_USERS),
        events=read_table(spark, f"{root}/stg_stream_events", schemas.STG_EVENTS),
    )


def from_frames(spark: SparkSession, artists=(), songs=(), users=(), events=()) -> Staging:
    """Build staging from in-memory rows (unit-test fixtures)."""
    return Staging(
        artists=spark.createDataFrame(list(artists), schemas.STG_ARTISTS),
        songs=spark.createDataFrame(list(songs), schemas.STG_SONGS),
        users=spark.createDataFrame(list(users), schemas.STG_USERS),
        events=spark.createDataFrame(list(events), schemas.STG_EVENTS),
    )
