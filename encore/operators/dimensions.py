"""Dimension builds: staging -> cleaned, deduplicated, keyed dimensions.

Each build returns the rows to append, in the reference's insert-if-absent
sense: rows whose natural key is already in the existing dimension are skipped
(first seen wins, attributes are never updated) and new rows get keys after the
existing maximum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..rules import MIN_SONG_DURATION_MS
from .joins import lookup_join
from .keys import insert_if_absent


def clean_artists(stg_artists: DataFrame) -> DataFrame:
    """T1 projection: trim name, upper country, lower genre (no NULLIF)."""
    return stg_artists.where(F.col("artist_id").isNotNull()).select(
        "artist_id",
        C.trimmed("name").alias("name"),
        C.upper_trim("country").alias("country"),
        C.lower_trim("primary_genre").alias("primary_genre"),
    )


def clean_users(stg_users: DataFrame) -> DataFrame:
    """T2 projection: active users only, validated subscription, no PII.

    Columns are an allow-list: ``email`` can never reach the analytics layer.
    """
    return stg_users.where(F.col("is_active") & F.col("user_id").isNotNull()).select(
        "user_id",
        C.upper_trim("country_code").alias("country_code"),
        C.valid_subscription("subscription_type").alias("subscription_type"),
        "age_group",
        "signup_date",
    )


def clean_songs(stg_songs: DataFrame, dim_artists: DataFrame) -> DataFrame:
    """T3 projection: resolve the artist key (inner), drop songs of 10 s or less."""
    songs = stg_songs.where((F.col("duration_ms") > MIN_SONG_DURATION_MS) & F.col("song_id").isNotNull())
    artists = dim_artists.select("artist_id", "artist_key")
    joined = lookup_join(songs, artists, "artist_id", "inner")
    return joined.select(
        "song_id",
        C.trimmed("title").alias("title"),
        "artist_key",
        C.lower_trim("genre").alias("genre"),
        C.lower_trim_nullif_empty("subgenre").alias("subgenre"),
        "duration_ms",
        "release_date",
        C.default_false("is_explicit").alias("is_explicit"),
    )


def build_dim_artists(stg_artists: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New keyed artists (natural keys absent from ``existing``)."""
    return insert_if_absent(clean_artists(stg_artists), existing, "artist_id", "artist_key")


def build_dim_users(stg_users: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New keyed users (natural keys absent from ``existing``)."""
    return insert_if_absent(clean_users(stg_users), existing, "user_id", "user_key")


def build_dim_songs(stg_songs: DataFrame, dim_artists: DataFrame,
                    existing: DataFrame | None = None) -> DataFrame:
    """New keyed songs; ``dim_artists`` must hold all artists (existing and new)."""
    return insert_if_absent(clean_songs(stg_songs, dim_artists), existing, "song_id", "song_key")
