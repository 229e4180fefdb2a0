"""Declared schemas of the staging (bronze) and analytics (star) layers.

Staging is permissive: every column nullable, nothing inferred. Analytics
tables carry a dense surrogate key beside the natural key, and no personal
data (``email`` stays in staging).
"""

from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)


def _struct(*fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# ---- raw source records (one JSON object per row) ------------------------

ARTIST_SOURCE = _struct(
    ("artist_id", StringType()), ("name", StringType()), ("country", StringType()),
    ("primary_genre", StringType()), ("monthly_listeners", IntegerType()),
)

SONG_SOURCE = _struct(
    ("song_id", StringType()), ("title", StringType()), ("artist_id", StringType()),
    ("genre", StringType()), ("subgenre", StringType()), ("duration_ms", IntegerType()),
    ("release_date", DateType()), ("is_explicit", BooleanType()),
)

USER_SOURCE = _struct(
    ("user_id", StringType()), ("email", StringType()), ("country_code", StringType()),
    ("subscription_type", StringType()), ("age_group", StringType()),
    ("signup_date", DateType()), ("is_active", BooleanType()),
)

EVENT_SOURCE = _struct(
    ("event_id", StringType()), ("user_id", StringType()), ("song_id", StringType()),
    ("listened_at", TimestampType()), ("duration_ms", IntegerType()),
    ("song_duration_ms", IntegerType()), ("was_skipped", BooleanType()),
    ("skip_at_ms", IntegerType()), ("platform", StringType()), ("country_code", StringType()),
)

# ---- staging tables (column order of the staging layer) -------------------

STG_ARTISTS = ARTIST_SOURCE
STG_SONGS = _struct(
    ("song_id", StringType()), ("title", StringType()), ("artist_id", StringType()),
    ("album_id", StringType()), ("genre", StringType()), ("subgenre", StringType()),
    ("duration_ms", IntegerType()), ("release_date", DateType()), ("is_explicit", BooleanType()),
)
STG_USERS = USER_SOURCE
STG_EVENTS = EVENT_SOURCE

STAGING = {
    "stg_artists": STG_ARTISTS,
    "stg_songs": STG_SONGS,
    "stg_users": STG_USERS,
    "stg_stream_events": STG_EVENTS,
}

# Required keys per source (the loader raises on their absence; we report).
REQUIRED = {
    "stg_artists": ("artist_id", "name"),
    "stg_songs": ("song_id", "title", "artist_id"),
    "stg_users": ("user_id",),
    "stg_stream_events": ("event_id", "user_id", "song_id", "listened_at"),
}

# ---- analytics layer -------------------------------------------------------

DIM_DATE = _struct(
    ("date_key", IntegerType()), ("full_date", DateType()), ("year", IntegerType()), ("quarter", IntegerType()),
    ("month", IntegerType()), ("month_name", StringType()), ("week_number", IntegerType()),
    ("day_of_week", IntegerType()), ("day_name", StringType()), ("is_weekend", BooleanType()),
)
DIM_ARTISTS = _struct(
    ("artist_key", LongType()), ("artist_id", StringType()), ("name", StringType()), ("country", StringType()),
    ("primary_genre", StringType()),
)
DIM_USERS = _struct(
    ("user_key", LongType()), ("user_id", StringType()), ("country_code", StringType()),
    ("subscription_type", StringType()), ("age_group", StringType()), ("signup_date", DateType()),
)
DIM_SONGS = _struct(
    ("song_key", LongType()), ("song_id", StringType()), ("title", StringType()), ("artist_key", LongType()),
    ("genre", StringType()), ("subgenre", StringType()), ("duration_ms", IntegerType()),
    ("release_date", DateType()), ("is_explicit", BooleanType()),
)
FACT_STREAMS = _struct(
    ("stream_key", LongType()), ("event_id", StringType()), ("user_key", LongType()), ("song_key", LongType()),
    ("artist_key", LongType()), ("date_key", IntegerType()), ("listened_at", TimestampType()),
    ("duration_ms", IntegerType()), ("song_duration_ms", IntegerType()), ("was_skipped", BooleanType()),
    ("completion_pct", DecimalType(5, 2)), ("platform", StringType()), ("country_code", StringType()),
)
STAR = {"dim_date": DIM_DATE, "dim_artists": DIM_ARTISTS, "dim_users": DIM_USERS, "dim_songs": DIM_SONGS,
        "fact_streams": FACT_STREAMS}

DIM_DATE_COLUMNS = DIM_DATE.fieldNames()
DIM_ARTISTS_COLUMNS = DIM_ARTISTS.fieldNames()
DIM_USERS_COLUMNS = DIM_USERS.fieldNames()
DIM_SONGS_COLUMNS = DIM_SONGS.fieldNames()
FACT_COLUMNS = FACT_STREAMS.fieldNames()

# Keys and columns of the fact that no row may lack.
FACT_REQUIRED = ("event_id", "user_key", "song_key", "artist_key", "date_key", "listened_at")

# Declared lengths of the relational contract: VARCHAR(n) / CHAR(n).
LENGTH_CONTRACT = {
    "stg_stream_events": {"event_id": 36, "user_id": 36, "song_id": 36, "platform": 20,
                          "country_code": 2},
    "stg_users": {"user_id": 36, "email": 255, "country_code": 2, "subscription_type": 20,
                  "age_group": 20},
    "stg_songs": {"song_id": 36, "title": 500, "artist_id": 36, "album_id": 36,
                  "genre": 100, "subgenre": 100},
    "stg_artists": {"artist_id": 36, "name": 500, "country": 2, "primary_genre": 100},
}
