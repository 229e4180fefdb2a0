"""Staging layer bound to the driver's generated tables.

The driver supplies TPC-H-like Parquet tables instead of the four JSON
sources. This module maps them onto the staging shape, column by column, with
deliberate dirt (padding, mixed case, invalid subscription values, short songs,
orphans) so that every cleaning rule of the analytics load is exercised:

* artists  <- supplier ⋈ nation ⋈ region
* songs    <- part (artist = the number in ``p_brand``)
* users    <- customer ⋈ nation ⋈ region
* events   <- events (song = ``props.k``), song length from part, country
  from the user.

The same expressions are written in the DuckDB prelude of the oracle SQL.
Everything stays lazy: Catalyst pushes later filters and projections into
these scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .staging import Staging

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the binding (must equal the oracle prelude).
SUBSCRIPTION_BY_SEGMENT = {
    "BUILDING": " Premium ",
    "HOUSEHOLD": "FREE",
    "MACHINERY": "free",
    "AUTOMOBILE": "trial",
}
AGE_GROUPS = ("18-24", "25-34", "35-44", "45+")
PLATFORMS = (" iOS", "Android ", "web", "desktop")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _region_of_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    # nation (25 rows) and region (5 rows) are fixed-size lookup tables.
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey) \
                 .select("n_nationkey", "n_name", "r_name")


def stg_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier")
    geo = _region_of_nation(spark, sf_dir)
    return (supplier.join(F.broadcast(geo), supplier.s_nationkey == geo.n_nationkey, "left")
            .select(F.col("s_suppkey").cast("string").alias("artist_id"),
                    F.concat(F.lit("  "), F.col("s_name"), F.lit(" ")).alias("name"),
                    F.lower(F.col("n_name")).alias("country"),
                    F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("primary_genre"),
                    F.lit(None).cast("int").alias("monthly_listeners")))


def stg_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    size_mod = F.pmod(F.col("p_size"), F.lit(3))
    key_mod = F.pmod(F.col("p_partkey"), F.lit(3))
    return part.select(
        F.col("p_partkey").cast("string").alias("song_id"),
        F.concat(F.lit(" "), F.col("p_name")).alias("title"),
        F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)).alias("artist_id"),
        F.lit(None).cast("string").alias("album_id"),
        F.concat(F.lit(" "), F.col("p_type")).alias("genre"),
        F.when(size_mod == 0, F.lit("")).when(size_mod == 1, F.col("p_type")).alias("subgenre"),
        (F.col("p_size") * 4000).cast("int").alias("duration_ms"),
        F.date_add(F.lit("2015-01-01").cast("date"),
                   F.pmod(F.col("p_partkey"), F.lit(3000)).cast("int")).alias("release_date"),
        F.when(key_mod == 0, F.lit(True)).when(key_mod == 1, F.lit(False)).alias("is_explicit"),
    )


def _subscription(segment) -> F.Column:
    expr = None
    for seg, value in SUBSCRIPTION_BY_SEGMENT.items():
        expr = (F.when(segment == seg, F.lit(value)) if expr is None
                else expr.when(segment == seg, F.lit(value)))
    return expr


def _age_group(custkey) -> F.Column:
    m = F.pmod(custkey, F.lit(4))
    expr = F.when(m == 0, F.lit(AGE_GROUPS[0]))
    for i, g in enumerate(AGE_GROUPS[1:], start=1):
        expr = expr.when(m == i, F.lit(g))
    return expr


def stg_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    geo = _region_of_nation(spark, sf_dir)
    return (customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey, "left")
            .select(F.col("c_custkey").cast("string").alias("user_id"),
                    F.col("c_name").alias("email"),
                    F.concat(F.lit(" "), F.lower(F.col("r_name"))).alias("country_code"),
                    _subscription(F.col("c_mktsegment")).alias("subscription_type"),
                    _age_group(F.col("c_custkey")).alias("age_group"),
                    F.date_add(F.lit("2020-01-01").cast("date"),
                               F.pmod(F.col("c_custkey"), F.lit(1000)).cast("int")).alias("signup_date"),
                    (F.col("c_acctbal") >= 0).alias("is_active")))


def _platform(event_id) -> F.Column:
    m = F.pmod(event_id, F.lit(4))
    expr = F.when(m == 0, F.lit(PLATFORMS[0]))
    for i, p in enumerate(PLATFORMS[1:], start=1):
        expr = expr.when(m == i, F.lit(p))
    return expr


def stg_stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("song_id"),
        (F.col("p_size") * 4000).cast("int").alias("song_duration_ms"))
    users = stg_users(spark, sf_dir).select(
        "user_id", F.col("country_code").alias("user_country_code"))
    duration = F.round(F.col("value") * 1000).cast("int")
    skipped = F.col("event_type") == "error"
    base = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object(F.col("props"), "$.k").alias("song_id"),
        F.col("ts").cast("timestamp").alias("listened_at"),
        duration.alias("duration_ms"),
        skipped.alias("was_skipped"),
        F.when(skipped, duration).alias("skip_at_ms"),
        _platform(F.col("event_id")).alias("platform"),
    )
    # Many-to-one lookups: the song length and the user's country.
    with_song = lookup_join(base, part, "song_id", "left")
    with_user = lookup_join(with_song, users, "user_id", "left", hot_from=base)
    return with_user.select(
        "event_id", "user_id", "song_id", "listened_at", "duration_ms", "song_duration_ms",
        "was_skipped", "skip_at_ms", "platform",
        F.col("user_country_code").alias("country_code"))


def staging(spark: SparkSession, sf_dir: str) -> Staging:
    return Staging(
        artists=stg_artists(spark, sf_dir),
        songs=stg_songs(spark, sf_dir),
        users=stg_users(spark, sf_dir),
        events=stg_stream_events(spark, sf_dir),
    )
