"""The play-event fact: staging events -> keyed, cleaned ``fact_streams``.

Plan shape: the quality filter runs on the staging scan (below the joins);
the user and song lookups are size-checked broadcast joins, or shuffle joins
with hot keys split off; the date lookup is a broadcast of a bounded
(one row per day) dimension. In large inputs duplicate event ids are found by a
narrow count per id over the resolved rows, written once; only the rows of
repeated ids go through the first-row-wins aggregate (partial aggregation
collapses copies map-side). Stream keys come from the dense-key operator ordered by (date_key, event_id), so the keyed frame is
already clustered by day for a ``date_key``-partitioned write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions.exact import bp_to_decimal, completion_bp
from ..rules import PLAY_OVERRUN_MS
from .joins import estimated_bytes, lookup_join
from .keys import insert_if_absent, max_key, partitions_for, written_once


RARE_DEDUP_MIN_BYTES = 256 * 1024 * 1024


def quality_filter(events: DataFrame) -> DataFrame:
    """``0 <= duration_ms <= song_duration_ms + 5000`` (NULL in either drops)."""
    d = F.col("duration_ms").cast("long")
    s = F.col("song_duration_ms").cast("long")
    return events.where((d >= 0) & (d <= s + PLAY_OVERRUN_MS))


def resolve_events(stg_events: DataFrame, dim_users: DataFrame, dim_songs: DataFrame,
                   dim_date: DataFrame) -> DataFrame:
    """T4 without keys or dedup: filter, resolve keys, clean and derive."""
    ev = quality_filter(stg_events.where(F.col("event_id").isNotNull()))
    ev = ev.withColumn("date_key", C.date_key_of("listened_at"))
    users = dim_users.select("user_id", "user_key")
    songs = dim_songs.select("song_id", "song_key", "artist_key")
    # Hot keys are sampled from the staging scan, not from the joined frame.
    raw = stg_events.select("user_id", "song_id")
    ev = lookup_join(ev, users, "user_id", "inner", hot_from=raw)
    ev = lookup_join(ev, songs, "song_id", "inner", hot_from=raw)
    # One row per calendar day (a few thousand rows): always broadcast.
    ev = ev.join(F.broadcast(dim_date.select("date_key")), "date_key", "inner")
    dur = F.greatest(F.col("duration_ms"), F.lit(0))
    song = F.greatest(F.col("song_duration_ms"), F.lit(1))
    return ev.select(
        "event_id", "user_key", "song_key", "artist_key", "date_key", "listened_at",
        dur.cast("int").alias("duration_ms"),
        song.cast("int").alias("song_duration_ms"),
        C.default_false("was_skipped").alias("was_skipped"),
        bp_to_decimal(completion_bp(dur, song)).alias("completion_pct"),
        C.lower_trim("platform").alias("platform"),
        C.upper_trim("country_code").alias("country_code"),
    )


def build_fact_streams(stg_events: DataFrame, dim_users: DataFrame, dim_songs: DataFrame,
                       dim_date: DataFrame, existing: DataFrame | None = None,
                       num_partitions: int | None = None, start: int | None = None,
                       known: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """New fact rows (keyed), skipping event ids already in ``existing``, or those of the batch
    that ``known(batch)`` gives.

    ``start`` is the largest key already used, when the caller tracks it (else
    it is read from ``existing``).
    """
    resolved = resolve_events(stg_events, dim_users, dim_songs, dim_date)
    staged_bytes = estimated_bytes(stg_events)
    if num_partitions is None:
        # Sized from the staging scan: Catalyst's estimate of the joined frame
        # is a product of its inputs without cost-based statistics.
        num_partitions = partitions_for(staged_bytes, stg_events.sparkSession)
    # Large inputs: the resolved rows are written once to shared scratch; repeated
    # event ids are found by a narrow count there, so full rows are shuffled
    # once (for the keys). Small inputs: one dedup shuffle costs less.
    spark = stg_events.sparkSession
    rare_min = int(spark.conf.get("encore.dedup.rareMinBytes", str(RARE_DEDUP_MIN_BYTES)))
    rare = staged_bytes is None or staged_bytes >= rare_min
    if rare:
        resolved = written_once(resolved, "resolved-events")
    if existing is not None and start is None:
        start = max_key(existing, "stream_key")
    if known is not None:
        loaded = known(resolved)
    else:
        loaded = None if existing is None else known_ids(existing, resolved, "event_id")
    return insert_if_absent(resolved, loaded, "event_id", "stream_key",
                            order_cols=["date_key", "event_id"], num_partitions=num_partitions,
                            start=start or 0, rare_duplicates=rare, size_hint=staged_bytes)


def known_ids(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Keys of ``existing`` that ``incoming`` holds too: a scan of the key column only, map-side
    when the incoming keys pass the broadcast check, so a small batch never shuffles the whole table."""
    return lookup_join(existing.select(key), incoming.select(key).distinct(), key, "left_semi", split_hot=False)


def append_events(events: DataFrame, users: DataFrame, songs: DataFrame, dates: DataFrame,
                  existing: DataFrame | None, start: int, write, known: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Resolve ``events`` and hand the keyed new rows to ``write(rows)``, which returns them as written;
    returns the valid events (staging shape) whose user or song is not known, each distinct row once.

    ``known(ids)`` gives the ids that are loaded already (by default, a scan of ``existing``). Events
    whose id is loaded, now or before, are not returned.
    """
    if known is None and existing is not None:
        known = lambda ids: known_ids(existing, ids, "event_id")
    new = write(build_fact_streams(events, users, songs, dates, start=start, known=known))
    valid = quality_filter(events.where(F.col("event_id").isNotNull()))
    unknown = (lookup_join(valid, users.select("user_id"), "user_id", "left_anti")
               .unionByName(lookup_join(valid, songs.select("song_id"), "song_id", "left_anti")))
    # Another copy of the same id may have been loaded with a known user and song.
    unknown = lookup_join(unknown, new.select("event_id"), "event_id", "left_anti", split_hot=False)
    if known is not None:
        unknown = lookup_join(unknown, known(unknown.select("event_id")), "event_id", "left_anti", split_hot=False)
    return unknown.distinct()
