"""The weekly report: Q1-Q4 and their named sub-results.

Every operator takes the star schema (``Star``) and explicit parameters
(``as_of`` instead of the current date, window lengths, thresholds, k).
Ratios are rounded exactly (see ``functions.exact``); ties are broken by a
total order so that ranks and limits are deterministic.

Plan notes
* Date windows become a static ``date_key`` range on the fact (partition
  pruning at planning time) and a broadcast semi-join with the bounded
  calendar rows.
* Dimension lookups go through ``lookup_join`` (size-checked broadcast,
  otherwise a shuffle join with hot keys split off).
* Rank is computed after the top-k, on at most k rows: no global sort of all
  groups into one partition.
* When a dimension fails the broadcast check, the fact is first reduced to
  one row per join key (per song and listener, per genre and listener, per
  artist key and listener) so the shuffle join never sees raw plays.
* Q3: with users under the broadcast limit both rankings come from one
  map-side join and one aggregate to (subscription, platform, hour), a few
  hundred rows at most; above it from per (listener, platform, hour) cells.
  Each ranking is filtered to its first row before joining (no fan-out). Q4
  builds its two distinct counts from one shared distinct (artist, genre,
  country, window, user) set.
* Reports are ordered as they are printed, ties by the remaining columns.
"""

from __future__ import annotations

import datetime as dt
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import rules as R
from ..functions.exact import decimal_to_bp, half_up, half_up_units, pct
from .dates import date_window, labelled_windows
from .joins import all_fit_broadcast, fits_broadcast, join_by_hash, lookup_join


def _as_date(as_of) -> dt.date:
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    if isinstance(as_of, dt.date):
        return as_of
    if as_of is None:
        return dt.datetime.now(dt.timezone.utc).date()
    return dt.date.fromisoformat(str(as_of))


def _key(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def fact_in_window(star, as_of, days: int) -> DataFrame:
    """Fact rows with ``date_key`` in ``[as_of - days, as_of)``."""
    as_of = _as_date(as_of)
    lo, hi = _key(as_of - dt.timedelta(days=days)), _key(as_of)
    window = date_window(star.dim_date, as_of, days)
    fact = star.fact_streams.where((F.col("date_key") >= lo) & (F.col("date_key") < hi))
    # Bounded (≤ days rows): broadcast semi-join, the IN (subquery) of the report.
    return fact.join(F.broadcast(window), "date_key", "left_semi")


# ---------------------------------------------------------------------------
# Q1 trending songs
# ---------------------------------------------------------------------------

def trending_songs(star, as_of, days: int = R.TRENDING_DAYS, k: int = R.TRENDING_TOP) -> DataFrame:
    """Top ``k`` (artist, song, genre) by unique listeners over the last ``days`` days."""
    fact = fact_in_window(star, as_of, days)
    songs = star.dim_songs.select("song_key", F.col("title").alias("song"), "genre")
    artists = star.dim_artists.select("artist_key", F.col("name").alias("artist"))
    skipped = F.col("was_skipped")
    bp = decimal_to_bp("completion_pct")
    if all_fit_broadcast(songs, artists):
        # Dimensions are broadcast: join map-side, aggregate once.
        rows = fact.select("song_key", "artist_key", "user_key", F.lit(1).alias("plays"),
                           bp.alias("bp"), skipped.cast("int").alias("skips"))
    else:
        # Large dimensions: one row per (song, listener) before the shuffle joins.
        rows = fact.groupBy("song_key", "artist_key", "user_key").agg(
            F.count(F.lit(1)).alias("plays"), F.sum(bp).alias("bp"),
            F.count_if(skipped).alias("skips"))
    keys = fact.select("song_key", "artist_key")
    joined = lookup_join(lookup_join(rows, songs, "song_key", hot_from=keys), artists,
                         "artist_key", hot_from=keys)
    groups = joined.groupBy("artist", "song", "genre").agg(
        F.count_distinct("user_key").alias("unique_listeners"),
        F.sum("plays").alias("total_plays"),
        F.sum("bp").alias("sum_bp"),
        F.sum("skips").alias("skip_count"),
    )
    order = [F.col("unique_listeners").desc(), F.col("artist").asc_nulls_last(),
             F.col("song").asc_nulls_last(), F.col("genre").asc_nulls_last()]
    top = groups.orderBy(*order).limit(k)
    # Rank over at most k rows.
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
    return ranked.select(
        "rank", "artist", "song", "genre",
        F.col("unique_listeners").cast("long").alias("unique_listeners"),
        F.col("total_plays").cast("long").alias("total_plays"),
        half_up(F.col("sum_bp"), F.col("total_plays") * 100, 1).alias("avg_completion_pct"),
        F.col("skip_count").cast("long").alias("skip_count"),
        pct(F.col("skip_count"), F.col("total_plays"), 1).alias("skip_rate_pct"),
    )


# ---------------------------------------------------------------------------
# Q2 genre skip rates
# ---------------------------------------------------------------------------

_Q2_MEASURES = ("plays", "skips", "kept_bp", "kept")


def _sum_measures(df: DataFrame, keys, measures) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def genre_skip_rates(star) -> DataFrame:
    """Skip rates per genre, overall and split free / premium; listen depth; length."""
    skipped = F.col("was_skipped")
    bp = decimal_to_bp("completion_pct")
    plays = star.fact_streams.select(
        "song_key", "user_key", F.lit(1).alias("plays"), skipped.cast("int").alias("skips"),
        F.when(~skipped, bp).alias("kept_bp"), (~skipped).cast("int").alias("kept"))
    songs = star.dim_songs.select("song_key", "genre", "duration_ms")
    users = star.dim_users.select("user_key", "subscription_type")
    if not fits_broadcast(songs):
        # One row per (song, listener) before the shuffle join with songs.
        plays = _sum_measures(plays, ["song_key", "user_key"], _Q2_MEASURES)
    keys = star.fact_streams.select("song_key", "user_key")
    rows = lookup_join(plays, songs, "song_key", hot_from=keys).select(
        "genre", "user_key", *_Q2_MEASURES,
        (F.col("duration_ms").cast("long") * F.col("plays")).alias("sum_ms"),
        F.when(F.col("duration_ms").isNotNull(), F.col("plays")).alias("n_ms"))
    measures = _Q2_MEASURES + ("sum_ms", "n_ms")
    if not fits_broadcast(users):
        # One row per (genre, listener) before the shuffle join with users.
        rows = _sum_measures(rows, ["genre", "user_key"], measures)
    joined = lookup_join(rows, users, "user_key", hot_from=keys)
    sub = F.col("subscription_type")
    g = joined.groupBy("genre").agg(
        F.sum("plays").alias("total_plays"),
        F.sum("skips").alias("skips"),
        F.sum(F.when(sub == "free", F.col("plays"))).alias("free_plays"),
        F.sum(F.when(sub == "free", F.col("skips"))).alias("free_skips"),
        F.sum(F.when(sub == "premium", F.col("plays"))).alias("premium_plays"),
        F.sum(F.when(sub == "premium", F.col("skips"))).alias("premium_skips"),
        F.sum("kept_bp").alias("kept_bp"),
        F.sum("kept").alias("kept"),
        F.sum("sum_ms").alias("sum_ms"),
        F.sum("n_ms").alias("n_ms"),
    )
    return g.select(
        "genre",
        F.col("total_plays").cast("long").alias("total_plays"),
        pct(F.col("skips"), F.col("total_plays"), 2).alias("overall_skip_rate_pct"),
        pct(F.col("free_skips"), F.col("free_plays"), 2).alias("free_skip_rate_pct"),
        pct(F.col("premium_skips"), F.col("premium_plays"), 2).alias("premium_skip_rate_pct"),
        half_up(F.col("kept_bp"), F.col("kept") * 100, 1).alias("avg_listen_depth_pct"),
        half_up(F.col("sum_ms"), F.col("n_ms") * 1000, 0).alias("avg_song_duration_sec"),
    ).orderBy(F.col("overall_skip_rate_pct").desc_nulls_last(), F.col("genre").asc_nulls_last())


# ---------------------------------------------------------------------------
# Q3 free vs premium
# ---------------------------------------------------------------------------

def _listener_cells(star) -> DataFrame:
    """Plays per (listener, platform, hour), with the listener's subscription.

    One aggregate over the fact, joined once with users; the way for users
    above the broadcast limit, and for the listener stats.
    """
    fact = star.fact_streams.select(
        "user_key", "platform", F.hour("listened_at").cast("long").alias("hour"),
        "was_skipped", decimal_to_bp("completion_pct").alias("bp"))
    cells = fact.groupBy("user_key", "platform", "hour").agg(
        F.count(F.lit(1)).alias("plays"),
        F.count_if("was_skipped").alias("skips"),
        F.sum("bp").alias("bp"))
    return lookup_join(cells, _subscriptions(star), "user_key", hot_from=star.fact_streams)


def _subscription_cells(star) -> DataFrame:
    """Plays per (subscription, platform, hour): what both rankings need.

    Users under the broadcast limit are joined map-side and the fact is
    aggregated straight to these few groups, so the shuffle carries at most one
    row per group and task. Else from the listener cells.
    """
    users = _subscriptions(star)
    if fits_broadcast(users):
        plays = (star.fact_streams.select("user_key", "platform", F.hour("listened_at").cast("long").alias("hour"))
                 .join(F.broadcast(users), "user_key"))
        return plays.groupBy("subscription_type", "platform", "hour").agg(F.count(F.lit(1)).alias("plays"))
    return _listener_cells(star).groupBy("subscription_type", "platform", "hour").agg(F.sum("plays").alias("plays"))


def _listener_genres(star) -> DataFrame:
    """Distinct genres per listener.

    Songs broadcast: look the genre up on each play and shuffle distinct
    (listener, genre) pairs (genres are few). Otherwise distinct (listener,
    song) pairs first, so the shuffle join with songs sees each pair once.
    """
    songs = star.dim_songs.select("song_key", "genre")
    plays = star.fact_streams.select("user_key", "song_key")
    if fits_broadcast(songs):
        pairs = plays.join(F.broadcast(songs), "song_key").select("user_key", "genre")
    else:
        pairs = lookup_join(plays.distinct(), songs, "song_key",
                            hot_from=star.fact_streams).select("user_key", "genre")
    return pairs.groupBy("user_key").agg(F.count_distinct("genre").alias("unique_genres"))


def _listener_stats(star) -> DataFrame:
    """Plays, skips and completion per listener, with the subscription: one row per listener is shuffled."""
    per_user = star.fact_streams.select("user_key", "was_skipped", decimal_to_bp("completion_pct").alias("bp")).groupBy("user_key").agg(
        F.count(F.lit(1)).alias("plays"), F.count_if("was_skipped").alias("skips"), F.sum("bp").alias("bp"))
    return lookup_join(per_user, _subscriptions(star), "user_key", split_hot=False)


def _subscriptions(star) -> DataFrame:
    return star.dim_users.select("user_key", "subscription_type")


def _user_stats(star, cells: DataFrame) -> DataFrame:
    per_user = cells.groupBy("user_key", "subscription_type").agg(
        F.sum("plays").alias("plays"), F.sum("bp").alias("bp"), F.sum("skips").alias("skips"))
    joined = per_user.join(_listener_genres(star), "user_key", "left")
    return joined.select(
        F.col("user_key").cast("long").alias("user_key"),
        "subscription_type",
        F.col("plays").cast("long").alias("plays"),
        half_up_units(F.col("bp"), F.col("plays") * 100, 2).alias("avg_completion_units"),
        half_up_units(F.col("skips") * 100, F.col("plays"), 2).alias("skip_rate_units"),
        F.coalesce(F.col("unique_genres"), F.lit(0)).cast("long").alias("unique_genres"),
    )


def user_stats(star) -> DataFrame:
    """Per listener: plays, rounded average completion and skip rate (as units), genres."""
    return _user_stats(star, _listener_stats(star))


def user_stats_report(star) -> DataFrame:
    """``user_stats`` with its rounded values as doubles."""
    us = user_stats(star)
    return us.select(
        "user_key", "subscription_type", "plays",
        (F.col("avg_completion_units").cast("double") / 100).alias("avg_completion"),
        (F.col("skip_rate_units").cast("double") / 100).alias("skip_rate"),
        "unique_genres",
    )


def _ranked_per_subscription(counts: DataFrame, item: str, count_col: str) -> DataFrame:
    # A handful of rows per subscription type: the window partitions are tiny.
    w = Window.partitionBy("subscription_type").orderBy(
        F.col(count_col).desc(), F.col(item).asc_nulls_last())
    return counts.withColumn("rn", F.row_number().over(w).cast("long"))


def _platform_rank(cells: DataFrame) -> DataFrame:
    counts = cells.groupBy("subscription_type", "platform").agg(
        F.sum("plays").cast("long").alias("play_count"))
    return _ranked_per_subscription(counts, "platform", "play_count")


def _peak_hour(cells: DataFrame) -> DataFrame:
    counts = cells.groupBy("subscription_type", "hour").agg(F.sum("plays").cast("long").alias("cnt"))
    return _ranked_per_subscription(counts, "hour", "cnt")


def platform_rank(star) -> DataFrame:
    """Plays per (subscription, platform), ranked within the subscription."""
    return _platform_rank(_subscription_cells(star))


def peak_hour(star) -> DataFrame:
    """Plays per (subscription, UTC hour), ranked within the subscription."""
    return _peak_hour(_subscription_cells(star))


def free_vs_premium(star) -> DataFrame:
    """Listening behaviour per subscription type (user-weighted averages)."""
    cells = _subscription_cells(star)
    us = _user_stats(star, _listener_stats(star))
    per_sub = us.groupBy("subscription_type").agg(
        F.count(F.lit(1)).alias("total_users"),
        F.sum("plays").alias("plays"),
        F.sum("avg_completion_units").alias("completion_units"),
        F.sum("skip_rate_units").alias("skip_units"),
        F.sum("unique_genres").alias("genres"),
    )
    # Keep only the first-ranked row of each ranking before joining: one row per
    # subscription type on each side (the cleaned domain has three values), so
    # the join cannot fan out and both sides are broadcast.
    top_platform = _platform_rank(cells).where(F.col("rn") == 1).select(
        "subscription_type", F.col("platform").alias("top_platform"))
    top_hour = _peak_hour(cells).where(F.col("rn") == 1).select(
        "subscription_type", F.col("hour").alias("peak_hour_utc"))
    joined = join_by_hash(join_by_hash(per_sub, top_platform, "subscription_type", "left"), top_hour, "subscription_type", "left")
    n = F.col("total_users")
    return joined.select(
        "subscription_type",
        n.cast("long").alias("total_users"),
        half_up(F.col("plays"), n, 0).alias("avg_plays_per_user"),
        half_up(F.col("completion_units"), n * 100, 1).alias("avg_completion_pct"),
        half_up(F.col("skip_units"), n * 100, 1).alias("skip_rate_pct"),
        half_up(F.col("genres"), n, 1).alias("avg_unique_genres"),
        "top_platform",
        F.col("peak_hour_utc").cast("long").alias("peak_hour_utc"),
    ).orderBy(F.col("subscription_type").asc_nulls_last())


# ---------------------------------------------------------------------------
# Q4 regional breakout artists
# ---------------------------------------------------------------------------

def date_windows(star, as_of, window_days: int = R.BREAKOUT_WINDOW_DAYS) -> DataFrame:
    return labelled_windows(star.dim_date, _as_date(as_of), window_days)


def _listeners(star, as_of, window_days: int) -> DataFrame:
    """Distinct (artist, genre, country, window, user): shared by both counts."""
    as_of = _as_date(as_of)
    windows = date_windows(star, as_of, window_days)
    lo, hi = _key(as_of - dt.timedelta(days=2 * window_days)), _key(as_of)
    fact = (star.fact_streams.where((F.col("date_key") >= lo) & (F.col("date_key") < hi))
            .select("date_key", "artist_key", "country_code", "user_key"))
    # At most 2 * window_days calendar rows: broadcast.
    fact = fact.join(F.broadcast(windows), "date_key").drop("date_key")
    artists = star.dim_artists.select("artist_key", F.col("name").alias("artist"),
                                      F.col("primary_genre").alias("genre"))
    keys = fact.select("artist_key")
    if not fits_broadcast(artists):
        # Distinct listeners per artist key first: the shuffle join sees no repeats.
        fact = fact.distinct()
    joined = lookup_join(fact, artists, "artist_key", hot_from=keys)
    return joined.select("artist", "genre", "country_code", "window_label", "user_key").distinct()


def regional_listeners(star, as_of, window_days: int = R.BREAKOUT_WINDOW_DAYS) -> DataFrame:
    return (_listeners(star, as_of, window_days)
            .groupBy("artist", "genre", "country_code", "window_label")
            .agg(F.count(F.lit(1)).cast("long").alias("unique_listeners")))


def _pivot(regional: DataFrame) -> DataFrame:
    label = F.col("window_label")
    n = F.col("unique_listeners")
    return regional.groupBy("artist", "genre", "country_code").agg(
        F.sum(F.when(label == "recent", n).otherwise(0)).cast("long").alias("recent_listeners"),
        F.sum(F.when(label == "previous", n).otherwise(0)).cast("long").alias("prev_listeners"),
    )


def breakout_pivot(star, as_of, window_days: int = R.BREAKOUT_WINDOW_DAYS) -> DataFrame:
    return _pivot(regional_listeners(star, as_of, window_days))


def _global(listeners: DataFrame) -> DataFrame:
    return (listeners.where(F.col("window_label") == "recent")
            .select("artist", "user_key").distinct()
            .groupBy("artist").agg(F.count(F.lit(1)).cast("long").alias("global_listeners")))


def global_listeners(star, as_of, window_days: int = R.BREAKOUT_WINDOW_DAYS) -> DataFrame:
    return _global(_listeners(star, as_of, window_days))


def breakout_artists(star, as_of, window_days: int = R.BREAKOUT_WINDOW_DAYS,
                     min_recent: int = R.BREAKOUT_MIN_RECENT, min_prev: int = R.BREAKOUT_MIN_PREVIOUS,
                     min_growth: float | str = R.BREAKOUT_MIN_GROWTH, k: int = R.BREAKOUT_TOP) -> DataFrame:
    """Artists growing in one country: recent vs previous unique listeners."""
    listeners = _listeners(star, as_of, window_days)
    regional = listeners.groupBy("artist", "genre", "country_code", "window_label").agg(
        F.count(F.lit(1)).alias("unique_listeners"))
    pivot = _pivot(regional)
    totals = _global(listeners)
    growth = Fraction(str(min_growth))
    r, p = F.col("recent_listeners"), F.col("prev_listeners")
    # The growth test on exact integers: r / p > num / den  <=>  r * den > p * num.
    # ``totals`` has at most one row per artist: it fits whenever the artist
    # dimension does.
    artists = star.dim_artists.select("artist_key", "name", "primary_genre")
    # ``pivot`` holds one row per (artist, genre, country): no hot artist rows.
    joined = (join_by_hash(pivot, totals, "artist", "inner") if fits_broadcast(artists)
              else lookup_join(pivot, totals, "artist", split_hot=False))
    kept = (joined
            .where((r >= min_recent) & (p >= min_prev) &
                   (r * growth.denominator > p * growth.numerator)))
    scored = kept.select(
        "artist", "genre", "country_code", "recent_listeners", "prev_listeners",
        half_up(r, p, 2).alias("breakout_score"),
        pct(r, F.col("global_listeners"), 1).alias("regional_concentration_pct"),
    )
    return scored.orderBy(
        F.col("breakout_score").desc(), F.col("recent_listeners").desc(),
        F.col("artist").asc_nulls_last(), F.col("genre").asc_nulls_last(),
        F.col("country_code").asc_nulls_last()).limit(k)


# ---------------------------------------------------------------------------
# The report as a unit
# ---------------------------------------------------------------------------

def weekly_report(star, as_of=None, window_days: int = R.BREAKOUT_WINDOW_DAYS) -> dict[str, DataFrame]:
    """The four tables of the weekly report, by name, each in its printed order."""
    as_of = _as_date(as_of)
    return {"trending_songs": trending_songs(star, as_of), "genre_skip_rates": genre_skip_rates(star),
            "free_vs_premium": free_vs_premium(star), "breakout_artists": breakout_artists(star, as_of, window_days)}


def write_weekly_report(star, root: str, as_of=None, window_days: int = R.BREAKOUT_WINDOW_DAYS) -> dict[str, str]:
    """Write the four tables as Parquet under ``root/as_of=<day>``, replacing an earlier report of the day; their paths.

    Every table is small (a row per genre at most); it is written as one file so that its order is kept."""
    as_of = _as_date(as_of)
    paths = {}
    for name, table in weekly_report(star, as_of, window_days).items():
        paths[name] = f"{root.rstrip('/')}/as_of={as_of.isoformat()}/{name}"
        table.coalesce(1).write.mode("overwrite").parquet(paths[name])
    return paths
