"""Load audits: staging and analytics checks, integrity and contract reports.

The relational constraints of the reference (NOT NULL, foreign keys, column
lengths) abort a statement there; here they become reports, computed in one
aggregate pass per table (``count_if`` per rule), so a bad row is counted, not
fatal. Each report is a small DataFrame; none collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.exact import decimal_to_bp, half_up, pct
from .joins import fits_broadcast, join_by_hash, lookup_join, shuffled

from ..rules import (COMPLETION_BUCKETS, MIN_SONG_DURATION_MS, PLATFORMS, PLAY_OVERRUN_MS,
                     SAMPLE_ROWS, SUBSCRIPTION_TYPES)


def _labelled_counts(frames: Sequence[tuple[str, DataFrame]], label: str, count: str) -> DataFrame:
    out = None
    for name, df in frames:
        one = df.agg(F.count(F.lit(1)).cast("long").alias(count)).select(
            F.lit(name).alias(label), count)
        out = one if out is None else out.unionByName(one)
    return out


# ---- staging checks (after the load) ---------------------------------------

def row_counts_staging(staging) -> DataFrame:
    return _labelled_counts([("stg_artists", staging.artists), ("stg_songs", staging.songs),
                             ("stg_users", staging.users),
                             ("stg_stream_events", staging.events)], "tbl", "row_count").orderBy("tbl")


def dim_date_range(dim_date: DataFrame) -> DataFrame:
    return dim_date.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"),
                        F.count(F.lit(1)).cast("long").alias("days"))


def null_event_ids(stg_events: DataFrame) -> DataFrame:
    return stg_events.agg(F.count_if(F.col("event_id").isNull()).cast("long").alias("null_event_ids"))


def count_missing(child: DataFrame, parents: DataFrame, col: str) -> DataFrame:
    """Rows of ``child`` whose ``col`` has no match in ``parents`` (NULL counts as missing).

    With a small parent key set, a broadcast anti-join on the child rows; else
    the child is first reduced to one count per key, so the shuffle anti-join
    sees each key once.
    """
    # No distinct: repeated parent keys cannot change an anti-join.
    keys = parents.select(col).where(F.col(col).isNotNull())
    if fits_broadcast(keys):
        missing = lookup_join(child.select(col), keys, col, "left_anti")
        return missing.agg(F.count(F.lit(1)).cast("long").alias("missing"))
    per_key = child.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # One row per key on both sides: nothing hot to split off.
    missing = lookup_join(per_key, keys, col, "left_anti", split_hot=False)
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("missing"))


def orphan_song_ids(stg_events: DataFrame, stg_songs: DataFrame) -> DataFrame:
    """Events whose song is not in the catalogue (a NULL song counts as orphan)."""
    return count_missing(stg_events, stg_songs, "song_id").select(
        F.col("missing").alias("orphan_events"))


def staging_skip_rate(stg_events: DataFrame, stg_users: DataFrame) -> DataFrame:
    """Skip rate per raw subscription value (staging users are not unique)."""
    users = stg_users.select("user_id", "subscription_type")
    events = stg_events.select("user_id", F.col("was_skipped").cast("int").alias("skips"),
                               F.lit(1).alias("n"))
    if fits_broadcast(users):
        # Staging user ids are not unique: duplicates multiply (plain join).
        joined = join_by_hash(events, users, "user_id", "inner")
    else:
        # One row per user id before the shuffle join.
        per_user = events.groupBy("user_id").agg(F.sum("skips").alias("skips"), F.sum("n").alias("n"))
        joined = per_user.join(shuffled(users), "user_id")
    g = joined.groupBy("subscription_type").agg(
        F.sum("skips").alias("skips"), F.sum("n").alias("total_events"))
    return g.select("subscription_type", pct(F.col("skips"), F.col("total_events"), 2).alias("skip_pct"),
                    F.col("total_events").cast("long").alias("total_events")).orderBy(F.col("subscription_type").asc_nulls_last())


# ---- analytics checks (after the transform) --------------------------------

def row_counts_analytics(star) -> DataFrame:
    return _labelled_counts([(n, star.table(n)) for n in
                             ("dim_artists", "dim_users", "dim_songs", "dim_date", "fact_streams")],
                            "table_name", "row_count").orderBy("table_name")


def load_reconciliation(stg_events: DataFrame, fact: DataFrame) -> DataFrame:
    """Staged vs loaded events: two labelled counts folded into one row (no join)."""
    counts = _labelled_counts([("staged", stg_events), ("loaded", fact)], "side", "n")
    label = F.col("side")
    row = counts.agg(F.sum(F.when(label == "staged", F.col("n"))).alias("staging_rows"),
                     F.sum(F.when(label == "loaded", F.col("n"))).alias("analytics_rows"))
    s, a = F.col("staging_rows"), F.col("analytics_rows")
    return row.select(
        F.lit("stream_events").alias("source"),
        s.cast("long").alias("staging_rows"), a.cast("long").alias("analytics_rows"),
        (s - a).cast("long").alias("filtered_out"),
        pct(a, s, 2).alias("pct_loaded"))


def fact_sample(star, n: int = SAMPLE_ROWS) -> DataFrame:
    """Star join of the first ``n`` fact rows (by stream key) with all four dimensions.

    Stream keys are dense from 1, so the first ``n`` keys are normally 1..n: a
    pushed-down ``stream_key <= n`` filter lets Parquet skip nearly all row
    groups. If that yields fewer than ``n`` rows (a gap left by a failed load,
    or a smaller fact), the full top-``n`` is taken instead.
    """
    fact = star.fact_streams
    bounded = fact.where(F.col("stream_key") <= n)
    source = bounded if bounded.count() >= n else fact
    first = source.orderBy("stream_key").limit(n)
    users = star.dim_users.select("user_key", "subscription_type")
    songs = star.dim_songs.select("song_key", F.col("title").alias("song_title"), "genre")
    artists = star.dim_artists.select("artist_key", F.col("name").alias("artist_name"))
    dates = star.dim_date.select("date_key", "day_name", "week_number")
    # n rows on the fact side: the dimension rows they need are at most n.
    j = (first.join(users, "user_key").join(songs, "song_key")
         .join(artists, "artist_key").join(F.broadcast(dates), "date_key"))
    return j.select("stream_key", "subscription_type", "artist_name", "song_title", "genre",
                    "was_skipped", "completion_pct", "platform", "country_code", "day_name",
                    F.col("week_number").cast("int").alias("week_number")).orderBy("stream_key")


def completion_bucket(pct_col: Column) -> Column:
    expr = None
    for edge, label in COMPLETION_BUCKETS:
        if edge is None:
            expr = expr.otherwise(F.lit(label))
        elif expr is None:
            expr = F.when(pct_col < edge, F.lit(label))
        else:
            expr = expr.when(pct_col < edge, F.lit(label))
    return expr


def completion_distribution(fact: DataFrame) -> DataFrame:
    buckets = fact.groupBy(completion_bucket(F.col("completion_pct")).alias("completion_bucket")).agg(
        F.count(F.lit(1)).cast("long").alias("plays"))
    # At most five groups: the share-of-total window runs on five rows.
    total = F.sum("plays").over(Window.partitionBy())
    return (buckets.select("completion_bucket", "plays", pct(F.col("plays"), total, 1).alias("pct_of_total"))
            .orderBy("completion_bucket"))


def genre_skip_preview(star) -> DataFrame:
    fact = star.fact_streams.select("song_key", "was_skipped",
                                    decimal_to_bp("completion_pct").alias("bp"))
    songs = star.dim_songs.select("song_key", "genre")
    rows = fact.select("song_key", F.lit(1).alias("plays"),
                       F.col("was_skipped").cast("int").alias("skips"), "bp")
    if not fits_broadcast(songs):
        # One row per song before the shuffle join.
        rows = rows.groupBy("song_key").agg(F.sum("plays").alias("plays"),
                                            F.sum("skips").alias("skips"), F.sum("bp").alias("bp"))
    g = lookup_join(rows, songs, "song_key").groupBy("genre").agg(
        F.sum("plays").alias("total_plays"),
        F.sum("skips").alias("skips"),
        F.sum("bp").alias("sum_bp"))
    return g.select("genre", F.col("total_plays").cast("long").alias("total_plays"),
                    F.col("skips").cast("long").alias("skips"),
                    pct(F.col("skips"), F.col("total_plays"), 2).alias("skip_rate_pct"),
                    half_up(F.col("sum_bp"), F.col("total_plays") * 100, 1).alias("avg_completion_pct")
                    ).orderBy(F.col("skip_rate_pct").desc_nulls_last(), F.col("genre").asc_nulls_last())


# ---- integrity and contracts -------------------------------------------------

FOREIGN_KEYS = (
    ("fact_streams", "user_key", "dim_users"),
    ("fact_streams", "song_key", "dim_songs"),
    ("fact_streams", "artist_key", "dim_artists"),
    ("fact_streams", "date_key", "dim_date"),
    ("dim_songs", "artist_key", "dim_artists"),
)


def fk_audit(star) -> DataFrame:
    """Per foreign key: rows whose key has no parent row (NULL counts as missing)."""
    out = None
    for child, col, parent in FOREIGN_KEYS:
        missing = count_missing(star.table(child), star.table(parent), col)
        one = missing.select(
            F.lit(child).alias("table_name"), F.lit(col).alias("column_name"),
            F.lit(parent).alias("parent_table"), F.col("missing").alias("violations"))
        out = one if out is None else out.unionByName(one)
    return out.orderBy("table_name", "column_name")


def contract_report(df: DataFrame, table: str, rules: Iterable[tuple[str, str, Column]]) -> DataFrame:
    """One aggregate pass: ``(table, column, rule, violations, rows_checked)`` per rule.

    ``rules`` holds ``(column, rule_name, failing_condition)``; a NULL condition
    does not count as a failure.
    """
    rules = list(rules)
    aggs = [F.count_if(F.coalesce(cond, F.lit(False))).cast("long").alias(f"_r{i}")
            for i, (_, _, cond) in enumerate(rules)]
    counts = df.agg(F.count(F.lit(1)).cast("long").alias("_rows"), *aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"),
                 F.col(f"_r{i}").alias("violations"))
        for i, (c, r, _) in enumerate(rules)])).alias("x")
    return counts.select(F.col("_rows").alias("rows_checked"), stacked).select(
        F.lit(table).alias("table_name"), "x.column_name", "x.rule", "x.violations", "rows_checked")


def _not_null_and_length_rules(table: str) -> list[tuple[str, str, Column]]:
    rules = [(c, "not_null", F.col(c).isNull()) for c in schemas.REQUIRED[table]]
    for c, n in schemas.LENGTH_CONTRACT[table].items():
        rules.append((c, f"max_length_{n}", F.length(F.col(c)) > n))
    return rules


def not_null_audit(staging) -> DataFrame:
    """NOT NULL on required fields and declared VARCHAR/CHAR lengths, per staging table."""
    out = None
    for name in ("stg_artists", "stg_songs", "stg_users", "stg_stream_events"):
        one = contract_report(staging.table(name), name, _not_null_and_length_rules(name))
        out = one if out is None else out.unionByName(one)
    return out.orderBy("table_name", "column_name", "rule")


def contract_rules(table: str) -> list[tuple[str, str, Column]]:
    """Column-level contracts of each staging table (the analytics load's rules)."""
    c = F.col
    lt = lambda x: F.lower(F.trim(c(x)))
    rules = {
        "stg_artists": [
            ("artist_id", "not_null", c("artist_id").isNull()),
            ("name", "not_null", c("name").isNull()),
            ("name", "not_blank", F.trim(c("name")) == ""),
        ],
        "stg_songs": [
            ("song_id", "not_null", c("song_id").isNull()),
            ("title", "not_null", c("title").isNull()),
            ("artist_id", "not_null", c("artist_id").isNull()),
            ("duration_ms", "over_10s",
             c("duration_ms").isNull() | (c("duration_ms") <= MIN_SONG_DURATION_MS)),
            ("is_explicit", "not_null", c("is_explicit").isNull()),
        ],
        "stg_users": [
            ("user_id", "not_null", c("user_id").isNull()),
            ("subscription_type", "in_domain",
             ~F.coalesce(lt("subscription_type").isin(*SUBSCRIPTION_TYPES), F.lit(False))),
            ("is_active", "not_null", c("is_active").isNull()),
        ],
        "stg_stream_events": [
            ("event_id", "not_null", c("event_id").isNull()),
            ("listened_at", "not_null", c("listened_at").isNull()),
            ("duration_ms", "non_negative", c("duration_ms").isNull() | (c("duration_ms") < 0)),
            ("duration_ms", "within_song_plus_5s",
             c("duration_ms").cast("long") > c("song_duration_ms").cast("long") + PLAY_OVERRUN_MS),
            ("song_duration_ms", "not_null", c("song_duration_ms").isNull()),
            ("platform", "in_domain", ~F.coalesce(lt("platform").isin(*PLATFORMS), F.lit(False))),
        ],
    }
    return rules[table]


def quality_contracts(staging) -> DataFrame:
    out = None
    for name in ("stg_artists", "stg_songs", "stg_users", "stg_stream_events"):
        one = contract_report(staging.table(name), name, contract_rules(name))
        out = one if out is None else out.unionByName(one)
    return out.orderBy("table_name", "column_name", "rule")


def assert_no_pii(star, pii_columns: Sequence[str] = ("email",)) -> None:
    """Raise if any analytics table carries a personal-data column."""
    for name in star._fields:
        leaked = set(star.table(name).columns) & set(pii_columns)
        if leaked:
            raise AssertionError(f"{name} carries personal data: {sorted(leaked)}")
