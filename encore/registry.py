"""Named queries over the driver tables, with their DuckDB reference SQL.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``SQL[name]()`` returns
the equivalent DuckDB SQL over the raw driver tables. Both sides alias every
computed column identically.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .operators import quality, report
from .operators.keys import assign_dense_keys, insert_if_absent
from .operators import id_index
from .plans import loads
from .plans.publish import CREATED_AT, ConstraintViolation, hadoop_fs, read_or_none
from .plans.warehouse import driver_staging_tables, driver_star, driver_warehouse, write_star
from .schemas import FACT_COLUMNS, STAR
from .session import scratch_path
from .sources.json_array import write_json_array
from .sources.json_source import SOURCE_SCHEMAS, land_staging, landing_report
from .sources.staging import Staging

AS_OF = O.AS_OF
Q4_WINDOW_DAYS = O.Q4_WINDOW_DAYS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, Callable[[], str]] = {}


def register(name: str, sql: Callable[[], str] | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


# ---- staging ------------------------------------------------------------------

_STG_COLS = {
    "stg_artists": "artist_id, name, country, primary_genre, monthly_listeners",
    "stg_songs": "song_id, title, artist_id, album_id, genre, subgenre, duration_ms, release_date, is_explicit",
    "stg_users": "user_id, email, country_code, subscription_type, age_group, signup_date, is_active",
    "stg_stream_events": ("event_id, user_id, song_id, listened_at, duration_ms, song_duration_ms, "
                          "was_skipped, skip_at_ms, platform, country_code"),
}


def _stg_query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return driver_staging_tables(spark, sf_dir).table(name)
    return run


for _name, _cols in _STG_COLS.items():
    register(_name, (lambda n=_name, c=_cols: O.with_prelude(f"SELECT {c} FROM {n}", star=False)))(
        _stg_query(_name))


# ---- star schema ----------------------------------------------------------------

_STAR_SQL = {
    "dim_date": "SELECT * FROM dim_date",
    "dim_artists": "SELECT * FROM dim_artists",
    "dim_users": "SELECT * FROM dim_users",
    "dim_songs": "SELECT * FROM dim_songs",
    "fact_streams": "SELECT * FROM fact_streams",
}


def _star_query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return driver_star(spark, sf_dir).table(name)
    return run


for _name, _sql in _STAR_SQL.items():
    register(_name, (lambda s=_sql: O.with_prelude(s)))(_star_query(_name))


# ---- report --------------------------------------------------------------------

@register("trending_songs", lambda: O.trending_songs_sql())
def q_trending_songs(spark, sf_dir):
    return report.trending_songs(driver_star(spark, sf_dir), AS_OF, days=7, k=10)


@register("genre_skip_rates", O.genre_skip_rates_sql)
def q_genre_skip_rates(spark, sf_dir):
    return report.genre_skip_rates(driver_star(spark, sf_dir))


@register("free_vs_premium", O.free_vs_premium_sql)
def q_free_vs_premium(spark, sf_dir):
    return report.free_vs_premium(driver_star(spark, sf_dir))


@register("user_stats", O.user_stats_sql)
def q_user_stats(spark, sf_dir):
    return report.user_stats_report(driver_star(spark, sf_dir))


@register("platform_rank", O.platform_rank_sql)
def q_platform_rank(spark, sf_dir):
    return report.platform_rank(driver_star(spark, sf_dir))


@register("peak_hour", O.peak_hour_sql)
def q_peak_hour(spark, sf_dir):
    return report.peak_hour(driver_star(spark, sf_dir))


@register("breakout_artists", lambda: O.breakout_artists_sql())
def q_breakout_artists(spark, sf_dir):
    return report.breakout_artists(driver_star(spark, sf_dir), AS_OF, window_days=Q4_WINDOW_DAYS)


@register("date_windows", lambda: O.window_plays_sql())
def q_date_windows(spark, sf_dir):
    """Plays and covered days of each labelled window."""
    star = driver_star(spark, sf_dir)
    windows = report.date_windows(star, AS_OF, Q4_WINDOW_DAYS)
    return (report.fact_in_window(star, AS_OF, 2 * Q4_WINDOW_DAYS).join(F.broadcast(windows), "date_key")
            .groupBy("window_label").agg(F.count(F.lit(1)).alias("plays"), F.count_distinct("date_key").alias("days")))


@register("regional_listeners", lambda: O.regional_listeners_sql())
def q_regional_listeners(spark, sf_dir):
    return report.regional_listeners(driver_star(spark, sf_dir), AS_OF, Q4_WINDOW_DAYS)


@register("breakout_pivot", lambda: O.breakout_pivot_sql())
def q_breakout_pivot(spark, sf_dir):
    return report.breakout_pivot(driver_star(spark, sf_dir), AS_OF, Q4_WINDOW_DAYS)


@register("global_listeners", lambda: O.global_listeners_sql())
def q_global_listeners(spark, sf_dir):
    return report.global_listeners(driver_star(spark, sf_dir), AS_OF, Q4_WINDOW_DAYS)


# ---- audits ----------------------------------------------------------------------


@register("row_counts_staging", O.row_counts_staging_sql)
def q_row_counts_staging(spark, sf_dir):
    return quality.row_counts_staging(driver_staging_tables(spark, sf_dir))


@register("dim_date_range", O.dim_date_range_sql)
def q_dim_date_range(spark, sf_dir):
    """The calendar days that plays cover."""
    star = driver_star(spark, sf_dir)
    covered = F.broadcast(star.fact_streams.select("date_key").distinct())
    return quality.dim_date_range(star.dim_date.join(covered, "date_key", "left_semi"))


@register("null_event_ids", O.null_event_ids_sql)
def q_null_event_ids(spark, sf_dir):
    return quality.null_event_ids(driver_staging_tables(spark, sf_dir).events)


@register("orphan_song_ids", O.orphan_song_ids_sql)
def q_orphan_song_ids(spark, sf_dir):
    stg = driver_staging_tables(spark, sf_dir)
    return quality.orphan_song_ids(stg.events, stg.songs)


@register("staging_skip_rate", O.staging_skip_rate_sql)
def q_staging_skip_rate(spark, sf_dir):
    stg = driver_staging_tables(spark, sf_dir)
    return quality.staging_skip_rate(stg.events, stg.users)


@register("row_counts_analytics", O.row_counts_analytics_sql)
def q_row_counts_analytics(spark, sf_dir):
    return quality.row_counts_analytics(driver_star(spark, sf_dir))


@register("load_reconciliation", O.load_reconciliation_sql)
def q_load_reconciliation(spark, sf_dir):
    stg = driver_staging_tables(spark, sf_dir)
    return quality.load_reconciliation(stg.events, driver_star(spark, sf_dir).fact_streams)


@register("fact_sample", O.fact_sample_sql)
def q_fact_sample(spark, sf_dir):
    return quality.fact_sample(driver_star(spark, sf_dir))


@register("completion_distribution", O.completion_distribution_sql)
def q_completion_distribution(spark, sf_dir):
    return quality.completion_distribution(driver_star(spark, sf_dir).fact_streams)


@register("genre_skip_preview", O.genre_skip_preview_sql)
def q_genre_skip_preview(spark, sf_dir):
    return quality.genre_skip_preview(driver_star(spark, sf_dir))


@register("fk_audit", O.fk_audit_sql)
def q_fk_audit(spark, sf_dir):
    return quality.fk_audit(driver_star(spark, sf_dir))


@register("not_null_audit", O.not_null_audit_sql)
def q_not_null_audit(spark, sf_dir):
    return quality.not_null_audit(driver_staging_tables(spark, sf_dir))


@register("quality_contracts", O.quality_contracts_sql)
def q_quality_contracts(spark, sf_dir):
    return quality.quality_contracts(driver_staging_tables(spark, sf_dir))


# ---- loads, keys, streaming ----------------------------------------------------------


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_COLS = [c.strip() for c in O.LINE_COLS.split(",")]


@register("ingest_json", O.ingest_json_sql)
def q_ingest_json(spark, sf_dir):
    return landing_report(spark, driver_warehouse(spark, sf_dir))


@register("full_refresh", O.full_refresh_sql)
def q_full_refresh(spark, sf_dir):
    events = driver_staging_tables(spark, sf_dir).events
    table = scratch_path(spark, "stg_stream_events")
    loads.full_refresh(events, table)
    loads.full_refresh(events, table)   # a second full load replaces, never adds
    return loads.read_current(spark, table)


def _lineitem(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").select(*LINE_COLS)


@register("insert_if_absent", O.insert_if_absent_sql)
def q_insert_if_absent(spark, sf_dir):
    lines = _lineitem(spark, sf_dir)
    table = scratch_path(spark, "lines")
    early = lines.where(F.col("l_shipdate") < F.lit(O.FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    insert_if_absent(early, None, LINE_KEY, "line_key").write.parquet(table)
    added = insert_if_absent(lines, spark.read.parquet(table), LINE_KEY, "line_key")
    added.write.mode("append").parquet(table)
    return spark.read.parquet(table)


@register("surrogate_keys", O.surrogate_keys_sql)
def q_surrogate_keys(spark, sf_dir):
    keys = _lineitem(spark, sf_dir).select(*LINE_KEY).distinct()
    return assign_dense_keys(keys, LINE_KEY, "line_key")


INCREMENTAL_CUT = _dt.datetime(2024, 1, 16)


def _stamp(day: int) -> _dt.datetime:
    return _dt.datetime(2024, 2, day, 1, 0, tzinfo=_dt.timezone.utc)


def _only(stg: Staging, *tables: str) -> Staging:
    """``stg`` with the rows of ``tables`` only; the others empty."""
    return Staging(*[stg.table(n) if n in tables else stg.table(n).where(F.lit(False)) for n in loads.STAGING_TABLES])


def _events_before(stg: Staging) -> DataFrame:
    return stg.events.where(F.col("listened_at") < F.lit(INCREMENTAL_CUT).cast("timestamp"))


@register("incremental_load", O.incremental_load_sql)
def q_incremental_load(spark, sf_dir):
    stg = driver_staging_tables(spark, sf_dir)
    root = scratch_path(spark, "incremental")
    loads.land(stg._replace(events=_events_before(stg)), f"{root}/staging", _stamp(1))
    loads.incremental_load(spark, f"{root}/staging", f"{root}/warehouse")
    # The next batch re-sends everything, stamped earlier: only the unseen events are added.
    loads.land(stg, f"{root}/staging", _dt.datetime(2024, 1, 2, tzinfo=_dt.timezone.utc))
    return loads.incremental_load(spark, f"{root}/staging", f"{root}/warehouse").fact_streams


_FACT_WITHOUT_KEYS = ["event_id", "date_key", "listened_at", "duration_ms", "song_duration_ms", "was_skipped",
                      "completion_pct", "platform", "country_code"]


def _by_natural_key(star) -> DataFrame:
    """The fact with natural keys: surrogate keys follow the order of arrival."""
    return (star.fact_streams.join(star.dim_users.select("user_key", "user_id"), "user_key")
            .join(star.dim_songs.select("song_key", "song_id"), "song_key").select(*_FACT_WITHOUT_KEYS, "user_id", "song_id"))


@register("incremental_late_dims", O.fact_by_natural_key_sql)
def q_incremental_late_dims(spark, sf_dir):
    """A third of the users arrive with the sixth load; their events were landed with the first."""
    stg = driver_staging_tables(spark, sf_dir)
    root = scratch_path(spark, "late-dims")
    late = F.pmod(F.col("user_id").cast("long"), F.lit(3)) == 0
    loads.land(stg._replace(users=stg.users.where(~late)), f"{root}/staging", _stamp(1))
    loads.incremental_load(spark, f"{root}/staging", f"{root}/warehouse")
    for day in range(2, 6):
        loads.land(_only(stg, "stg_artists"), f"{root}/staging", _stamp(day))
        loads.incremental_load(spark, f"{root}/staging", f"{root}/warehouse")
    loads.land(_only(stg._replace(users=stg.users.where(late)), "stg_users"), f"{root}/staging", _stamp(6))
    return _by_natural_key(loads.incremental_load(spark, f"{root}/staging", f"{root}/warehouse"))


@register("incremental_dims_first", O.incremental_load_sql)
def q_incremental_dims_first(spark, sf_dir):
    stg = driver_staging_tables(spark, sf_dir)
    root = scratch_path(spark, "dims-first")
    loads.land(_only(stg, "stg_artists", "stg_songs", "stg_users"), f"{root}/staging", _stamp(1))
    loads.incremental_load(spark, f"{root}/staging", f"{root}/warehouse")
    loads.land(_only(stg, "stg_stream_events"), f"{root}/staging", _stamp(2))
    return loads.incremental_load(spark, f"{root}/staging", f"{root}/warehouse").fact_streams


@register("incremental_after_failure", O.incremental_load_sql)
def q_incremental_after_failure(spark, sf_dir):
    """The first run ends after its dimensions are written; the next one takes the same load again."""
    stg = driver_staging_tables(spark, sf_dir)
    root = scratch_path(spark, "after-failure")
    loads.land(stg, f"{root}/staging", _stamp(1))
    dims = driver_star(spark, sf_dir)
    for name in ("dim_artists", "dim_users", "dim_songs"):
        dims.table(name).write.parquet(f"{root}/warehouse/{name}")
    return loads.incremental_load(spark, f"{root}/staging", f"{root}/warehouse").fact_streams


@register("partitioned_fact", O.partitioned_fact_sql)
def q_partitioned_fact(spark, sf_dir):
    fact = driver_star(spark, sf_dir).fact_streams
    path = scratch_path(spark, "fact-by-month")
    loads.write_fact_by_month(fact, path)
    # Rewrite one month: dynamic overwrite leaves the other months' files alone.
    january = fact.where((F.col("date_key") >= 20240101) & (F.col("date_key") < 20240201))
    loads.write_fact_by_month(january, path)
    return spark.read.parquet(path).select(*FACT_COLUMNS, "year_month")


@register("stream_ingest", O.stream_ingest_sql)
def q_stream_ingest(spark, sf_dir):
    from .streaming.ingest import run_stream_ingest

    root = driver_warehouse(spark, sf_dir)
    out = scratch_path(spark, "streamed")
    run_stream_ingest(spark, f"{root}/sources/stream_events.json", out, dims_root=root,
                      max_files_per_trigger=2)
    return spark.read.parquet(f"{out}/fact_streams").select(*FACT_COLUMNS[1:])


def _stream_dims(spark, sf_dir, dims: str, late=None) -> None:
    star = driver_star(spark, sf_dir)
    for name in ("dim_date", "dim_songs"):
        star.table(name).write.parquet(f"{dims}/{name}")
    users = star.dim_users if late is None else star.dim_users.where(~late)
    users.write.parquet(f"{dims}/dim_users")


@register("stream_ingest_late", O.stream_ingest_sql)
def q_stream_ingest_late(spark, sf_dir):
    """Events in six batches; a third of the users become known only before the last one."""
    from .sources.json_source import write_json_lines
    from .streaming.ingest import run_stream_ingest

    root = scratch_path(spark, "stream-late")
    late = F.pmod(F.col("user_id").cast("long"), F.lit(3)) == 0
    _stream_dims(spark, sf_dir, f"{root}/dims", late)
    events = driver_staging_tables(spark, sf_dir).events
    part = F.pmod(F.xxhash64("event_id"), F.lit(6))
    for i in range(6):
        if i == 5:
            driver_star(spark, sf_dir).dim_users.where(late).write.mode("append").parquet(f"{root}/dims/dim_users")
        write_json_lines(events.where(part == i), f"{root}/source/b{i}")
        run_stream_ingest(spark, f"{root}/source/*", f"{root}/out", dims_root=f"{root}/dims", checkpoint=f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out/fact_streams").select(*FACT_COLUMNS[1:])


@register("stream_ingest_resend", O.stream_ingest_sql)
def q_stream_ingest_resend(spark, sf_dir):
    """All events are sent again with the next day's time: each id is loaded once, as first sent."""
    from .sources.json_source import write_json_lines
    from .streaming.ingest import run_stream_ingest

    root = scratch_path(spark, "stream-resend")
    _stream_dims(spark, sf_dir, f"{root}/dims")
    events = driver_staging_tables(spark, sf_dir).events
    again = events.withColumn("listened_at", F.col("listened_at") + F.expr("INTERVAL 1 DAY"))
    for i, batch in enumerate((events, again)):
        write_json_lines(batch, f"{root}/source/b{i}")
        run_stream_ingest(spark, f"{root}/source/*", f"{root}/out", dims_root=f"{root}/dims", checkpoint=f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out/fact_streams").select(*FACT_COLUMNS[1:])


# ---- loads of several kinds, with planted content ---------------------------------------------


@contextlib.contextmanager
def settings(spark, **values):
    """Session settings while plans are made (``a__b`` stands for ``a.b``)."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Every branch that a size check or a count keeps for large inputs.
LARGE = {"encore__broadcast__limit__bytes": "0", "encore__keys__smallFrameBytes": "0", "encore__dedup__rareMinBytes": "0",
         "encore__keys__rangeRows": "500"}


def _planted_objects(stg: Staging, table: str, bad: tuple[str, str, int], absent: tuple[str, int, int] | None) -> DataFrame:
    """JSON text of a table's records: a bad value in every n-th, a key absent where its id is r modulo m."""
    rows, key = stg.table(table), SOURCE_SCHEMAS[table].fieldNames()[0]
    number = F.col(key).cast("long")
    column, value, every = bad

    def text(names, broken):
        fields = [F.lit(value).alias(n) if n == column and broken else F.col(n) for n in names]
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    def either(names):
        return F.when(F.pmod(number, F.lit(every)) == 0, text(names, True)).otherwise(text(names, False))

    names = SOURCE_SCHEMAS[table].fieldNames()
    if absent is None:
        return rows.select(either(names).alias("value"))
    flag, modulus, rest = absent
    return rows.select(F.when(F.pmod(number, F.lit(modulus)) == rest, either([n for n in names if n != flag]))
                       .otherwise(either(names)).alias("value"))


#: Array sources are read in splits of 64 KB, or larger ones where that would be more than ARRAY_SPLITS of a source.
ARRAY_SPLIT_BYTES, ARRAY_SPLITS = 64 * 1024, 256


def array_split_bytes(spark, paths) -> int:
    """The split size for the sources at ``paths``: a split costs two tasks and a row, whatever its size."""
    sizes = [fs.getContentSummary(p).getLength() for fs, p in (hadoop_fs(spark, path) for path in paths)]
    return max(ARRAY_SPLIT_BYTES, -(-max(sizes) // ARRAY_SPLITS))


@register("ingest_json_array", O.ingest_json_array_sql)
def q_ingest_json_array(spark, sf_dir):
    """Indented arrays, one a partition of the source, read in byte-range splits; bad values, absent flags."""
    stg = driver_staging_tables(spark, sf_dir)
    root = scratch_path(spark, "array-sources")
    planted = {"stg_artists": ("artists", ("monthly_listeners", "many", 25), None, None),
               "stg_songs": ("songs", ("duration_ms", "x", 40), ("is_explicit", 3, 1), "is_explicit"),
               "stg_users": ("users", ("signup_date", "never", 50), ("is_active", 4, 0), "is_active"),
               "stg_stream_events": ("stream_events", ("duration_ms", "1e", 97), ("was_skipped", 5, 0), "was_skipped")}
    for table, (source, bad, absent, _) in planted.items():
        write_json_array(_planted_objects(stg, table, bad, absent), f"{root}/sources/{source}.json")
    split = array_split_bytes(spark, [f"{root}/sources/{source}.json" for source, *_ in planted.values()])
    with settings(spark, spark__sql__files__maxPartitionBytes=str(split), spark__sql__files__openCostInBytes="1k"):
        land_staging(spark, f"{root}/sources", f"{root}/staging", layout="array")
    out = None
    for table, (source, _, _, flag) in planted.items():
        rows = spark.read.parquet(f"{root}/staging/{table}")
        ok, value = F.col("_load_status") == "accepted", F.col(flag) if flag else F.lit(None).cast("boolean")
        one = rows.agg(F.count(F.lit(1)).alias("records"), F.count_if(~ok).alias("rejected"),
                       F.count_if(ok & F.coalesce(value, F.lit(False))).alias("flag_true"),
                       F.count_if(ok & value.isNull()).alias("flag_null")).select(F.lit(f"{source}.json").alias("source_file"), "*")
        out = one if out is None else out.unionByName(one)
    return out


class _Killed(Exception):
    pass


KILLED_AT = ("dim_users", "fact", "pending", "marker", "move")


@register("incremental_killed_anywhere", O.fact_by_natural_key_sql)
def q_incremental_killed(spark, sf_dir):
    """Five loads, a third of the users in the last; every run is killed at another write and made again by the next."""
    stg = driver_staging_tables(spark, sf_dir)
    root = scratch_path(spark, "killed")
    late = F.pmod(F.col("user_id").cast("long"), F.lit(3)) == 0
    part = F.pmod(F.xxhash64("event_id"), F.lit(len(KILLED_AT)))
    for i, step in enumerate(KILLED_AT):
        last = i == len(KILLED_AT) - 1
        batch = stg._replace(users=stg.users.where(late if last else ~late), events=stg.events.where(part == i))
        loads.land(batch, f"{root}/staging", _stamp(1 + i))

        def kill(at, step=step):
            if at == step:
                raise _Killed(at)

        with contextlib.suppress(_Killed):
            loads.incremental_load(spark, f"{root}/staging", f"{root}/warehouse", on_step=kill)
    return _by_natural_key(loads.incremental_load(spark, f"{root}/staging", f"{root}/warehouse"))


@register("constraint_refusal", O.constraint_refusal_sql)
def q_constraint_refusal(spark, sf_dir):
    """Four appends of keyed rows; the two with planted violations are refused as a whole."""
    star = driver_star(spark, sf_dir)
    root = scratch_path(spark, "refusal")
    write_star(star._replace(fact_streams=star.fact_streams.where(F.lit(False))), root)
    first = F.col("user_key") % 2 == 0
    every = lambda n: F.pmod(F.col("event_id").cast("long"), F.lit(n)) == 0
    plus = lambda c, n: F.when(every(n), F.col(c) + 1_000_000_000).otherwise(F.col(c))
    clean = star.fact_streams.where(first)
    rest = star.fact_streams.where(~first).withColumn("stream_key", F.col("stream_key") + 1_000_000_000)
    batches = {"clean": clean, "orphans": rest.withColumns({"user_key": plus("user_key", 5), "song_key": plus("song_key", 7)}),
               "nulls": rest.withColumn("song_key", F.when(~every(3), F.col("song_key"))), "rest": rest}
    report = []
    for name, rows in batches.items():
        counts = {}
        try:
            loads.append_fact(spark, root, rows)
        except ConstraintViolation as refused:
            counts = refused.counts
        report.append((name, not counts, counts.get("orphan_user_key", 0), counts.get("orphan_song_key", 0), counts.get("null_song_key", 0),
                       read_or_none(spark, f"{root}/fact_streams", STAR["fact_streams"]).count()))
    return spark.createDataFrame(report, "load string, published boolean, orphan_users long, orphan_songs long, null_songs long, fact_rows long")


@register("planted_audit", O.planted_audit_sql)
def q_planted_audit(spark, sf_dir):
    """Foreign-key and NULL-id audits over rows with planted orphans and NULLs."""
    star = driver_star(spark, sf_dir)
    every = lambda n: F.pmod(F.col("event_id").cast("long"), F.lit(n)) == 0
    broken = star.fact_streams.withColumns({
        "user_key": F.when(every(50), F.col("user_key") + 1_000_000_000).otherwise(F.col("user_key")),
        "song_key": F.when(~every(30), F.col("song_key")),
        "artist_key": F.when(every(70), -F.col("artist_key")).otherwise(F.col("artist_key")),
        "date_key": F.when(every(90), F.lit(19991231)).otherwise(F.col("date_key"))})
    events = driver_staging_tables(spark, sf_dir).events
    nulls = quality.null_event_ids(events.withColumn("event_id", F.when(~every(11), F.col("event_id"))))
    return quality.fk_audit(star._replace(fact_streams=broken)).unionByName(nulls.select(
        F.lit("stg_stream_events").alias("table_name"), F.lit("event_id").alias("column_name"),
        F.lit(None).cast("string").alias("parent_table"), F.col("null_event_ids").alias("violations")))


@register("partitioned_fact_months", O.months_fact_sql)
def q_partitioned_fact_months(spark, sf_dir):
    """Plays spread over four months; one month is written again and the others' files stay."""
    fact = driver_star(spark, sf_dir).fact_streams
    shift = F.pmod(F.col("event_id").cast("long"), F.lit(4)).cast("int") * 31
    day = F.date_add(F.col("listened_at").cast("date"), shift)
    spread = fact.select("event_id", "user_key", "song_key", "duration_ms", "was_skipped",
                         F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"))
    path = scratch_path(spark, "fact-months")
    loads.write_fact_by_month(spread, path)
    february = (F.col("date_key") >= 20240201) & (F.col("date_key") < 20240301)
    loads.write_fact_by_month(spread.where(february & ~F.col("was_skipped")), path)
    return spark.read.parquet(path).select("year_month", "date_key", "event_id", "user_key", "song_key", "duration_ms", "was_skipped")


@register("weekly_report", O.weekly_report_sql)
def q_weekly_report(spark, sf_dir):
    """The written report read back: each table's rows in their printed order."""
    paths = report.write_weekly_report(driver_star(spark, sf_dir), scratch_path(spark, "weekly"), AS_OF, Q4_WINDOW_DAYS)
    leading = {"trending_songs": ("song", "unique_listeners"), "genre_skip_rates": ("genre", "overall_skip_rate_pct"),
               "free_vs_premium": ("subscription_type", "total_users"), "breakout_artists": ("artist", "breakout_score")}
    out = None
    for name, path in paths.items():
        label, measure = leading[name]
        # one file a table: its row order is the printed one
        rows = spark.read.parquet(path).select(F.monotonically_increasing_id().alias("at"), label, measure)
        one = rows.select(F.lit(name).alias("report"), (F.col("at") + 1).alias("place"), F.col(label).alias("label"),
                          F.col(measure).cast("double").alias("measure"))
        out = one if out is None else out.unionByName(one)
    return out


@register("calendar_plays", O.calendar_plays_sql)
def q_calendar_plays(spark, sf_dir):
    """Plays by calendar day, over a warehouse written twice: the calendar is populated once and stays."""
    star = driver_star(spark, sf_dir)
    root = scratch_path(spark, "calendar")
    write_star(star, root)
    write_star(star._replace(dim_date=star.dim_date.where(F.lit(False))), root)   # would leave no day if written
    again = loads.read_star(spark, root)
    return (again.fact_streams.groupBy("date_key").agg(F.count(F.lit(1)).alias("plays"))
            .join(F.broadcast(again.dim_date), "date_key")   # a row a day
            .select("full_date", "month_name", "day_name", "week_number", "is_weekend", "plays"))


@register("load_stamps", O.load_stamps_sql)
def q_load_stamps(spark, sf_dir):
    """Rows and stamped rows of every landed and built table."""
    root = driver_warehouse(spark, sf_dir)
    out = None
    for name, stamp in [(n, "loaded_at") for n in loads.STAGING_TABLES] + [(n, CREATED_AT) for n in ("dim_artists", "dim_users", "dim_songs", "fact_streams")]:
        one = spark.read.parquet(f"{root}/{name}").agg(
            F.count(F.lit(1)).alias("rows"), F.count(stamp).alias("stamped"),
            # written by one load: all stamps lie within a day
            F.when(F.max(stamp) - F.min(stamp) < F.expr("INTERVAL 1 DAY"), 1).otherwise(2).cast("long").alias("load_days"))
        one = one.select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@register("id_index_lookup", O.id_index_sql)
def q_id_index_lookup(spark, sf_dir):
    """Which of a small batch's event ids are loaded: asked of the touched buckets of the id index."""
    star = driver_star(spark, sf_dir)
    root = scratch_path(spark, "id-index")
    loaded = star.fact_streams.where(F.col("listened_at") < F.lit(INCREMENTAL_CUT).cast("timestamp"))
    id_index.index_rows(loaded, "event_id").write.partitionBy(id_index.BUCKET).parquet(root)
    batch = (star.fact_streams.where(F.pmod(F.col("event_id").cast("long"), F.lit(500)) == 0).select("event_id")
             .unionByName(spark.createDataFrame([("never",)], "event_id string")))
    return id_index.known_ids(spark, root, batch, "event_id", id_index.touched_buckets(batch, "event_id"))


# ---- the branches for large inputs ------------------------------------------------------------


def _large(name: str, build):
    """``name`` with every size switch set against the small branch while its plan is made."""
    def run(spark, sf_dir):
        driver_warehouse(spark, sf_dir)
        with settings(spark, **LARGE):
            return build(spark, sf_dir)
    register(f"{name}_large", SQL[name])(run)


def _rebuilt_fact(spark, sf_dir):
    from .operators.fact import build_fact_streams

    star = driver_star(spark, sf_dir)
    return build_fact_streams(driver_staging_tables(spark, sf_dir).events, star.dim_users, star.dim_songs, star.dim_date)


for _name, _build in {"fact_streams": _rebuilt_fact, "surrogate_keys": q_surrogate_keys, "insert_if_absent": q_insert_if_absent,
                      "trending_songs": q_trending_songs, "genre_skip_rates": q_genre_skip_rates,
                      "free_vs_premium": q_free_vs_premium, "breakout_artists": q_breakout_artists}.items():
    _large(_name, _build)
