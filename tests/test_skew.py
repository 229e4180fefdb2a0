"""Hot keys: a third of all plays on one user, one song and one duplicated event id.

The shuffle-join paths (forced by a zero broadcast limit) split the hot keys off
and must give exactly the broadcast results.
"""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import artist, event, song, user

from encore.operators import quality, report
from encore.operators.joins import hot_keys
from encore.plans.warehouse import build_star

AS_OF = "2024-01-31"


def _events(n: int = 900):
    rows = []
    for i in range(n):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=i % 30)
        at = f"{day.isoformat()}T{i % 24:02d}:00:00+00:00"
        if i % 3 == 0:      # the hot listener
            rows.append(event(f"e{i:04d}", "u0", f"s{i % 7}", at, skipped=i % 5 == 0))
        elif i % 3 == 1:    # the hot song
            rows.append(event(f"e{i:04d}", f"u{i % 40}", "s0", at, skipped=i % 4 == 0,
                              platform="web"))
        else:               # copies of one event id
            rows.append(event("dup", f"u{i % 40}", f"s{i % 7}", at, duration_ms=1000 + i))
    return rows


@pytest.fixture(scope="module")
def skewed(spark):
    from encore.sources.staging import from_frames
    return from_frames(
        spark,
        artists=[artist(f"a{i}", f"Artist{i}") for i in range(3)],
        songs=[song(f"s{i}", artist_id=f"a{i % 3}", title=f"T{i}", genre=f"g{i % 2}") for i in range(7)],
        users=[user(f"u{i}", "free" if i % 2 else "premium") for i in range(40)],
        events=_events())


def _collect(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_hot_keys_are_found(spark, skewed):
    assert "u0" in hot_keys(skewed.events, "user_id", hot_share=0.2, sample_fraction=1.0)
    assert "s0" in hot_keys(skewed.events, "song_id", hot_share=0.2, sample_fraction=1.0)


def test_shuffle_paths_equal_broadcast_paths(spark, skewed):
    star = build_star(spark, skewed)
    dup = [r for r in star.fact_streams.collect() if r.event_id == "dup"]
    assert len(dup) == 1          # one row per event id, chosen by a total order
    expected = {
        "q1": _collect(report.trending_songs(star, AS_OF, days=30)),
        "q2": _collect(report.genre_skip_rates(star)),
        "q3": _collect(report.free_vs_premium(star)),
        "q4": _collect(report.regional_listeners(star, AS_OF, 15)),
        "fk": _collect(quality.fk_audit(star)),
    }
    spark.conf.set("encore.broadcast.limit.bytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        forced = build_star(spark, skewed)
        assert _collect(forced.fact_streams) == _collect(star.fact_streams)
        got = {
            "q1": _collect(report.trending_songs(forced, AS_OF, days=30)),
            "q2": _collect(report.genre_skip_rates(forced)),
            "q3": _collect(report.free_vs_premium(forced)),
            "q4": _collect(report.regional_listeners(forced, AS_OF, 15)),
            "fk": _collect(quality.fk_audit(forced)),
        }
        assert got == expected
    finally:
        spark.conf.unset("encore.broadcast.limit.bytes")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_large_input_paths_give_the_same_star(spark, skewed):
    """Range-partitioned keys, narrow-count dedup and shuffle joins: same star as small paths."""
    small = build_star(spark, skewed)
    expected = {n: _collect(small.table(n)) for n in ("dim_artists", "dim_users", "dim_songs", "fact_streams")}
    spark.conf.set("encore.keys.smallFrameBytes", "0")
    spark.conf.set("encore.broadcast.limit.bytes", "0")
    spark.conf.set("encore.dedup.rareMinBytes", "0")
    try:
        large = build_star(spark, skewed)
        for name, rows in expected.items():
            assert _collect(large.table(name)) == rows, name
    finally:
        spark.conf.unset("encore.keys.smallFrameBytes")
        spark.conf.unset("encore.broadcast.limit.bytes")
        spark.conf.unset("encore.dedup.rareMinBytes")


def test_hot_users_of_the_driver_events_are_counted_on_the_scan(spark, tmp_path, monkeypatch):
    """Not on the frame joined with the songs, which would be made once more for the count."""
    from encore.operators import joins
    from encore.sources import driver_tables

    schemas = {"events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
               "part": "p_partkey long, p_size int", "nation": "n_nationkey int, n_name string, n_regionkey int", "region": "r_regionkey int, r_name string",
               "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"}
    for name, schema in schemas.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    asked = []

    def seen(fact, key, *args):
        asked.append((key, "Join" in fact._jdf.queryExecution().optimizedPlan().toString()))
        return []

    monkeypatch.setattr(joins, "hot_keys", seen)
    spark.conf.set("encore.broadcast.limit.bytes", "0")
    try:
        driver_tables.stg_stream_events(spark, str(tmp_path))
    finally:
        spark.conf.unset("encore.broadcast.limit.bytes")
    assert asked == [("song_id", False), ("user_id", False)]
