"""Dimension and fact builds on hand-written staging rows (every cleaning branch)."""

from __future__ import annotations

from decimal import Decimal

from conftest import artist, event, song, user

from encore.operators.dates import dim_date
from encore.operators.dimensions import build_dim_artists, build_dim_songs, build_dim_users
from encore.operators.fact import build_fact_streams
from encore.plans.warehouse import build_star


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_dim_date(spark):
    d = dim_date(spark)
    assert d.count() == 2922
    r = d.where("date_key = 20210101").collect()[0]
    assert (r.year, r.quarter, r.month, r.month_name, r.week_number, r.day_of_week, r.day_name,
            r.is_weekend) == (2021, 1, 1, "January", 53, 5, "Friday", False)
    r = d.where("date_key = 20240107").collect()[0]
    assert (r.day_of_week, r.day_name, r.is_weekend) == (7, "Sunday", True)


def test_artists_cleaning_and_dedup(make_staging):
    stg = make_staging(artists=[
        artist("a1", "  A  ", " us", " Pop "),
        artist("a2", "B", "gb", ""),
        artist("a3", "C1", "br", "rock"),
        artist("a3", "C0", "br", "rock"),
        artist(None, "Nobody", "us", "pop"),
    ])
    dim = build_dim_artists(stg.artists)
    assert _rows(dim, "artist_key", "artist_id", "name", "country", "primary_genre") == [
        (1, "a1", "A", "US", "pop"),
        (2, "a2", "B", "GB", ""),         # no NULLIF on genre
        (3, "a3", "C0", "BR", "rock"),    # one row per artist id
    ]


def test_users_cleaning_active_and_pii(make_staging):
    stg = make_staging(users=[
        user("u1", " Premium "), user("u2", "FREE"), user("u3", "trial"), user("u4", ""),
        user("u5", None), user("u6", "free", active=False), user("u7", "free", active=None),
    ])
    dim = build_dim_users(stg.users)
    assert "email" not in dim.columns
    assert _rows(dim, "user_id", "subscription_type") == [
        ("u1", "premium"), ("u2", "free"), ("u3", "unknown"), ("u4", "unknown"), ("u5", "unknown")]


def test_songs_filters_and_cleaning(make_staging):
    stg = make_staging(
        artists=[artist("a1")],
        songs=[
            song("s1", duration_ms=9_999), song("s2", duration_ms=10_000),
            song("s3", duration_ms=10_001, subgenre="", title=" T "),
            song("s4", duration_ms=None),
            song("s5", artist_id="zz"),
            song("s6", subgenre="  ", explicit=True),
            song("s7", subgenre=" Rock", genre=" Indie "),
        ])
    artists = build_dim_artists(stg.artists)
    dim = build_dim_songs(stg.songs, artists)
    assert _rows(dim, "song_id", "title", "genre", "subgenre", "is_explicit") == [
        ("s3", "T", "pop", None, False),
        ("s6", "Song", "pop", "", True),
        ("s7", "Song", "indie", "rock", False),
    ]
    assert {r.artist_key for r in dim.collect()} == {1}


def _star(make_staging, spark, events, users=None):
    stg = make_staging(
        artists=[artist("a1")],
        songs=[song("s1"), song("s2", duration_ms=3)],
        users=users or [user("u1"), user("u9", active=False)],
        events=events)
    return build_star(spark, stg)


def test_fact_quality_rules(spark, make_staging):
    events = [
        event("e01", duration_ms=-1),                                  # dropped
        event("e02", duration_ms=0),                                   # kept, 0.00
        event("e03", duration_ms=None),                                # dropped
        event("e04", duration_ms=205_000),                             # kept, 100.00
        event("e05", duration_ms=205_001),                             # dropped
        event("e06", duration_ms=3000, song_duration_ms=0),            # kept, song 1 ms, 100.00
        event("e07", song_duration_ms=None),                           # dropped
        event("e08", duration_ms=1, song_duration_ms=3),               # 33.33
        event("e09", duration_ms=1, song_duration_ms=800),             # 0.13 (half up)
        event("e10", at="2024-01-01T00:30:00+02:00"),                  # date 2023-12-31
        event("e11", at="2019-06-01T00:00:00+00:00"),                  # no date row
        event("e12", at="2028-01-01T00:00:00+00:00"),                  # no date row
        event("e13", user_id="nobody"), event("e14", user_id="u9"),    # unknown / inactive
        event("e15", song_id="nothing"), event("e16", song_id=None),   # unknown / null song
        event("e17", platform=" iOS "), event("e18", platform=None),
        event("e19", skipped=None),
        event("e20", duration_ms=10), event("e20", duration_ms=20),    # duplicate id: one row
    ]
    star = _star(make_staging, spark, events)
    fact = {r.event_id: r for r in star.fact_streams.collect()}
    assert sorted(fact) == ["e02", "e04", "e06", "e08", "e09", "e10", "e17", "e18", "e19", "e20"]
    assert fact["e02"].completion_pct == Decimal("0.00")
    assert fact["e04"].completion_pct == Decimal("100.00")
    assert (fact["e06"].song_duration_ms, fact["e06"].completion_pct) == (1, Decimal("100.00"))
    assert fact["e08"].completion_pct == Decimal("33.33")
    assert fact["e09"].completion_pct == Decimal("0.13")
    assert fact["e10"].date_key == 20231231
    assert fact["e17"].platform == "ios" and fact["e18"].platform is None
    assert fact["e19"].was_skipped is False
    assert fact["e20"].duration_ms == 10
    keys = sorted(r.stream_key for r in fact.values())
    assert keys == list(range(1, len(fact) + 1))


def test_transform_is_idempotent(spark, make_staging):
    events = [event(f"e{i}", at=f"2024-01-{10 + i % 5:02d}T10:00:00+00:00") for i in range(20)]
    stg = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")], events=events)
    first = build_star(spark, stg)
    again = build_star(spark, stg, existing=first)
    for name in ("dim_artists", "dim_users", "dim_songs", "fact_streams"):
        assert again.table(name).count() == first.table(name).count()
    assert _rows(again.fact_streams, "stream_key", "event_id") == _rows(first.fact_streams, "stream_key", "event_id")


def test_new_rows_get_keys_after_existing(spark, make_staging):
    base = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")],
                        events=[event("e1"), event("e2")])
    first = build_star(spark, base)
    more = make_staging(artists=[artist("a1"), artist("a0")], songs=[song("s1")],
                        users=[user("u1"), user("u0")],
                        events=[event("e1"), event("e0", user_id="u0"), event("e3")])
    second = build_star(spark, more, existing=first)
    assert _rows(second.dim_users, "user_key", "user_id") == [(1, "u1"), (2, "u0")]
    assert _rows(second.dim_artists, "artist_key", "artist_id") == [(1, "a1"), (2, "a0")]
    assert _rows(second.fact_streams, "stream_key", "event_id") == [
        (1, "e1"), (2, "e2"), (3, "e0"), (4, "e3")]


def test_fact_keys_direct(spark, make_staging):
    stg = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")],
                       events=[event("b", at="2024-01-02T00:00:00+00:00"),
                               event("a", at="2024-01-03T00:00:00+00:00")])
    users = build_dim_users(stg.users)
    songs = build_dim_songs(stg.songs, build_dim_artists(stg.artists))
    fact = build_fact_streams(stg.events, users, songs, dim_date(spark))
    # keys follow (date_key, event_id)
    assert _rows(fact, "stream_key", "event_id") == [(1, "b"), (2, "a")]


def test_pii_never_written(spark, make_staging):
    import pytest

    from encore.plans.warehouse import Star, write_star
    from encore.session import scratch_path
    stg = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")],
                       events=[event("e1")])
    star = build_star(spark, stg)
    leaky = Star(star.dim_date, star.dim_artists, stg.users, star.dim_songs, star.fact_streams)
    with pytest.raises(AssertionError, match="personal data"):
        write_star(leaky, scratch_path(spark, "never"))


def test_calendar_is_populated_once(spark):
    from encore.operators.dates import populate_once

    assert populate_once(None, spark).count() == 2922
    existing = dim_date(spark).where("year = 2024")
    assert populate_once(existing, spark) is existing            # non-empty: kept as is
    assert populate_once(existing.limit(0), spark).count() == 2922


def test_fact_sample_with_and_without_dense_keys(spark, make_staging):
    from pyspark.sql import functions as F

    from encore.operators.quality import fact_sample
    stg = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")],
                       events=[event(f"e{i}", at=f"2024-01-{10 + i:02d}T10:00:00+00:00") for i in range(5)])
    star = build_star(spark, stg)
    assert sorted(r.stream_key for r in fact_sample(star, 3).collect()) == [1, 2, 3]
    # keys that do not start at 1 (a gap): the full top-n is used
    shifted = star._replace(fact_streams=star.fact_streams.withColumn("stream_key", F.col("stream_key") + 100))
    assert sorted(r.stream_key for r in fact_sample(shifted, 3).collect()) == [101, 102, 103]
