"""Report rules on hand-written rows: windows, grouping, thresholds, weighting."""

from __future__ import annotations

import datetime as dt

from conftest import artist, event, song, user

from encore.operators import report
from encore.plans.warehouse import build_star

AS_OF = "2024-01-31"


def _day(offset: int) -> str:
    d = dt.date(2024, 1, 31) + dt.timedelta(days=offset)
    return f"{d.isoformat()}T12:00:00+00:00"


def test_q1_window_and_merge(spark, make_staging):
    stg = make_staging(
        artists=[artist("a1", "Star")],
        songs=[song("s1", title="Hit"), song("s2", title="Hit"), song("s3", title="Other")],
        users=[user(f"u{i}") for i in range(6)],
        events=[
            event("e1", "u1", "s3", _day(0)),    # on as_of: out
            event("e2", "u2", "s3", _day(-1)),   # in
            event("e3", "u3", "s3", _day(-7)),   # in
            event("e4", "u4", "s3", _day(-8)),   # out
            event("e5", "u1", "s1", _day(-2)),   # same artist + title + genre: merged
            event("e6", "u2", "s2", _day(-3)),
            event("e7", "u2", "s2", _day(-3), skipped=True, duration_ms=50_000),
        ])
    star = build_star(spark, stg)
    rows = {r.song: r for r in report.trending_songs(star, AS_OF).collect()}
    assert rows["Other"].unique_listeners == 2 and rows["Other"].total_plays == 2
    hit = rows["Hit"]
    assert (hit.unique_listeners, hit.total_plays, hit.skip_count) == (2, 3, 1)
    assert hit.skip_rate_pct == 33.3
    # (50 + 50 + 25) / 3 = 41.666.. -> 41.7
    assert hit.avg_completion_pct == 41.7
    assert [r.rank for r in sorted(rows.values(), key=lambda r: r.rank)] == [1, 2]


def test_q1_top_k_ties_are_deterministic(spark, make_staging):
    songs = [song(f"s{i}", title=f"T{i:02d}") for i in range(15)]
    events = [event(f"e{i}", "u1", f"s{i}", _day(-1)) for i in range(15)]
    stg = make_staging(artists=[artist("a1")], songs=songs, users=[user("u1")], events=events)
    star = build_star(spark, stg)
    top = report.trending_songs(star, AS_OF, k=10).orderBy("rank").collect()
    assert [r.song for r in top] == [f"T{i:02d}" for i in range(10)]
    assert [r.rank for r in top] == list(range(1, 11))


def test_q2_rates_split_by_subscription(spark, make_staging):
    stg = make_staging(
        artists=[artist("a1")],
        songs=[song("s1", genre="pop"), song("s2", genre="jazz")],
        users=[user("f", "free"), user("p", "premium"), user("x", "trial")],
        events=[
            event("e1", "f", "s1", skipped=True, duration_ms=20_000),
            event("e2", "f", "s1"),
            event("e3", "p", "s1"),
            event("e4", "x", "s2", skipped=True, duration_ms=20_000),
            event("e5", "x", "s2"),
        ])
    star = build_star(spark, stg)
    rows = {r.genre: r for r in report.genre_skip_rates(star).collect()}
    pop, jazz = rows["pop"], rows["jazz"]
    assert (pop.total_plays, pop.overall_skip_rate_pct) == (3, 33.33)
    assert (pop.free_skip_rate_pct, pop.premium_skip_rate_pct) == (50.0, 0.0)
    assert pop.avg_listen_depth_pct == 50.0 and pop.avg_song_duration_sec == 200.0
    # only 'unknown' users played jazz: no free / premium rate
    assert jazz.free_skip_rate_pct is None and jazz.premium_skip_rate_pct is None
    assert jazz.overall_skip_rate_pct == 50.0


def test_q3_user_weighted_and_no_plays_absent(spark, make_staging):
    stg = make_staging(
        artists=[artist("a1")],
        songs=[song("s1", genre="pop"), song("s2", genre="rock")],
        users=[user("f1", "free"), user("f2", "free"), user("idle", "free"), user("p1", "premium")],
        events=[
            event("e1", "f1", "s1", platform="web", at="2024-01-20T08:00:00+00:00"),
            event("e2", "f1", "s2", platform="web", at="2024-01-20T08:30:00+00:00", skipped=True,
                  duration_ms=50_000),
            event("e3", "f1", "s1", platform="ios", at="2024-01-20T09:00:00+00:00"),
            event("e4", "f2", "s1", platform="ios", at="2024-01-20T09:10:00+00:00"),
            event("e5", "p1", "s1", platform="android", at="2024-01-20T23:00:00+00:00"),
        ])
    star = build_star(spark, stg)
    rows = {r.subscription_type: r for r in report.free_vs_premium(star).collect()}
    free = rows["free"]
    assert free.total_users == 2                 # idle user has no plays
    assert free.avg_plays_per_user == 2.0        # (3 + 1) / 2
    # per user skip rates 33.33 and 0.00 -> 16.665 -> 16.7 (average of rounded values)
    assert free.skip_rate_pct == 16.7
    assert free.avg_unique_genres == 1.5
    # ios and web tie on 2 plays each -> first by name; hours 8 and 9 tie -> 8
    assert free.top_platform == "ios" and free.peak_hour_utc == 8
    assert rows["premium"].peak_hour_utc == 23


def test_q4_thresholds_and_windows(spark, make_staging):
    users = [user(f"u{i}") for i in range(120)]
    artists_ = [artist(f"a{i}", f"Artist{i}", genre="pop") for i in range(4)]
    songs = [song(f"s{i}", artist_id=f"a{i}") for i in range(4)]
    pairs = {0: (26, 20), 1: (27, 20), 2: (20, 4), 3: (19, 5)}
    events, n = [], 0
    for a, (recent, prev) in pairs.items():
        for i in range(recent):
            events.append(event(f"e{n}", f"u{i}", f"s{a}", _day(-1 - i % 30)))
            n += 1
        for i in range(prev):
            events.append(event(f"e{n}", f"u{100 - i}", f"s{a}", _day(-31 - i % 30)))
            n += 1
    stg = make_staging(artists=artists_, songs=songs, users=users, events=events)
    star = build_star(spark, stg)
    out = report.breakout_artists(star, AS_OF, window_days=30).collect()
    assert [(r.artist, r.recent_listeners, r.prev_listeners, r.breakout_score) for r in out] == [
        ("Artist1", 27, 20, 1.35)]
    assert out[0].regional_concentration_pct == 100.0


def test_q4_window_labels(spark, make_staging):
    stg = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")], events=[])
    star = build_star(spark, stg)
    labels = {r.date_key: r.window_label for r in report.date_windows(star, AS_OF, 30).collect()}

    def key(offset):
        d = dt.date(2024, 1, 31) + dt.timedelta(days=offset)
        return d.year * 10000 + d.month * 100 + d.day

    assert labels[key(-30)] == "recent" and labels[key(-31)] == "previous"
    assert labels[key(-60)] == "previous" and key(-61) not in labels and key(0) not in labels


def test_same_named_artists_merge_and_null_genres_group(spark, make_staging):
    # two artist ids share a name: Q4 groups and joins on the name (C10, D18)
    stg = make_staging(
        artists=[artist("a1", "Twin", genre="pop"), artist("a2", "Twin", genre="pop")],
        songs=[song("s1", artist_id="a1", genre=None), song("s2", artist_id="a2", genre=None)],
        users=[user(f"u{i}") for i in range(30)],
        events=[event(f"r{i}", f"u{i}", "s1" if i % 2 else "s2", _day(-1 - i % 10)) for i in range(26)]
        + [event(f"p{i}", f"u{i}", "s1", _day(-20 - i % 5)) for i in range(10)])
    star = build_star(spark, stg)
    out = report.breakout_artists(star, AS_OF, window_days=15).collect()
    assert [(r.artist, r.recent_listeners, r.prev_listeners) for r in out] == [("Twin", 26, 10)]
    assert out[0].breakout_score == 2.6 and out[0].regional_concentration_pct == 100.0
    # NULL genre: one group in Q1 and Q2
    q2 = report.genre_skip_rates(star).collect()
    assert [(r.genre, r.total_plays) for r in q2] == [(None, 36)]
    q1 = report.trending_songs(star, AS_OF, days=30).collect()
    assert {(r.artist, r.song, r.genre) for r in q1} == {("Twin", "Song", None)}


def test_weekly_report_tables_keep_their_order(spark):
    from conftest import SF_SMALL
    from encore.operators import report
    from encore.plans.warehouse import driver_star
    from encore.session import scratch_path

    paths = report.write_weekly_report(driver_star(spark, SF_SMALL), scratch_path(spark, "weekly"), "2024-01-31", 15)
    assert list(paths) == ["trending_songs", "genre_skip_rates", "free_vs_premium", "breakout_artists"]
    tables = {n: spark.read.parquet(p).collect() for n, p in paths.items()}
    assert [r["rank"] for r in tables["trending_songs"]] == list(range(1, len(tables["trending_songs"]) + 1))
    rates = [(-r["overall_skip_rate_pct"], r["genre"]) for r in tables["genre_skip_rates"]]
    assert rates == sorted(rates) and rates
    plans = [r["subscription_type"] for r in tables["free_vs_premium"]]
    assert plans == sorted(plans) and plans
