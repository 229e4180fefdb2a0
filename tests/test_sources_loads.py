"""JSON ingest (defaults, rejects, layouts), full refresh, incremental load, partitions."""

from __future__ import annotations

import datetime as dt
import json
import os

from conftest import artist, event, song, user
from pyspark.sql import functions as F

from encore.plans import loads
from encore.plans.warehouse import build_star
from encore.session import local_fs_path, scratch_path
from encore.sources.json_source import accepted, ingest, rejected, write_json_lines


def _write(path: str, lines: list[str], name: str = "part-0.json") -> str:
    local = local_fs_path(path)
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_users_active_default_only_when_absent(spark):
    path = _write(scratch_path(spark, "users"), [
        json.dumps({"user_id": "u1", "is_active": False}),
        json.dumps({"user_id": "u2", "is_active": None}),
        json.dumps({"user_id": "u3"}),
        json.dumps({"user_id": "u4", "is_active": True, "email": "a@b.c"}),
    ])
    got = {r.user_id: r.is_active for r in accepted(ingest(spark, path, "stg_users")).collect()}
    assert got == {"u1": False, "u2": None, "u3": True, "u4": True}


def test_event_parsing_offsets_defaults_and_rejects(spark):
    path = _write(scratch_path(spark, "events"), [
        json.dumps({"event_id": "e1", "user_id": "u", "song_id": "s",
                    "listened_at": "2024-01-01T00:30:00.123456+02:00", "duration_ms": 5}),
        json.dumps({"event_id": "e2", "user_id": "u", "song_id": "s",
                    "listened_at": "2024-01-01T00:00:00Z", "duration_ms": "abc"}),
        "this is not json",
        json.dumps({"event_id": "e3", "user_id": "u", "song_id": "s",
                    "listened_at": "2024-01-02T00:00:00Z", "was_skipped": None}),
    ])
    df = ingest(spark, path, "stg_stream_events")
    good = {r.event_id: r for r in accepted(df).collect()}
    assert sorted(good) == ["e1", "e3"]
    assert good["e1"].listened_at == dt.datetime(2023, 12, 31, 22, 30, 0, 123456)
    assert good["e1"].was_skipped is False          # absent -> default
    assert good["e3"].was_skipped is None           # explicit null stays null
    bad = sorted(r._rejected for r in rejected(df).collect())
    assert bad == [["_record"], ["duration_ms"]]


def test_array_layout(spark):
    path = _write(scratch_path(spark, "songs"), [json.dumps([
        {"song_id": "s1", "title": "A", "artist_id": "a", "duration_ms": 120000},
        {"song_id": "s2", "title": "B", "artist_id": "a", "is_explicit": True},
    ], indent=2)])
    got = {r.song_id: (r.is_explicit, r.album_id) for r in
           accepted(ingest(spark, path, "stg_songs", layout="array")).collect()}
    assert got == {"s1": (False, None), "s2": (True, None)}


def test_json_round_trip_keeps_values(spark, make_staging):
    stg = make_staging(events=[event("e1", at="2024-01-05T01:02:03.456789+00:00", skipped=None),
                               event("e2", platform=None)])
    path = scratch_path(spark, "rt")
    write_json_lines(stg.events, path)
    back = accepted(ingest(spark, path, "stg_stream_events"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, stg.events.collect()))


def test_full_refresh_versions(spark):
    table = scratch_path(spark, "fr")
    loads.full_refresh(spark.range(5), table, load_id="0001")
    loads.full_refresh(spark.range(3), table, load_id="0002")
    assert loads.read_current(spark, table).count() == 3


def test_incremental_load_matches_full_build(spark, make_staging):
    events = [event(f"e{i:02d}", at=f"2024-01-{1 + i:02d}T10:00:00+00:00") for i in range(20)]
    full = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")], events=events)
    first = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")], events=events[:8])
    root = scratch_path(spark, "inc")
    loads.land(first, f"{root}/stg", dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    loads.land(full, f"{root}/stg", dt.datetime(2024, 2, 2, tzinfo=dt.timezone.utc))
    star = loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    # nothing new
    again = loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    expected = build_star(spark, full).fact_streams
    cols = ["stream_key", "event_id", "date_key"]
    assert sorted(map(tuple, star.fact_streams.select(*cols).collect())) == \
        sorted(map(tuple, expected.select(*cols).collect()))
    assert again.fact_streams.count() == 20


def test_late_dimension_row_is_picked_up(spark, make_staging):
    root = scratch_path(spark, "late")
    early = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")],
                         events=[event("e1"), event("e2", user_id="u2")])
    loads.land(early, f"{root}/stg", dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    assert loads.incremental_load(spark, f"{root}/stg", f"{root}/wh").fact_streams.count() == 1
    late = make_staging(users=[user("u2")])
    loads.land(late, f"{root}/stg", dt.datetime(2024, 2, 2, tzinfo=dt.timezone.utc))
    star = loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    assert sorted(r.event_id for r in star.fact_streams.collect()) == ["e1", "e2"]


def test_month_partitions_dynamic_overwrite(spark):
    fact = spark.createDataFrame([(20240105, 1), (20240210, 2), (20240211, 3)], "date_key int, v int")
    path = scratch_path(spark, "bymonth")
    loads.write_fact_by_month(fact, path)
    loads.write_fact_by_month(fact.where("date_key < 20240200").withColumn("v", F.lit(9)), path)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("date_key", "v", "year_month").collect())
    assert got == [(20240105, 9, 202401), (20240210, 2, 202402), (20240211, 3, 202402)]


def test_landing_splits_accepted_and_rejected(spark, make_staging):
    from encore.sources.json_source import land_staging, write_sources
    from encore.sources.staging import from_parquet

    stg = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")],
                       events=[event("e1"), event("e2")])
    root = scratch_path(spark, "landing")
    write_sources(stg, f"{root}/sources")
    # one more raw file with a bad value and a malformed line
    _write(f"{root}/sources/stream_events.json", [
        json.dumps({"event_id": "e3", "user_id": "u1", "song_id": "s1",
                    "listened_at": "2024-01-02T00:00:00Z", "duration_ms": "12x"}),
        "{not json",
    ], name="part-extra.json")
    land_staging(spark, f"{root}/sources", f"{root}/staging")
    assert sorted(r.event_id for r in from_parquet(spark, f"{root}/staging").events.collect()) == ["e1", "e2"]
    bad = spark.read.parquet(f"{root}/staging/stg_stream_events").where("_load_status = 'rejected'")
    assert sorted(tuple(r._rejected) for r in bad.collect()) == [("_record",), ("duration_ms",)]


def test_full_replace_leaves_no_stale_partitions(spark, make_staging):
    from encore.plans.warehouse import read_star, write_star
    root = scratch_path(spark, "replace")
    two_days = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")],
                            events=[event("e1", at="2024-01-02T10:00:00+00:00"),
                                    event("e2", at="2024-01-03T10:00:00+00:00")])
    write_star(build_star(spark, two_days), root)
    one_day = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")],
                           events=[event("e1", at="2024-01-02T10:00:00+00:00")])
    write_star(build_star(spark, one_day), root)
    assert [r.event_id for r in read_star(spark, root).fact_streams.collect()] == ["e1"]


def test_key_reservation_survives_a_failed_append(spark, make_staging):
    root = scratch_path(spark, "reserve")
    first = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")],
                         events=[event("e1"), event("e2")])
    loads.land(first, f"{root}/stg", dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    star = loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    assert sorted(r.stream_key for r in star.fact_streams.collect()) == [1, 2]
    # a load reserved keys up to 7 and failed before appending its rows
    loads.reserve_keys(spark, f"{root}/wh", 99, 7)
    more = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")],
                        events=[event("e3")])
    loads.land(more, f"{root}/stg", dt.datetime(2024, 2, 2, tzinfo=dt.timezone.utc))
    star = loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    keys = {r.event_id: r.stream_key for r in star.fact_streams.collect()}
    assert keys == {"e1": 1, "e2": 2, "e3": 8}        # a gap, never a reused key


def test_landing_report_counts_without_reparsing(spark, make_staging):
    from encore.sources.json_source import ingest_report, land_staging, landing_report, write_sources

    stg = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")],
                       events=[event("e1"), event("e2")])
    root = scratch_path(spark, "landing-report")
    write_sources(stg, f"{root}/sources")
    _write(f"{root}/sources/stream_events.json", ["{broken"], name="part-bad.json")
    land_staging(spark, f"{root}/sources", f"{root}/staging")
    got = sorted(map(tuple, landing_report(spark, f"{root}/staging").collect()))
    assert got == sorted(map(tuple, ingest_report(spark, f"{root}/sources").collect()))
    assert ("stream_events.json", 3, 1) in got


def test_loads_are_a_set_not_a_high_mark(spark, make_staging):
    """A load stamped earlier but landed later is taken; a load without its marker is not yet."""
    root = scratch_path(spark, "set")
    dims = dict(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")])
    loads.land(make_staging(**dims, events=[event("e1")]), f"{root}/stg", dt.datetime(2024, 2, 2, tzinfo=dt.timezone.utc))
    loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    loads.land(make_staging(events=[event("e2")]), f"{root}/stg", dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    stg = make_staging(events=[event("e3")])
    stg.events.write.parquet(f"{root}/stg/stg_stream_events/load=unfinished")
    star = loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    assert sorted(r.event_id for r in star.fact_streams.collect()) == ["e1", "e2"]


def test_dims_first_and_a_failed_first_run(spark, make_staging):
    root = scratch_path(spark, "dims-first")
    loads.land(make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1"), user("u2")]), f"{root}/stg")
    assert loads.incremental_load(spark, f"{root}/stg", f"{root}/wh").fact_streams.count() == 0
    loads.land(make_staging(songs=[song("s2")], users=[user("u1")], events=[event("e1", song_id="s2"), event("e2", user_id="u2")]),
               f"{root}/stg")
    star = loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    assert sorted(r.event_id for r in star.fact_streams.collect()) == ["e1", "e2"]
    assert sorted(r.user_key for r in star.dim_users.collect()) == [1, 2]
    assert sorted(r.song_key for r in star.dim_songs.collect()) == [1, 2]
    # the record of the last run is lost: the run is made again and changes nothing
    fs, path = loads._fs(spark, f"{root}/wh/_processed")
    fs.delete(path, True)
    again = loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    assert again.fact_streams.count() == 2 and again.dim_users.count() == 2 and again.dim_songs.count() == 2
