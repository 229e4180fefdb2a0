"""Structured Streaming ingest equals the batch fact; late dimension rows are picked up."""

from __future__ import annotations

from conftest import SF_SMALL, artist, event, song, user

from encore.plans.warehouse import build_star, driver_star, driver_warehouse, write_star
from encore.schemas import FACT_COLUMNS
from encore.session import scratch_path
from encore.sources.json_source import write_json_lines
from encore.streaming.ingest import run_stream_ingest


def test_stream_equals_batch_fact(spark):
    root = driver_warehouse(spark, SF_SMALL)
    out = scratch_path(spark, "stream-test")
    run_stream_ingest(spark, f"{root}/sources/stream_events.json", out, dims_root=root,
                      max_files_per_trigger=1)
    cols = FACT_COLUMNS[1:]
    streamed = spark.read.parquet(f"{out}/fact_streams").select(*cols)
    batch = driver_star(spark, SF_SMALL).fact_streams.select(*cols)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    keys = [r.stream_key for r in spark.read.parquet(f"{out}/fact_streams").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_stream_retries_events_of_late_users(spark, make_staging):
    dims = scratch_path(spark, "stream-dims")
    stg = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")])
    write_star(build_star(spark, stg), dims)
    src = scratch_path(spark, "stream-src")
    out = scratch_path(spark, "stream-out")
    ckpt = scratch_path(spark, "stream-ckpt")
    batch1 = make_staging(events=[event("e1"), event("e2", user_id="u2")])
    write_json_lines(batch1.events, f"{src}/b1")
    run_stream_ingest(spark, f"{src}/*", out, dims_root=dims, checkpoint=ckpt)
    assert [r.event_id for r in spark.read.parquet(f"{out}/fact_streams").collect()] == ["e1"]
    # the user arrives; the next micro-batch resolves the parked event
    users = spark.read.parquet(f"{dims}/dim_users")
    extra = users.limit(1).selectExpr("CAST(2 AS BIGINT) AS user_key", "'u2' AS user_id", "country_code",
                                      "subscription_type", "age_group", "signup_date")
    extra.write.mode("append").parquet(f"{dims}/dim_users")
    batch2 = make_staging(events=[event("e3")])
    write_json_lines(batch2.events, f"{src}/b2")
    run_stream_ingest(spark, f"{src}/*", out, dims_root=dims, checkpoint=ckpt)
    got = sorted(r.event_id for r in spark.read.parquet(f"{out}/fact_streams").collect())
    assert got == ["e1", "e2", "e3"]


def test_watermark_dedup_drops_copies_in_stream(spark, make_staging):
    dims = scratch_path(spark, "wm-dims")
    stg = make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")])
    write_star(build_star(spark, stg), dims)
    src, out = scratch_path(spark, "wm-src"), scratch_path(spark, "wm-out")
    copies = make_staging(events=[event("e1"), event("e1"), event("e2", at="2024-01-20T11:00:00+00:00")])
    write_json_lines(copies.events, f"{src}/b1")
    run_stream_ingest(spark, f"{src}/*", out, dims_root=dims, dedup_watermark="1 hour")
    got = sorted(r.event_id for r in spark.read.parquet(f"{out}/fact_streams").collect())
    assert got == ["e1", "e2"]


def test_batch_run_again_and_resent_events(spark, make_staging):
    """The batch writer gives one result however often a batch id is run; pending events have no limit of tries."""
    from encore.sources.json_source import ingest
    from encore.streaming.ingest import make_batch_writer

    dims, out = scratch_path(spark, "again-dims"), scratch_path(spark, "again-out")
    write_star(build_star(spark, make_staging(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")])), dims)
    write = make_batch_writer(out, dims)

    def batch(*events):
        src = scratch_path(spark, "again-src")
        write_json_lines(make_staging(events=list(events)).events, src)
        return ingest(spark, src, "stg_stream_events")

    def loaded():
        return sorted((r.event_id, r.date_key) for r in spark.read.parquet(f"{out}/fact_streams").collect())

    first = batch(event("e1"), event("late", user_id="u2"))
    for _ in range(3):
        write(first, 0)
    for i in range(1, 6):
        write(batch(event(f"n{i}")), i)
        write(batch(event(f"n{i}")), i)
    # the same id on another day
    write(batch(event("e1", at="2024-01-21T10:00:00+00:00")), 6)
    users = spark.read.parquet(f"{dims}/dim_users")
    users.selectExpr("CAST(2 AS BIGINT) AS user_key", "'u2' AS user_id", "country_code", "subscription_type", "age_group",
                     "signup_date").write.mode("append").parquet(f"{dims}/dim_users")
    write(batch(event("n7")), 7)
    write(batch(event("n7")), 7)
    day = 20240120
    assert loaded() == sorted([("e1", day), ("late", day), ("n7", day), *[(f"n{i}", day) for i in range(1, 6)]])
