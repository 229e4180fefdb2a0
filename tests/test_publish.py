"""Runs that are killed at any write, refused or settled late; the id index."""

from __future__ import annotations

import contextlib

import pytest
from conftest import artist, event, song, user
from pyspark.sql import functions as F

from encore.operators import id_index
from encore.plans import loads
from encore.plans.publish import ConstraintViolation, hadoop_fs, list_dirs, path_exists, published_runs
from encore.plans.warehouse import build_star, read_star, write_star
from encore.schemas import FACT_COLUMNS
from encore.session import scratch_path

STEPS = ["dim_date", "dim_songs", "fact", "pending", "marker", "move"]


class Killed(Exception):
    pass


def batches(make_staging):
    dims = dict(artists=[artist("a1")], songs=[song("s1")], users=[user("u1")])
    return [make_staging(**dims, events=[event("e1"), event("e2", at="2024-01-21T10:00:00+00:00"), event("wait", user_id="u2")]),
            make_staging(users=[user("u2"), user("u1")], events=[event("e3"), event("e1", at="2024-01-22T10:00:00+00:00")])]


def state(star):
    return ([sorted(map(tuple, star.table(n).select(*c).collect())) for n, c in
             (("dim_users", ["user_key", "user_id"]), ("dim_songs", ["song_key", "song_id"]), ("fact_streams", FACT_COLUMNS))], star.dim_date.count())


@pytest.mark.parametrize("step", STEPS)
def test_a_run_killed_at_any_write_gives_the_same_result(spark, make_staging, step):
    first, second = batches(make_staging)
    roots = [scratch_path(spark, "whole"), scratch_path(spark, "killed")]

    def killer(at):
        if at == step:
            raise Killed(at)

    for batch in (first, second):
        for root in roots:
            loads.land(batch, f"{root}/stg")
        loads.incremental_load(spark, f"{roots[0]}/stg", f"{roots[0]}/wh")
        with contextlib.suppress(Killed):
            loads.incremental_load(spark, f"{roots[1]}/stg", f"{roots[1]}/wh", on_step=killer)
        loads.incremental_load(spark, f"{roots[1]}/stg", f"{roots[1]}/wh")
    whole, killed = (state(read_star(spark, f"{r}/wh")) for r in roots)
    assert whole == killed
    assert sorted(r[0] for r in killed[0][2]) == [1, 2, 3, 4]   # dense keys: a killed run uses none up


def test_nothing_is_seen_before_the_marker(spark, make_staging):
    first, _ = batches(make_staging)
    root = scratch_path(spark, "unseen")
    loads.land(first, f"{root}/stg")

    def killer(at):
        if at == "pending":
            raise Killed(at)

    with contextlib.suppress(Killed):
        loads.incremental_load(spark, f"{root}/stg", f"{root}/wh", on_step=killer)
    assert published_runs(spark, f"{root}/wh") == []
    star = read_star(spark, f"{root}/wh")
    assert [star.table(n).count() for n in star._fields] == [0] * 5


def test_folders_without_files_are_empty_tables(spark, make_staging):
    """What an attempt outside the runs may have left: table folders that hold no data."""
    first, second = batches(make_staging)
    root = scratch_path(spark, "bare")
    fs, path = hadoop_fs(spark, f"{root}/wh/fact_streams/_temporary")
    fs.mkdirs(path)
    for name in ("dim_users", "dim_date"):
        fs.mkdirs(hadoop_fs(spark, f"{root}/wh/{name}/_temporary")[1])
    for batch in (first, second):
        loads.land(batch, f"{root}/stg")
    star = loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    assert sorted(r.event_id for r in star.fact_streams.collect()) == ["e1", "e2", "e3", "wait"]


def test_incremental_on_top_of_a_full_build(spark, make_staging):
    first, second = batches(make_staging)
    root = scratch_path(spark, "on-full")
    write_star(build_star(spark, first), f"{root}/wh")
    loads.land(second, f"{root}/stg")
    star = loads.incremental_load(spark, f"{root}/stg", f"{root}/wh")
    assert sorted((r.stream_key, r.event_id) for r in star.fact_streams.collect()) == [(1, "e1"), (2, "e2"), (3, "e3")]
    assert sorted(r.event_id for r in spark.read.parquet(f"{root}/wh/{id_index.TABLE}").collect()) == ["e1", "e2", "e3"]


def test_a_batch_reads_its_buckets_only(spark):
    root = scratch_path(spark, "buckets")
    rows = spark.range(5000).select(F.concat(F.lit("e"), F.col("id")).alias("event_id"))
    id_index.index_rows(rows, "event_id").write.partitionBy(id_index.BUCKET).parquet(root)
    assert len(list_dirs(spark, root)) == id_index.BUCKETS
    batch = spark.createDataFrame([("e17",), ("e18",), ("new",), (None,)], "event_id string")
    buckets = id_index.touched_buckets(batch, "event_id")
    assert 1 <= len(buckets) <= 3
    read = id_index.read_buckets(spark, root, "event_id", buckets)
    # scan count: the files of the touched buckets and no others
    plan = read._jdf.queryExecution().executedPlan()
    scanned = read.select(F.input_file_name().alias("f")).distinct().count()
    assert scanned == len(buckets) and "PartitionFilters" in plan.toString()
    got = id_index.known_ids(spark, root, batch, "event_id", buckets)
    assert sorted(r.event_id for r in got.collect()) == ["e17", "e18"]


def test_violations_refuse_the_whole_load(spark, make_staging):
    first, _ = batches(make_staging)
    root = scratch_path(spark, "refuse")
    star = build_star(spark, first)
    write_star(star._replace(fact_streams=star.fact_streams.where("false")), root)
    rows = star.fact_streams
    with pytest.raises(ConstraintViolation) as refused:
        loads.append_fact(spark, root, rows.withColumn("user_key", F.when(F.col("event_id") == "e1", 99).otherwise(F.col("user_key")))
                          .withColumn("date_key", F.when(F.col("event_id") != "e2", F.col("date_key"))))
    assert refused.value.counts == {"orphan_user_key": 1, "null_date_key": 1}
    assert read_star(spark, root).fact_streams.count() == 0
    assert loads.append_fact(spark, root, rows) == 2
    with pytest.raises(ConstraintViolation) as again:
        loads.append_fact(spark, root, rows)
    assert again.value.counts == {"taken_stream_key": 2}
    assert read_star(spark, root).fact_streams.count() == 2 and path_exists(spark, f"{root}/{id_index.TABLE}")


def test_stream_batch_killed_before_its_marker(spark, make_staging, monkeypatch):
    from encore.plans.publish import Run
    from encore.sources.json_source import ingest, write_json_lines
    from encore.streaming.ingest import make_batch_writer

    first, second = batches(make_staging)
    dims, out = scratch_path(spark, "k-dims"), scratch_path(spark, "k-out")
    write_star(build_star(spark, first), dims)
    write = make_batch_writer(out, dims)

    def batch(stg):
        src = scratch_path(spark, "k-src")
        write_json_lines(stg.events, src)
        return ingest(spark, src, "stg_stream_events")

    publish = Run.publish
    monkeypatch.setattr(Run, "publish", lambda *a: (_ for _ in ()).throw(Killed("publish")))
    with contextlib.suppress(Killed):
        write(batch(first), 0)
    assert not path_exists(spark, f"{out}/fact_streams")
    monkeypatch.setattr(Run, "publish", publish)
    for i, stg in enumerate((first, second, second)):
        write(batch(stg), i)
    got = spark.read.parquet(f"{out}/fact_streams")
    assert sorted((r.stream_key, r.event_id) for r in got.collect()) == [(1, "e1"), (2, "e2"), (3, "e3")]

