"""What must not grow with the input: files and splits of array sources, broadcasts, evaluations and single tasks."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from encore import registry as R
from encore.operators import joins, keys
from encore.session import local_fs_path, scratch_path
from encore.sources.staging import Staging, from_frames

from conftest import artist, event, song, user


def test_array_sources_have_a_file_a_partition_and_bounded_splits(spark, monkeypatch):
    small = from_frames(spark, [artist("1")], [song("1")], [user("1")], [event(str(i)) for i in range(300)])
    staged = Staging(*[small.table(n) for n in ("stg_artists", "stg_songs", "stg_users")], small.events.repartition(3))
    root = scratch_path(spark, "growth")
    monkeypatch.setattr(R, "driver_staging_tables", lambda *_: staged)
    monkeypatch.setattr(R, "scratch_path", lambda *_: root)
    report = {r.source_file: r for r in R.q_ingest_json_array(spark, "").collect()}
    assert report["stream_events.json"].records == 300
    assert len(glob.glob(f"{local_fs_path(root)}/sources/stream_events.json/part-*")) == 3
    big = f"{local_fs_path(scratch_path(spark, 'sparse'))}.json"
    os.makedirs(os.path.dirname(big), exist_ok=True)
    with open(big, "w") as f:
        f.truncate(1 << 30)
    assert (1 << 30) / R.array_split_bytes(spark, [big]) <= R.ARRAY_SPLITS
    assert R.array_split_bytes(spark, [f"{root}/sources/artists.json"]) == R.ARRAY_SPLIT_BYTES
    os.truncate(big, 0)


def test_dimension_of_some_megabytes_is_not_sent_through_the_driver(spark):
    path = scratch_path(spark, "dimension")
    spark.range(200_000).select(F.col("id").cast("string").alias("k"), F.xxhash64("id").alias("v")).write.parquet(path)
    dim = spark.read.parquet(path)
    fact = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    assert not joins.fits_broadcast(dim)
    for how in ("inner", "left", "left_semi", "left_anti"):
        joined = joins.lookup_join(fact, dim, "k", how, split_hot=False)
        assert joined.count() == (0 if how == "left_anti" else 1000)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString(), how


def test_rows_to_key_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    names = {"encore.keys.smallFrameBytes": "0", "encore.keys.rangeRows": "100"}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n"), F.lit("x").alias("v")).mapInArrow(counted, "n long, v string")
        keyed = keys.assign_dense_keys(rows, "n", "key")
        got = sorted((r.key, r.n) for r in keyed.collect())
    finally:
        for name in names:
            spark.conf.unset(name)
    assert got == [(i + 1, i) for i in range(5000)]
    assert made.value == 5000


def test_range_offsets_over_many_parts(spark):
    counts = [(None, 1, 4), (None, None, 2), (1, None, 1), (1, 5, 7), (2, -3, 5)] + [(3, i, i % 4 + 1) for i in range(500)]
    frame = spark.createDataFrame(counts, "a int, b int, _k_cnt long").repartition(5)
    got = {(r.ao, r.bo): r._k_off for r in keys.range_offsets(frame, ["a", "b"]).collect()}
    before, expected = 0, {}
    for a, b, n in sorted(counts, key=lambda r: [(x is not None, x or 0) for x in r[:2]]):
        expected[a, b] = before
        before += n
    assert got == expected


def _sent(df, at):
    """Bytes of the relations that a run of ``df`` broadcast, from its final plan."""
    df.write.parquet(at)
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "BroadcastExchange":
            found.append(node.metrics().apply("dataSize").value())
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_few_text_keys_broadcast_take_no_page_of_memory(spark):
    fact = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 70}") for i in range(900)] + [(901, None), (902, "")], "id long, key string")
    dim = spark.createDataFrame([(f"k{i}", i) for i in range(50)] + [("hot", -1), ("k7", 70), (None, 5), ("", 6)], "key string, attr long")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain, joined = fact.join(dim, "key", how), joins.lookup_join(fact, dim, "key", how)
        assert joined.columns == plain.columns
        assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect())), how
        sent = _sent(joined, scratch_path(spark, "sent"))
        assert sent and max(sent) < 3 << 20, how
    same = dim.select("key")   # a frame joined with itself
    assert joins.lookup_join(same, same, "key", "left_semi").count() == 53
    spark.conf.set("encore.broadcast.limit.bytes", "0")
    try:
        split = joins.lookup_join(fact, dim, "key", "inner", hot_share=0.1)
        assert sorted(map(str, split.collect())) == sorted(map(str, fact.join(dim, "key").collect()))
        assert max(_sent(split, scratch_path(spark, "sent"))) < 3 << 20
    finally:
        spark.conf.unset("encore.broadcast.limit.bytes")
