"""Dense keys, first-wins dedup, insert-if-absent and the skew-aware lookup join."""

from __future__ import annotations

import datetime as dt
import inspect
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.operators import keys
from encore.operators.joins import hot_keys, lookup_join
from encore.operators.keys import assign_dense_keys, dedup_first, dedup_first_rare, insert_if_absent


def test_dense_keys_equal_global_row_number(spark):
    ids = [f"{random.Random(i).getrandbits(64):016x}" for i in range(5000)]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(ids)], "nk string, v long")
    keyed = assign_dense_keys(df, "nk", "k", num_partitions=5)
    expected = df.withColumn("k", F.row_number().over(Window.orderBy("nk")).cast("long"))
    assert sorted(keyed.select("k", "nk").collect()) == sorted(expected.select("k", "nk").collect())


def test_dense_keys_start_after_existing(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "nk string")
    got = sorted(tuple(r) for r in assign_dense_keys(df, "nk", "k", start=41).collect())
    assert got == [(42, "a"), (43, "b"), (44, "c")]


def test_dedup_first_keeps_minimum_and_handles_a_hot_key(spark):
    rows = [("hot", i % 7, f"x{i}") for i in range(3000)] + [("k1", 5, "b"), ("k1", 5, "a"),
                                                            ("k2", None, "z"), ("k2", 1, "a")]
    df = spark.createDataFrame(rows, "k string, a int, b string").repartition(8)
    got = {r.k: (r.a, r.b) for r in dedup_first(df, "k").collect()}
    assert got == {"hot": (0, "x0"), "k1": (5, "a"), "k2": (None, "z")}   # NULLs first


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([(1, "a", "old"), (2, "c", "old")], "k long, nk string, v string")
    incoming = spark.createDataFrame([("a", "new"), ("b", "new"), ("d", "new"), ("b", "dup")],
                                     "nk string, v string")
    added = insert_if_absent(incoming, existing, "nk", "k")
    assert sorted(tuple(r) for r in added.select("k", "nk", "v").collect()) == [
        (3, "b", "dup"), (4, "d", "new")]


def test_lookup_join_split_equals_plain_join(spark):
    spark.conf.set("encore.broadcast.limit.bytes", "0")   # force the shuffle path
    try:
        fact = spark.createDataFrame(
            [(i, "hot" if i % 3 else f"k{i % 50}") for i in range(3000)] + [(9999, None)],
            "id long, key string")
        dim = spark.createDataFrame([(f"k{i}", i) for i in range(50)] + [("hot", -1)],
                                    "key string, attr long")
        found = hot_keys(fact, "key", hot_share=0.1)
        assert "hot" in found and len(found) <= 10     # bounded by 1 / hot_share
        for how in ("inner", "left", "left_anti", "left_semi"):
            split = lookup_join(fact, dim, "key", how, hot_share=0.1, sample_fraction=1.0)
            plain = fact.join(dim, "key", how)
            assert sorted(map(tuple, split.select(*plain.columns).collect()), key=str) == \
                sorted(map(tuple, plain.collect()), key=str), how
        plan = lookup_join(fact, dim, "key", "inner", hot_share=0.1, sample_fraction=1.0) \
            ._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan     # hot rows: broadcast of the hot dimension rows
    finally:
        spark.conf.unset("encore.broadcast.limit.bytes")


def test_lookup_join_broadcasts_small_dimension(spark):
    fact = spark.range(100).withColumn("key", (F.col("id") % 10).cast("string"))
    dim = spark.createDataFrame([(str(i), i) for i in range(10)], "key string, v long")
    plan = lookup_join(fact, dim, "key")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_dedup_first_rare_equals_full_dedup(spark):
    rows = [(f"k{i}", i, "x") for i in range(200)] + [("k7", -1, "y"), ("k7", 5, "a"),
                                                      ("k9", 3, None), (None, 1, "n"), (None, 0, "m")]
    df = spark.createDataFrame(rows, "k string, a int, b string").repartition(4)
    full = sorted(map(tuple, dedup_first(df, "k").collect()), key=str)
    assert sorted(map(tuple, dedup_first_rare(df, "k").collect()), key=str) == full


def _ranged(spark, df, order, limit=50, **kw):
    """Keys by the range path: no small-frame switch, ranges of at most ``limit`` rows."""
    names = {"encore.keys.smallFrameBytes": "0", "encore.keys.rangeRows": str(limit)}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        return assign_dense_keys(df, order, "k", **kw)
    finally:
        for k in names:
            spark.conf.unset(k)


@pytest.mark.parametrize("schema, make", [
    ("nk string, v long", lambda r, i: (f"event-{i:07d}" if i % 3 else f"event-é{r.random()}", i)),
    ("nk string, v long", lambda r, i: (None if i == 9 else "a" * (i % 40) + str(i), i)),
    ("nk long, v long", lambda r, i: (None if i == 7 else (i - 300) * 10**9 if i % 2 else i, i)),
    ("nk date, v long", lambda r, i: (dt.date(2000, 1, 1) + dt.timedelta(days=i), i)),
    ("nk double, v long", lambda r, i: (i / 7 - 9, i))])
def test_ranged_keys_equal_a_global_order(spark, schema, make):
    rnd = random.Random(1)
    df = spark.createDataFrame([make(rnd, i) for i in range(900)], schema).repartition(4)
    keyed = _ranged(spark, df, ["nk", "v"], start=10)
    expected = df.select((F.row_number().over(Window.orderBy("nk", "v")) + 10).cast("long").alias("k"), "nk", "v")
    assert sorted(map(str, keyed.collect())) == sorted(map(str, expected.collect()))


def test_ranged_keys_of_days_and_ids(spark):
    """One day with most rows: its ids are cut further; the plan shuffles rows once and has no checkpoint."""
    rows = [(20240101 if i % 10 else 20240102 + i % 7, f"{random.Random(i).getrandbits(64):016x}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "date_key int, event_id string, v long").repartition(5)
    keyed = _ranged(spark, df, ["date_key", "event_id"], num_partitions=6)
    expected = df.select(F.row_number().over(Window.orderBy("date_key", "event_id")).cast("long").alias("k"), "*")
    assert sorted(keyed.collect()) == sorted(expected.collect())
    physical = keyed.select("*")._jdf.queryExecution().executedPlan().toString()   # not run yet: one plan
    assert physical.count("rangepartitioning") == 1 and "hashpartitioning" not in physical and "SinglePartition" not in physical
    assert ".checkpoint(" not in inspect.getsource(keys)


def test_hot_keys_are_counted_in_two_levels(spark):
    """Keys above the share wherever their rows lie; long keys, numbers; no task merges all sketches."""
    rnd = random.Random(4)
    rows = [("hot", 1)] * 900 + [("late", 2)] * 400 + [(f"k{rnd.randint(0, 3000)}", 3 + i % 700) for i in range(4000)] + [(None, None)] * 300
    fact = spark.createDataFrame(rows, "key string, n long").repartition(23)
    assert sorted(hot_keys(fact, "key", hot_share=0.05)) == ["hot", "late"]
    assert sorted(hot_keys(fact, "n", hot_share=0.05)) == [1, 2]
    assert hot_keys(fact.where("key is null"), "key") == [] == hot_keys(fact.limit(0), "key")
    by_file = spark.createDataFrame([(f"x{i}",) for i in range(5000)] + [("x7",)] * 60, "key string").repartition(40)
    found = hot_keys(by_file, "key", hot_share=0.01)   # a little over the share, thin in each task
    assert "x7" in found and len(found) <= 200
