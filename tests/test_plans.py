"""Plan-shape assertions: pruning, broadcasts, no Cartesian products, bounded windows."""

from __future__ import annotations

from conftest import SF_SMALL

from encore.operators import quality, report
from encore.plans.warehouse import driver_star


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + "\n" + qe.optimizedPlan().toString()


def test_q1_prunes_fact_partitions_and_ranks_after_limit(spark):
    star = driver_star(spark, SF_SMALL)
    df = report.trending_songs(star, "2024-01-31")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(date_key" in plan and "date_key#" in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # the global window runs on the output of TakeOrderedAndProject (k rows)
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert physical.index("Window") < physical.index("TakeOrderedAndProject")


def test_q4_prunes_to_both_windows(spark):
    star = driver_star(spark, SF_SMALL)
    plan = _plan(report.breakout_artists(star, "2024-01-31", window_days=15))
    assert "PartitionFilters" in plan and "20240101" in plan and "CartesianProduct" not in plan


def test_scans_read_only_needed_columns(spark):
    star = driver_star(spark, SF_SMALL)
    plan = report.genre_skip_rates(star)._jdf.queryExecution().executedPlan().toString()
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    fact_scans = [s for s in schemas if "was_skipped" in s]
    assert fact_scans
    for schema in fact_scans:
        assert "listened_at" not in schema and "platform" not in schema and "event_id" not in schema


def test_no_cartesian_products_anywhere(spark):
    star = driver_star(spark, SF_SMALL)
    frames = [report.free_vs_premium(star), report.genre_skip_rates(star),
              quality.completion_distribution(star.fact_streams), quality.fact_sample(star),
              quality.fk_audit(star)]
    for df in frames:
        assert "CartesianProduct" not in _plan(df)


def _large_dims(spark):
    spark.conf.set("encore.broadcast.limit.bytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def _reset(spark):
    spark.conf.unset("encore.broadcast.limit.bytes")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_dimensions_are_joined_after_pre_aggregation(spark):
    star = driver_star(spark, SF_SMALL)
    _large_dims(spark)
    try:
        plan = _physical(report.genre_skip_rates(star))
    finally:
        _reset(spark)
    # every sort-merge join reads an aggregated side, never the raw fact scan
    assert "SortMergeJoin" in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SortMergeJoin" in line:
            below = "\n".join(lines[i:i + 12])
            assert "HashAggregate" in below


def test_hot_keys_are_broadcast_and_cold_keys_shuffled(spark):
    from pyspark.sql import functions as F

    from encore.operators.joins import lookup_join
    fact = spark.range(4000).select((F.when(F.col("id") % 3 == 0, F.lit(7))
                                     .otherwise(F.col("id") % 200)).alias("k"), "id")
    dim = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    _large_dims(spark)
    try:
        joined = lookup_join(fact, dim, "k", hot_share=0.05)
        plan = _physical(joined)
        assert joined.count() == 4000
    finally:
        _reset(spark)
    assert "Union" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def test_fact_sample_pushes_the_key_bound_to_parquet(spark):
    star = driver_star(spark, SF_SMALL)
    plan = _physical(quality.fact_sample(star))
    assert "LessThanOrEqual(stream_key,10)" in plan
