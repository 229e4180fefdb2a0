"""Join strategies for many-to-one lookups of a large fact onto a dimension.

* A dimension is broadcast only behind a size check (Catalyst's estimate of
  the optimised plan, in bytes) against a configurable limit. The estimate is of
  compressed Parquet: the relation that the driver collects and sends out is larger,
  and a load makes many of them. So the limit is low: what a load
  broadcasts stays bounded however large its dimensions are.
* Above the limit the join is a shuffle join, by hint: Spark's own threshold, of 10 MB in the
  same estimate, would broadcast it after all. A key that holds a large share of
  the fact rows (one user or one song with a third of all plays) would put all
  those rows into one task, so hot keys are split off first: one pass over the
  raw key column, salted sketches of frequent keys merged by key, finds every
  key above ``hot_share`` of the rows and returns at most ``2 / hot_share`` keys -
  a bound by construction - so their dimension rows (at most that many, the
  dimension being unique on the key) are broadcast. Only the cold rows are
  shuffled. The result is exact either way; detection only affects speed.
* Spark's hash table of text keys takes a memory page (up to 64 MB) however few rows it holds, one of whole
  numbers a megabyte. So where a side is or may be broadcast, text keys are joined on their 64-bit hash
  and compared as well: a load of many batches broadcasts many small relations.
* AQE's skew-join split stays on as a second line of defence.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_LIMIT = 256 * 1024
UNKNOWN_SIZE = 2 ** 62
DEFAULT_HOT_SHARE = 1e-3
DEFAULT_SAMPLE_FRACTION = 1.0


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (None when not available)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # noqa: BLE001 - e.g. Spark Connect sessions
        return None


def broadcast_limit(df: DataFrame, default: int = DEFAULT_BROADCAST_LIMIT) -> int:
    conf = df.sparkSession.conf.get("encore.broadcast.limit.bytes", None)
    return int(conf) if conf else default


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= (broadcast_limit(df) if limit is None else limit)


def all_fit_broadcast(*dfs: DataFrame, limit: int | None = None) -> bool:
    """True when every frame passes the broadcast size check."""
    return all(fits_broadcast(df, limit) for df in dfs)


def size_known(dim: DataFrame) -> bool:
    size = estimated_bytes(dim)
    return size is not None and size < UNKNOWN_SIZE


def shuffled(dim: DataFrame) -> DataFrame:
    """``dim`` as the side of a join that must not be broadcast; one of unknown size is not, the other side may be."""
    return dim.hint("merge") if size_known(dim) else dim


def join_by_hash(fact: DataFrame, dim: DataFrame, on: str, how: str, broadcast: bool = True) -> DataFrame:
    """``fact.join(dim, on, how)`` (inner, left, left_semi or left_anti); text keys meet by a 64-bit hash.

    The keys themselves are compared too, so the result is exact. The comparison is by order, as
    Catalyst would take an equality as a second join key, and the relation would have text keys again."""
    hashed, other = f"_{on}_hash", f"_{on}_other"
    if not all(type(df.schema[on].dataType) is T.StringType for df in (fact, dim)):
        return fact.join(F.broadcast(dim) if broadcast else dim, on, how)
    side = dim.withColumnRenamed(on, other).withColumn(hashed, F.xxhash64(other))
    same = (F.xxhash64(on) == F.col(hashed)) & (F.col(on) <= F.col(other)) & (F.col(on) >= F.col(other))
    joined = fact.join(F.broadcast(side) if broadcast else side, same, how)
    added = [] if how in ("left_semi", "left_anti") else [c for c in dim.columns if c != on]
    return joined.select(on, *[c for c in fact.columns if c != on], *added)


def hot_keys(fact: DataFrame, key: str, hot_share: float = DEFAULT_HOT_SHARE,
             sample_fraction: float = 1.0, seed: int = 17) -> list:
    """Keys that may hold at least ``hot_share`` of the rows of ``fact``.

    Counted in two levels, so no task sees the sketches of all others: tasks are dealt to about the root of
    their number of salts, each salt keeps a sketch of its most frequent keys, and the keys' counts are
    then added up by key. A salt lists 4 / ``hot_share`` keys, so a key above the share loses at most a
    third of its count; the list misses no hot key and holds at most 2 / ``hot_share``.
    ``sample_fraction`` < 1 trades that guarantee for less work.
    """
    column = fact.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    if sample_fraction < 1.0:
        column = column.sample(fraction=sample_fraction, seed=seed)
    share = max(hot_share, 1e-4)
    listed, bound = math.ceil(4 / share), math.ceil(2 / share)
    salts = math.isqrt(int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    sketches = (column.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts))).groupBy("salt")
                .agg(F.expr(f"approx_top_k(k, {listed}, {4 * listed})").alias("top"), F.count(F.lit(1)).alias("n")))
    # The number of rows goes along as the count of a key NULL.
    rows = F.struct(F.lit(None).cast(column.schema["k"].dataType).alias("item"), F.col("n").alias("count"))
    counts = (sketches.select(F.explode(F.concat("top", F.array(rows))).alias("e"))
              .groupBy("e.item").agg(F.sum("e.count").alias("n")).orderBy(F.desc("n")).limit(bound + 1).collect())
    total = next((r["n"] for r in counts if r["item"] is None), 0)
    return [r["item"] for r in counts if r["item"] is not None and r["n"] >= share * total / 2]


def _shuffle_join(fact: DataFrame, dim: DataFrame, on: str, how: str) -> DataFrame:
    # Of unknown size, AQE may still find one side small and broadcast it.
    return fact.join(shuffled(dim), on, how) if size_known(dim) else join_by_hash(fact, dim, on, how, broadcast=False)


def lookup_join(fact: DataFrame, dim: DataFrame, on: str, how: str = "inner",
                limit: int | None = None, hot_share: float = DEFAULT_HOT_SHARE,
                sample_fraction: float = DEFAULT_SAMPLE_FRACTION,
                split_hot: bool | None = None, hot_from: DataFrame | None = None) -> DataFrame:
    """Join ``fact`` to ``dim`` (unique on ``on``), many-to-one.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. ``hot_from``
    is the frame whose ``on`` column is sampled for hot keys (default ``fact``);
    pass the cheapest frame that carries the raw key (a table scan rather than
    a joined or aggregated frame that would be recomputed for the sample).
    """
    if fits_broadcast(dim, limit):
        return join_by_hash(fact, dim, on, how)
    if split_hot is None:
        split_hot = fact.sparkSession.conf.get("encore.join.splitHotKeys", "true") == "true"
    if not split_hot:
        return _shuffle_join(fact, dim, on, how)
    hot = hot_keys(fact if hot_from is None else hot_from, on, hot_share, sample_fraction)
    if not hot:
        return _shuffle_join(fact, dim, on, how)
    is_hot = F.col(on).isin(hot)
    hot_part = join_by_hash(fact.where(is_hot), dim.where(is_hot), on, how)
    cold_part = _shuffle_join(fact.where(~is_hot | F.col(on).isNull()), dim.where(~is_hot), on, how)
    return hot_part.unionByName(cold_part)
