"""An index of loaded ids in hash buckets: membership of a batch without scanning the table.

The index holds the id column only, partitioned by a hash of the id. A batch asks for the buckets its own
ids fall into (a partition filter, so other buckets are neither listed nor read) and an exact
join decides. Every load appends the ids it adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import lookup_join

#: Fixed: the buckets of an index must not change once it is written.
BUCKETS = 64
BUCKET = "bucket"
TABLE = "event_ids"


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def index_rows(rows: DataFrame, key: str) -> DataFrame:
    """(key, bucket) of the rows to add, each bucket in one task and sorted, so it is one file."""
    ids = rows.select(key, bucket_of(key).alias(BUCKET)).where(F.col(key).isNotNull())
    return ids.repartition(BUCKET).sortWithinPartitions(BUCKET, key)


def read_buckets(spark: SparkSession, path: str, key: str, buckets: list[int]) -> DataFrame:
    index = spark.read.schema(f"{key} string, {BUCKET} int").parquet(path)
    return index.where(F.col(BUCKET).isin(buckets)).select(key)


def touched_buckets(incoming: DataFrame, key: str) -> list[int]:
    """The buckets that the batch's ids fall into: at most BUCKETS numbers."""
    ids = incoming.where(F.col(key).isNotNull()).select(bucket_of(key).alias(BUCKET)).distinct()
    return sorted(r[BUCKET] for r in ids.collect())


def known_ids(spark: SparkSession, path: str, incoming: DataFrame, key: str, buckets: list[int]) -> DataFrame:
    """The ids of ``incoming`` that the index holds. ``buckets`` covers all ids of ``incoming``."""
    loaded = read_buckets(spark, path, key, buckets)
    return lookup_join(loaded, incoming.select(key).distinct(), key, "left_semi", split_hot=False)
