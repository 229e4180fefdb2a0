"""Natural-key dedup, dense surrogate keys and insert-if-absent.

Dedup (first row wins)
    ``ON CONFLICT (key) DO NOTHING`` keeps one row per natural key. We keep the
    minimum row under a total order of its columns. It is computed as an
    aggregate ``min(struct(...))`` per key, not a window: partial aggregation
    collapses copies map-side, so a key with a third of all rows never reaches
    one task as a whole group.

Dense surrogate keys
    ``SERIAL`` values become dense keys ordered by the natural key, starting at
    ``max(existing) + 1``. Rows are counted per range of the key first: ranges are
    prefixes of the order columns' own values (leading characters, leading bits),
    refined until none holds more than ``encore.keys.rangeRows`` rows. A range's
    offset is the number of rows in the ranges before it, and a row's key is that
    plus its rank within its range. Ranges and offsets follow from the values
    alone, so a task that is run again gives the same keys: nothing is
    checkpointed and no single task orders more than a range. A frame whose
    size estimate is small is one range, without a count.

Insert-if-absent
    dedup the batch, ``left_anti`` against the existing natural keys, assign
    keys after the existing maximum, append.
"""

from __future__ import annotations

import functools
import operator
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .joins import UNKNOWN_SIZE, broadcast_limit, fits_broadcast, lookup_join, shuffled

_CNT = "_k_cnt"
_OFF = "_k_off"
_RANK = "_k_rank"
_HASH = "_k_hash"


def _as_list(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def dedup_first(df: DataFrame, keys: str | Sequence[str],
                order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the minimum under ``order`` (default: all other columns).

    Ordering is ascending with NULLs first, field by field.
    """
    keys = _as_list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else rest
    tail = [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c) for c in order + tail]).alias("_first")
    return (df.groupBy(*keys).agg(F.min(packed).alias("_first"))
            .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + tail])
            .select(*df.columns))


SMALL_FRAME_BYTES = 16 * 1024 * 1024
BYTES_PER_PARTITION = 128 * 1024 * 1024
MAX_PARTITIONS = 1_000_000


def small_frame_limit(spark) -> int:
    return int(spark.conf.get("encore.keys.smallFrameBytes", str(SMALL_FRAME_BYTES)))


def default_partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partitions_for(size_bytes: int | None, spark) -> int:
    """Range partitions for an input of ``size_bytes`` (scan estimate): ~128 MB each,
    never fewer than the session's shuffle partitions."""
    base = default_partitions(spark)
    # No estimate, or Catalyst's "unknown" default (Long.MaxValue): keep the base.
    if not size_bytes or size_bytes >= UNKNOWN_SIZE:
        return base
    per = int(spark.conf.get("encore.keys.bytesPerPartition", str(BYTES_PER_PARTITION)))
    return min(MAX_PARTITIONS, max(base, -(-int(size_bytes) // per)))


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to shared scratch and read back: evaluated once, safe against lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dedup_first_rare(df: DataFrame, key: str, order: Sequence[str] | None = None) -> DataFrame:
    """``dedup_first`` for inputs where duplicated keys are rare.

    A narrow pass counts rows per key (partial aggregation, only the key is
    shuffled) and writes the repeated keys. Their rows are picked by a size-checked
    semi-join and go through the first-row-wins aggregate; all other rows pass
    through an anti-join with the same keys. NULL keys form one group, as in
    ``dedup_first``. The result is the same as that of ``dedup_first``.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    repeated = written_once(counts.where(F.col("_n") > 1).select(key), "repeated-keys")
    twice = lookup_join(df, repeated, key, "left_semi").unionByName(df.where(F.col(key).isNull()))
    once = lookup_join(df.where(F.col(key).isNotNull()), repeated, key, "left_anti")
    return once.unionByName(dedup_first(twice, key, order))


def max_key(existing: DataFrame | None, key: str) -> int:
    """Largest existing surrogate key (0 for an empty or absent table)."""
    if existing is None:
        return 0
    row = existing.agg(F.max(key).alias("m")).collect()[0]
    return int(row["m"] or 0)


RANGE_ROWS = 1_000_000
#: Offsets of key ranges are broadcast up to this size; beyond it they are joined by a shuffle.
OFFSETS_BYTES = 2 * 1024 * 1024
_RANGE = "_k_range"


def range_rows(spark) -> int:
    return int(spark.conf.get("encore.keys.rangeRows", str(RANGE_ROWS)))


def _refinements(df: DataFrame, order_cols: list[str], wanted_bits: int):
    """Ever finer lists of range columns, each constant on consecutive rows in the order of ``order_cols``.

    Numbers start with their leading ``wanted_bits``: enough ranges if their values are spread evenly."""
    exact: list = []
    for name in order_cols:
        kind = df.schema[name].dataType
        col = F.col(name)
        if isinstance(kind, T.StringType):
            low, high, longest = df.agg(F.min(col), F.max(col), F.max(F.length(col))).first()
            common = len(os.path.commonprefix([low or "", high or ""]))   # shared by all values between
            for length in range(common + 2, (longest or 0) + 2, 2):
                yield [*exact, F.substring(col, 1, length)]
        elif isinstance(kind, (T.IntegralType, T.DateType)):
            number = F.unix_date(col) if isinstance(kind, T.DateType) else col.cast("long")
            low, high = df.agg(F.min(number), F.max(number)).first()
            bits = ((high or 0) - (low or 0)).bit_length()
            for shift in range(bits - wanted_bits, 0, -4):
                yield [*exact, F.shiftright(number - F.lit(low or 0), shift)]
        exact = [*exact, col]
        yield exact


def key_ranges(df: DataFrame, order_cols: list[str], limit: int) -> tuple[list, DataFrame | None]:
    """(range columns, rows per range) of the coarsest refinement whose ranges hold at most ``limit`` rows."""
    rows = df.count()
    if rows <= limit:
        return [], None
    keys = df.select(*order_cols)
    for columns in _refinements(keys, order_cols, (4 * rows // limit).bit_length()):
        named = [c.alias(f"{_RANGE}{i}") for i, c in enumerate(columns)]
        counts = written_once(keys.groupBy(*named).agg(F.count(F.lit(1)).alias(_CNT)), "key-ranges")
        if counts.agg(F.max(_CNT)).first()[0] <= limit:
            break
    return columns, counts


OFFSET_ROWS = 500_000
_PART = "_k_part"


def range_offsets(counts: DataFrame, names: list[str]) -> DataFrame:
    """(<name>o, offset) of every range: the rows in the ranges before it, in the order of ``names``.

    Ranges are summed within ordered parts and the parts' sums within one row a part, so no task sums
    over all ranges."""
    parts = max(default_partitions(counts.sparkSession), -(-counts.count() // OFFSET_ROWS))
    placed = written_once(counts.repartitionByRange(parts, *names).withColumn(_PART, F.spark_partition_id()), "placed-ranges")
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    heads = (placed.groupBy(_PART).agg(F.sum(_CNT).alias(_CNT))
             .select(_PART, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias("_k_head")))
    inner = Window.partitionBy(_PART).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn(_OFF, F.coalesce(F.sum(_CNT).over(inner), F.lit(0))).join(F.broadcast(heads), _PART)
    return written_once(summed.select(*[F.col(n).alias(f"{n}o") for n in names], (F.col(_OFF) + F.col("_k_head")).alias(_OFF)), "key-offsets")


def assign_dense_keys(df: DataFrame, order_cols: str | Sequence[str], key: str,
                      start: int = 0, num_partitions: int | None = None,
                      size_hint: int | None = None) -> DataFrame:
    """Add ``key`` = start + 1, 2, ... in ``order_cols`` order (unique values).

    ``size_hint`` is an upper bound of the input size in bytes (for instance the
    scan a joined frame came from, whose own estimate Catalyst inflates).
    """
    order_cols = _as_list(order_cols)
    spark = df.sparkSession
    limit = small_frame_limit(spark)
    small = limit > 0 and ((size_hint < limit) if size_hint is not None else fits_broadcast(df, limit))
    ranges: list = []
    if not small or (num_partitions is not None and size_hint is None):
        df = written_once(df, "rows-to-key")   # counted, refined and ranked from there: made once
        ranges, counts = key_ranges(df, order_cols, range_rows(spark))
    if not ranges:
        # One range: a single ordered pass, bounded by the size check or the count.
        rank = F.row_number().over(Window.orderBy(*order_cols))
        return df.select((F.lit(int(start)) + rank).cast("long").alias(key), *df.columns)
    names = [f"{_RANGE}{i}" for i in range(len(ranges))]
    offsets = range_offsets(counts, names)
    n = num_partitions or default_partitions(spark)
    # Range partitions of whole key ranges: rows arrive ordered for a write by the leading column, and the
    # window below needs no exchange of its own.
    ranged = df.withColumns(dict(zip(names, ranges))).repartitionByRange(n, *names)
    rank = F.row_number().over(Window.partitionBy(*names).orderBy(*order_cols))
    ranked = ranged.withColumn(_RANK, rank)
    if fits_broadcast(offsets, broadcast_limit(offsets, OFFSETS_BYTES)):
        # By hash, as in ``join_by_hash``; structs compare null-safe.
        own, other = F.struct(*names), F.struct(*[F.col(f"{n}o") for n in names])
        side = F.broadcast(offsets.withColumn(_HASH, F.xxhash64(*[f"{n}o" for n in names])))
        keyed = ranked.join(side, (F.xxhash64(*names) == F.col(_HASH)) & (own <= other) & (own >= other))
    else:
        keyed = ranked.join(shuffled(offsets), functools.reduce(operator.and_, [F.col(n).eqNullSafe(F.col(f"{n}o")) for n in names]))
    return keyed.select((F.lit(int(start)) + F.col(_OFF) + F.col(_RANK)).cast("long").alias(key), *df.columns)


def new_rows(incoming: DataFrame, existing: DataFrame | None, nk: str | Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose natural key is absent from ``existing``."""
    nk = _as_list(nk)
    if existing is None:
        return incoming
    not_null = F.col(nk[0]).isNotNull()
    for c in nk[1:]:
        not_null = not_null & F.col(c).isNotNull()
    # No distinct on the existing keys: repeats cannot change an anti-join.
    known = existing.select(*nk).where(not_null)
    if len(nk) == 1:
        # ``incoming`` is deduplicated: one row per key, nothing hot to split.
        return lookup_join(incoming, known, nk[0], "left_anti", split_hot=False)
    return incoming.join(known if fits_broadcast(known) else shuffled(known), nk, "left_anti")


def insert_if_absent(incoming: DataFrame, existing: DataFrame | None, nk: str | Sequence[str],
                     key: str, order_cols: str | Sequence[str] | None = None,
                     num_partitions: int | None = None, start: int | None = None,
                     rare_duplicates: bool = False, size_hint: int | None = None) -> DataFrame:
    """The keyed rows to append: first row per new natural key, keys after max(existing).

    ``existing`` is what the batch is deduplicated against; pass ``start`` when
    that is only a slice of the table (the largest key of the whole table).
    ``rare_duplicates`` picks the dedup that shuffles only the key column unless
    many keys repeat (single-column natural keys).
    """
    nk = _as_list(nk)
    if rare_duplicates and len(nk) == 1:
        batch = dedup_first_rare(incoming, nk[0])
    else:
        batch = dedup_first(incoming, nk)
    fresh = new_rows(batch, existing, nk)
    if start is None:
        start = max_key(existing, key)
    return assign_dense_keys(fresh, order_cols or nk, key, start=start,
                             num_partitions=num_partitions, size_hint=size_hint)
