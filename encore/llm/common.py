"""Helpers shared by the operators of this package: inputs, shared scratch, text units."""

from __future__ import annotations

import ctypes
import gc
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.session import configure, scratch_path

# White space of the word definition: space and \t \n \v \f \r.
WORD_RE = r"[^\x20\x09-\x0D]+"
# White space of the tokenizers' \s (the Unicode White_Space property).
UNICODE_WS = "\t-\r \x85\xa0  -     　"
GPT_CHUNK = re.compile(f" ?[^{UNICODE_WS}]+|[{UNICODE_WS}]+(?![^{UNICODE_WS}])|[{UNICODE_WS}]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column name as a reference, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def unused(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``docs`` is called."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Text of one Arrow batch to a Python worker. Spark's limit is 10,000 rows or 64 MB: batches of texts then took tens of
#: MB beside the heap, in buffers that grow by doubling and are kept, and as much in the worker.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most about BATCH_BYTES from here on; a lower limit of the session stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    limit = spark.conf.get(name, None)
    if limit is None or not limit.isdigit() or not 0 < int(limit) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared scratch and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    configure(spark)
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id belongs to fold 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds, F.lit(0))


class WorkerModel:
    """One model in the memory of a Python worker: workers are used again by other operators, so a model
    goes when another is asked for or when ``clear`` is called at the start of a task that needs the room."""

    def __init__(self):
        self.key, self.model = None, None

    def get(self, key, build):
        if key != self.key:
            self.clear()
            self.key, self.model = key, build()
        return self.model

    def clear(self) -> None:
        if self.key is not None:
            self.key, self.model = None, None
            gc.collect()


#: Of this worker.
worker_model = WorkerModel()


def free_memory() -> None:
    """Give back to the system what earlier tasks of this Python worker left: its model, and the free pages
    that Arrow's and the C library's allocators keep. Workers of all stages live as long as their executor."""
    worker_model.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):   # not glibc
        pass


def fold_of(doc_id, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled rows, chosen by a hash of the id.

    The labels' sample is the broadcast side: its row bound is ``max_rows``, two small columns each.
    Rows with a null id or label teach nothing.
    """
    picked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
              .filter("doc_id is not null and label is not null")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
            .join(F.broadcast(picked), "doc_id"))
