"""Structured Streaming ingest of play events into the fact table.

Events arrive as JSON Lines files in a folder (the hourly log files of the
source system). The stream

1. reads new files with a fixed all-string schema and parses each record
   field by field (``sources.json_source.parse_objects``);
2. in ``foreachBatch`` writes the parsed batch once to the warehouse's
   ``_batches/batch=<id>`` folder and works from there: rejected records go to
   a quarantine folder of the batch, the others are resolved together with
   the events still pending from an *earlier* batch, against the dimensions as
   they are now, and inserted if their event id was never loaded;
3. keeps events whose user or song is not known yet in the run's ``pending`` table
   until the dimension row arrives, however many batches that takes.

A batch is published as a whole (``plans/publish.py``): run again after a failure, it starts anew; run
again after its marker exists, it does nothing. An event id is loaded once, whatever timestamp a
re-sent copy carries.

By default no watermark-based late-data drop is used: the result must contain
every valid event, however late. Dedup state is the fact table itself, so the
stream needs no unbounded in-memory state. An opt-in watermark dedup thins
copies in the stream (see ``event_stream``). The checkpoint goes to the shared
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.fact import append_events
from ..plans.loads import fact_writer, key_high_water, latest_pending, loaded_ids, processed_runs
from ..plans.publish import Run, read_or_none, settle
from ..plans.warehouse import FACT
from ..session import scratch_path
from ..sources.json_source import DEFAULTS_WHEN_ABSENT, accepted, parse_objects, rejected


def event_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None,
                 dedup_watermark: str | None = None) -> DataFrame:
    """Parsed events from new files in ``source_dir``.

    ``dedup_watermark`` (e.g. ``"1 hour"``) opts into in-stream dedup of event
    ids with ``withWatermark`` + ``dropDuplicatesWithinWatermark``: copies
    arriving within the delay are dropped before the sink, with state bounded by
    the delay. Spark drops events that arrive later than the watermark, so
    this trades completeness for state size and is off by default; the sink's
    insert-if-absent loads an event id once either way.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(source_dir).where(F.length(F.trim("value")) > 0)
    parsed = parse_objects(lines, schemas.EVENT_SOURCE, DEFAULTS_WHEN_ABSENT["stg_stream_events"])
    if dedup_watermark:
        parsed = (parsed.withWatermark("listened_at", dedup_watermark)
                  .dropDuplicatesWithinWatermark(["event_id"]))
    return parsed


def make_batch_writer(warehouse_root: str, dims_root: str, stream: str = ""):
    """The ``foreachBatch`` function: resolve, insert if absent, park what is unresolved.

    Each batch is a run of its own (``plans/publish.py``): fact rows, ids and pending events are written
    aside and belong to the warehouse once the run's marker exists. A batch that ``stream`` has
    published is not run again; one that was broken off starts anew and leaves nothing behind.
    """
    root = warehouse_root.rstrip("/")
    dims = dims_root.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        settle(spark, root)
        number, done = processed_runs(spark, root)
        name = f"{stream}/{batch_id}"
        if name in done:
            return
        run = Run(spark, root, number)
        run.clear()
        landed = f"{root}/_batches/batch={batch_id}"
        batch.write.mode("overwrite").parquet(landed)
        parsed = spark.read.schema(batch.schema).parquet(landed)
        bad = rejected(parsed)
        if not bad.isEmpty():
            bad.write.mode("overwrite").json(f"{root}/_quarantine/batch={batch_id}")
        events = accepted(parsed)
        pending = latest_pending(spark, root, number)
        if pending is not None:
            events = events.unionByName(pending.select(*events.columns))
        users, songs, dates = (spark.read.schema(schemas.STAR[n]).parquet(f"{dims}/{n}") for n in ("dim_users", "dim_songs", "dim_date"))
        existing = read_or_none(spark, f"{root}/{FACT}", schemas.FACT_STREAMS)
        start = key_high_water(spark, root, existing)
        write, top = fact_writer(run)
        unresolved = append_events(events, users, songs, dates, existing, start, write, loaded_ids(spark, root, events, existing, run))
        run.stage("pending", unresolved)
        run.publish([name], top() or start)
        settle(spark, root)

    return write_batch


def run_stream_ingest(spark: SparkSession, source_dir: str, warehouse_root: str, dims_root: str,
                      checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                      available_now: bool = True, processing_time: str | None = None,
                      dedup_watermark: str | None = None):
    """Start the ingest; with ``available_now`` it processes what is there and stops."""
    checkpoint = checkpoint or scratch_path(spark, "stream-ingest-checkpoint")
    writer = (event_stream(spark, source_dir, max_files_per_trigger, dedup_watermark).writeStream
              .foreachBatch(make_batch_writer(warehouse_root, dims_root, stream=checkpoint))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
