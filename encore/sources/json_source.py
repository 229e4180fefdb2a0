"""JSON source files -> typed staging tables, with the loader's defaults.

Layouts
    ``lines``  one JSON object per line (JSON Lines): splittable, one task per
               file split - the layout for event volumes.
    ``array``  one JSON array per file, indented or not: byte-range splits with
               a search for record boundaries, so a file is read by many tasks
               (``json_array``).

Parsing
    Every record is first parsed with an all-string schema and then each field
    is ``try_cast`` to its declared type. A bad value therefore rejects only
    its own record (listed in ``_rejected``), never the whole file, and
    ``json_object_keys`` tells an absent key from an explicit ``null``: the
    loader's defaults (``is_active`` true, ``is_explicit`` and ``was_skipped``
    false) apply only when the key is absent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .json_array import array_objects
from .staging import Staging

# Loader defaults, applied only when the key is absent from the record.
DEFAULTS_WHEN_ABSENT = {
    "stg_artists": {},
    "stg_songs": {"is_explicit": False},
    "stg_users": {"is_active": True},
    "stg_stream_events": {"was_skipped": False},
}

SOURCE_SCHEMAS = {
    "stg_artists": schemas.ARTIST_SOURCE,
    "stg_songs": schemas.SONG_SOURCE,
    "stg_users": schemas.USER_SOURCE,
    "stg_stream_events": schemas.EVENT_SOURCE,
}

SOURCE_FILES = {
    "stg_artists": "artists",
    "stg_songs": "songs",
    "stg_users": "users",
    "stg_stream_events": "stream_events",
}

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def json_objects(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """One row per JSON object, column ``value`` holding the object's text."""
    if layout == "lines":
        return spark.read.text(path).where(F.length(F.trim("value")) > 0)
    if layout == "array":
        return array_objects(spark, path)
    raise ValueError(f"unknown JSON layout {layout!r}")


def parse_objects(objects: DataFrame, schema: T.StructType,
                  defaults: dict | None = None) -> DataFrame:
    """Typed columns of ``schema``, ``_n_bad`` (failed fields, -1 for a malformed
    record) and ``_rejected`` (their names)."""
    defaults = defaults or {}
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parsed = objects.select(F.from_json("value", raw_schema).alias("r"),
                            F.json_object_keys("value").alias("_keys"))
    cols, bad, flags = [], [], []
    for f in schema.fields:
        raw = F.col(f"r.{f.name}")
        typed = raw.try_cast(f.dataType)
        if f.name in defaults:
            absent = ~F.coalesce(F.array_contains("_keys", f.name), F.lit(False))
            typed = F.when(absent, F.lit(defaults[f.name]).cast(f.dataType)).otherwise(typed)
        cols.append(typed.alias(f.name))
        failed = raw.isNotNull() & typed.isNull()
        bad.append(F.when(failed, F.lit(f.name)))
        flags.append(failed.cast("int"))
    malformed = F.col("_keys").isNull()
    # Integer count for the accept / reject split (code-generated arithmetic);
    # the list of failed fields is only computed where rejects are read.
    n_bad = F.when(malformed, F.lit(-1)).otherwise(sum(flags[1:], flags[0]))
    detail = F.when(malformed, F.array(F.lit("_record"))).otherwise(F.array_compact(F.array(*bad)))
    return parsed.select(*cols, n_bad.alias("_n_bad"), detail.alias("_rejected"))


def ingest(spark: SparkSession, path: str, table: str, layout: str = "lines") -> DataFrame:
    """Parse one source into its staging table shape (with ``_rejected``)."""
    parsed = parse_objects(json_objects(spark, path, layout), SOURCE_SCHEMAS[table],
                           DEFAULTS_WHEN_ABSENT[table])
    target = schemas.STAGING[table]
    cols = [F.col(f.name) if f.name in parsed.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields]
    return parsed.select(*cols, "_n_bad", "_rejected")


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("_n_bad") == 0).drop("_n_bad", "_rejected")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("_n_bad") != 0).drop("_n_bad")


LOAD_STATUS = "_load_status"


def land_staging(spark: SparkSession, sources_root: str, staging_root: str,
                 layout: str = "lines", mode: str = "overwrite") -> str:
    """Parse each source once and write it partitioned by load status.

    ``<table>/_load_status=accepted`` is the staging table,
    ``<table>/_load_status=rejected`` the quarantine (with the failed fields).
    Splitting by a partition column instead of filtering keeps the parse to one
    evaluation per record: a filter on the parse result would be pushed below
    it and re-parse every record. Every record is stamped ``loaded_at``.
    """
    from ..plans.parallel import run_all

    sources_root, staging_root = sources_root.rstrip("/"), staging_root.rstrip("/")

    def land(table: str, name: str):
        parsed = ingest(spark, f"{sources_root}/{name}.json", table, layout)
        ok = F.col("_n_bad") == 0
        out = (parsed.withColumn("_rejected", F.when(~ok, F.col("_rejected")))
               .withColumn("loaded_at", F.current_timestamp())
               .withColumn(LOAD_STATUS, F.when(ok, F.lit("accepted")).otherwise(F.lit("rejected")))
               .drop("_n_bad"))
        # A full replace: partitions absent from this load must not survive it.
        return lambda: (out.write.mode(mode).option("partitionOverwriteMode", "static")
                        .partitionBy(LOAD_STATUS).parquet(f"{staging_root}/{table}"))

    run_all(land(t, n) for t, n in SOURCE_FILES.items())
    return staging_root


def ingest_staging(spark: SparkSession, root: str, layout: str = "lines") -> Staging:
    """The four staging tables from ``root/<source>.json`` (accepted records only)."""
    root = root.rstrip("/")
    tables = {t: accepted(ingest(spark, f"{root}/{name}.json", t, layout))
              for t, name in SOURCE_FILES.items()}
    return Staging(tables["stg_artists"], tables["stg_songs"], tables["stg_users"],
                   tables["stg_stream_events"])


def ingest_report(spark: SparkSession, root: str, layout: str = "lines") -> DataFrame:
    """Records read and rejected per source file (one aggregate pass per file)."""
    root = root.rstrip("/")
    out = None
    for table, name in SOURCE_FILES.items():
        df = ingest(spark, f"{root}/{name}.json", table, layout)
        one = df.agg(F.count(F.lit(1)).cast("long").alias("records"),
                     F.count_if(F.col("_n_bad") != 0).cast("long").alias("rejected")).select(
            F.lit(f"{name}.json").alias("source_file"), "records", "rejected")
        out = one if out is None else out.unionByName(one)
    return out


def landing_report(spark: SparkSession, staging_root: str) -> DataFrame:
    """Records read and rejected per source, from the landed (status-partitioned)
    staging: counts of Parquet rows, no second parse of the raw text."""
    staging_root = staging_root.rstrip("/")
    out = None
    for table, name in SOURCE_FILES.items():
        landed = spark.read.parquet(f"{staging_root}/{table}").select(LOAD_STATUS)
        one = landed.agg(F.count(F.lit(1)).cast("long").alias("records"),
                         F.count_if(F.col(LOAD_STATUS) == "rejected").cast("long").alias("rejected")
                         ).select(F.lit(f"{name}.json").alias("source_file"), "records", "rejected")
        out = one if out is None else out.unionByName(one)
    return out


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write records as JSON Lines; NULLs are kept as explicit ``null`` values."""
    (df.write.mode(mode).option("ignoreNullFields", False)
       .option("timestampFormat", TIMESTAMP_FORMAT).json(path))


def write_sources(staging: Staging, root: str, mode: str = "overwrite") -> str:
    """Land staging-shaped records as the four JSON Lines source folders."""
    from ..plans.parallel import run_all

    root = root.rstrip("/")

    def land(table: str, name: str):
        df = staging.table(table).select(*[f.name for f in SOURCE_SCHEMAS[table].fields])
        return lambda: write_json_lines(df, f"{root}/{name}.json", mode)

    run_all(land(t, n) for t, n in SOURCE_FILES.items())
    return root
