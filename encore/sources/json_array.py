"""JSON array files read in parallel: one file, many tasks.

An array file (``[ {...}, {...} ]``, indented or not) has no line per record, so Spark reads it one task a
file. Here the text source reads it in byte-range splits with ``}`` as its line separator: the Hadoop
reader finds the next ``}`` after a split's start itself. What a piece of text between two braces is
depends on all before it, in two facts only: whether it starts inside a string and how deep it is nested.
Both compose over splits, so a file is read in two passes:

1. ``split_states``: each split gives the parity of its quotes and its change of depth under either
   assumption (starts inside a string, or not). Running sums over the splits of a file (one row a
   split) turn these into the true state at each split's start.
2. ``_cut``: each split, knowing its state, cuts its text into whole records and, at its ends, the parts
   of records that cross into other splits. Parts of one record are then joined by key.

Records are the objects of the array, at any indentation, with nested objects and braces in strings. Text
between records that is no separator (a number, a string, garbage) comes out as a record of its own, which
field-wise parsing rejects. A file that ends inside a string or an object gives its rest as one such record.
An empty file or array has no records. Compressed files are one split, as everywhere in Spark.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_limit, fits_broadcast
from ..operators.keys import written_once

_ESCAPED = re.compile(r"\\.", re.S)
_BRACKETS = re.compile(r'["{}\[\]]')
_SEPARATORS = "[], \t\r\n﻿"

SPLIT = ["file", "start"]
#: The states of all splits are broadcast up to this size (thousands of splits); beyond it the text is shuffled.
STATES_BYTES = 8 * 1024 * 1024


def _scan(text: str, in_string: bool, depth: int):
    """(in_string, depth) after ``text``; escapes never cross a piece, since a brace is never escaped."""
    plain = _ESCAPED.sub("", text) if "\\" in text else text
    parts = plain.split('"')
    for part in parts[int(in_string)::2]:
        depth += part.count("{") + part.count("[") - part.count("}") - part.count("]")
    return in_string ^ (len(parts) % 2 == 0), depth


def split_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, at, piece): the text between closing braces, in order of ``at`` within a split."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece"))


def _summaries(batches):
    """One row a split: (file, start, quotes odd, depth change from outside a string, from inside)."""
    names = ["file", "start", "odd", "outside", "inside"]
    key, states = None, None

    def row():
        (s0, d0), (_, d1) = states
        return pa.RecordBatch.from_pylist([dict(zip(names, (*key, int(s0), d0, d1)))],
                                          pa.schema([("file", pa.string()), ("start", pa.int64()), ("odd", pa.int32()), ("outside", pa.int64()), ("inside", pa.int64())]))

    for batch in batches:
        for file, start, piece in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "piece"))):
            if (file, start) != key:
                if key is not None:
                    yield row()
                key, states = (file, start), [(False, 0), (True, 0)]
            for k, (in_string, depth) in enumerate(states):
                in_string, depth = _scan(piece, in_string, depth)
                states[k] = in_string, depth - (not in_string)   # the brace that ended the piece
    if key is not None:
        yield row()


def split_states(pieces: DataFrame) -> DataFrame:
    """(file, start, in_string, depth) at each split's start: one row a split, summed along each file."""
    splits = pieces.select("file", "start", "piece").mapInArrow(
        _summaries, "file string, start long, odd int, outside long, inside long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.withColumn("in_string", F.pmod(F.coalesce(F.sum("odd").over(before), F.lit(0)), F.lit(2)) == 1)
    change = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    return (placed.withColumn("change", change)
            .select("file", "start", "in_string", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth")))


WHOLE, OPENED, MIDDLE, CLOSED = "whole", "opened", "middle", "closed"
_PARTS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("value", pa.string())])


def _cut(batches):
    """Records of each split, and the parts of records that cross its ends."""
    out, key, state = [], None, None

    def emit(kind, text):
        out.append((*key, kind, text))

    def finish():
        # what is left at the split's end goes on in the next split, or is the end of the file
        text = "".join(state["held"])
        if state["crossing"]:
            emit(MIDDLE, text)
        elif text:
            emit(OPENED, text)

    def batch():
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PARTS)], schema=_PARTS)
        out.clear()
        return made

    last = -1
    for arrived in batches:
        columns = [arrived.column(c).to_pylist() for c in ("file", "start", "at", "piece", "in_string", "depth")]
        for file, start, at, piece, in_string, depth in zip(*columns):
            if at <= last:
                raise ValueError("pieces of a split arrived out of order")
            last = at
            if (file, start) != key:
                if key is not None:
                    finish()
                # pieces that start in a split are read there: the first begins a record, or goes on with one
                key, state = (file, start), {"in_string": in_string, "depth": depth, "held": [], "crossing": in_string or depth > 1}
            inside, depth = _scan(piece, state["in_string"], state["depth"])
            if not inside and depth == 0:
                # the array is closed: no brace ended this piece
                emit(WHOLE, piece)
                state["depth"] = 0
                continue
            depth -= not inside
            state["in_string"], state["depth"] = inside, depth
            state["held"].append(piece + "}")
            if not inside and depth == 1:
                text, state["held"] = "".join(state["held"]), []
                emit(CLOSED if state["crossing"] else WHOLE, text)
                state["crossing"] = False
            if len(out) >= 4096:
                yield batch()
    if key is not None:
        finish()
    if out:
        yield batch()


def _object_of(text: str, closed: bool) -> list[str]:
    """A record's text without the separators before it; what else stands before its brace is a record too."""
    text = text.lstrip(_SEPARATORS)
    if not text:
        return []
    if not closed:   # the file ended inside it
        return [text]
    if text.startswith("{"):
        return [text]
    in_string = False
    # records of other kinds stand before the first brace, or alone behind the last record
    for found in _BRACKETS.finditer(_ESCAPED.sub("..", text)):
        if found.group() == '"':
            in_string = not in_string
        elif found.group() == "{" and not in_string:
            return [*_elements(text[:found.start()].rstrip(_SEPARATORS)), text[found.start():]]
    return _elements(text.rstrip(_SEPARATORS))


def _elements(text: str) -> list[str]:
    """The array elements in a text without objects; the text itself where it is no JSON."""
    try:
        return [json.dumps(e) for e in json.loads(f"[{text}]")]
    except ValueError:
        return [text]


def _objects(batches):
    for arrived in batches:
        values = []
        for text, closed in zip(arrived.column("value").to_pylist(), arrived.column("closed").to_pylist()):
            values.extend(v for v in _object_of(text, closed) if v)
        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])


def array_objects(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the array files under ``path``: column ``value`` holds its text."""
    pieces = split_pieces(spark, path)
    states = written_once(split_states(pieces), "json-splits")
    # One row a split: the text is not moved while they pass the broadcast check.
    if fits_broadcast(states, broadcast_limit(states, STATES_BYTES)):
        placed = pieces.join(F.broadcast(states), SPLIT)
    else:
        placed = pieces.join(states, SPLIT).repartition(*SPLIT).sortWithinPartitions("at")
    cut = placed.select("file", "start", "at", "piece", "in_string", "depth").mapInArrow(
        _cut, "file string, start long, kind string, value string")
    whole = cut.where(F.col("kind") == WHOLE).select("value", F.lit(True).alias("closed"))
    # Parts: a record is opened in one split, fills any number of splits and is closed in a later one. At most
    # two parts a split, so numbering them along the file is bounded by the number of splits.
    parts = cut.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("start", F.when(F.col("kind") == OPENED, 1).otherwise(0))
    numbered = parts.withColumn("record", F.sum(F.when(F.col("kind") == OPENED, 1).otherwise(0)).over(order))
    joined = (numbered.groupBy("file", "record")
              .agg(F.sort_array(F.collect_list(F.struct("start", F.when(F.col("kind") == OPENED, 1).otherwise(0).alias("late"), "value"))).alias("parts"),
                   F.max(F.when(F.col("kind") == CLOSED, 1).otherwise(0)).alias("closed"))
              .select(F.concat_ws("", F.transform("parts", lambda p: p["value"])).alias("value"), (F.col("closed") == 1).alias("closed")))
    return whole.unionByName(joined).mapInArrow(_objects, "value string")


def _array_lines(batches):
    """JSON objects, one a row, as the lines of one indented array a task."""
    held, opened = None, False
    for arrived in batches:
        lines = [] if opened else ["["]
        opened = True
        for value in arrived.column("value").to_pylist():
            if held is not None:
                lines.append(held + ",")
            held = "  " + json.dumps(json.loads(value), indent=2, ensure_ascii=False).replace("\n", "\n  ")
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array([*([] if opened else ["["]), *([] if held is None else [held]), "]"], pa.string())], ["value"])


def write_json_array(objects: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    """Rows of JSON text (column ``value``) as indented array files: ``files`` of them, or one a partition."""
    rows = objects.select("value")
    rows = rows if files is None else rows.repartition(files)
    rows.mapInArrow(_array_lines, "value string").write.mode(mode).text(path)
