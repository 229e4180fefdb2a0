"""Exact deduplication by a tree-merge of sorted digest runs.

Each input partition is a *run*: its rows sorted by digest, one entry per text with the identifier that
stays, the number of copies and what verifies the digest. Runs are merged in binomial rounds: in round k
slot i exchanges with slot i XOR 2^k, by the k-th bit of the digest, and every slot merges the sorted
halves it holds, again to one entry per text. So after k rounds a slot has merged 2^k runs over a
2^k-th of the digests: slots stay the size of a partition, as many as there are runs, and the last
round leaves each digest in one slot, whatever number of rows had it. A digest that a third of all rows
share is one entry of each run and halves its entries every round.

In a merge, entries are equal only when the digest, the byte length and a second, independent hash
are; among equal ones the larger identifier is kept and copies add up. The result goes back to one entry
per (digest, run), then to the rows of that run.

Defined results: texts are equal when identical as they are; null counts as empty. Of equal texts
the row with the largest doc_id stays; a null id is smaller than any other; among rows that repeat
an id, one of them stays. An empty table gives an empty result. A digest is the SHA-256 of the
UTF-8 text. Extra columns are kept by ``deduplicate``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, quoted, unused

KEY = ["digest", "n_bytes", "check"]
RUN_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def _value(text: str) -> Column:
    return F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))


def digest_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per input row: (doc_id, digest, n_bytes, check, row, run), in shared scratch.

    The text is read once and not shuffled. The digest is kept as binary.
    """
    value = _value(text)
    narrow = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.unhex(F.sha2(value, 256)).alias("digest"),
                         F.octet_length(value).cast("long").alias("n_bytes"), F.xxhash64(value).alias("check"),
                         F.monotonically_increasing_id().alias("row"))
    return materialize(narrow, "digest-runs").withColumn("run", F.shiftright("row", RUN_BITS))


#: An entry of a run: the digest as four words (of its bytes in big-endian order), what verifies it, the row that stays, its copies.
ENTRY = np.dtype([("d0", "<u8"), ("d1", "<u8"), ("d2", "<u8"), ("d3", "<u8"), ("n_bytes", "<i8"), ("check", "<i8"),
                  ("has_id", "u1"), ("doc_id", "<i8"), ("row", "<i8"), ("copies", "<i8")])
IDENTITY = ["d0", "d1", "d2", "d3", "n_bytes", "check"]
RUN = "slot int, entries binary"
#: Rounds between two writes to shared scratch: what a lost executor may have to repeat.
ROUNDS_A_WRITE = 4


def merge_runs(runs: list[np.ndarray]) -> np.ndarray:
    """Sorted runs to one sorted run with an entry per text: the largest identifier, all copies."""
    entries = np.concatenate(runs)
    # the sort is stable and finds the runs in order; of equal texts the row that stays comes last
    order = np.lexsort([-entries["row"], entries["doc_id"], entries["has_id"], *(entries[c] for c in reversed(IDENTITY))])
    entries = entries[order]
    last = np.ones(len(entries), bool)
    last[:-1] = np.logical_or.reduce([entries[c][1:] != entries[c][:-1] for c in IDENTITY])
    kept = entries[last].copy()
    ends = np.flatnonzero(last)
    kept["copies"] = np.diff(np.cumsum(entries["copies"])[ends], prepend=0)
    return kept


def _leaf_runs(batches) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each run, sorted and reduced batch by batch; a run may come in several pieces."""
    for batch in batches:
        if not len(batch):
            continue
        entries = np.zeros(len(batch), ENTRY)
        digests = np.frombuffer(b"".join(batch.column("digest").to_pylist()), ">u8").reshape(-1, 4)
        for c in range(4):
            entries[f"d{c}"] = digests[:, c]
        entries["has_id"] = np.asarray(batch.column("doc_id").is_valid())
        for name in ("n_bytes", "check", "row"):
            entries[name] = np.asarray(batch.column(name))
        entries["doc_id"] = np.asarray(batch.column("doc_id").fill_null(0))
        entries["copies"] = 1
        run = entries["row"] >> RUN_BITS
        for r in np.unique(run):
            yield int(r), merge_runs([entries[run == r]])


def _merged(batches) -> Iterator[tuple[int, np.ndarray]]:
    """Runs in order of their slot: each slot's runs merged to one."""
    slot, runs = None, []
    for batch in batches:
        for s, blob in zip(batch.column("slot").to_pylist(), batch.column("entries").to_pylist()):
            if s != slot and runs:
                yield slot, merge_runs(runs)
                runs = []
            slot = s
            runs.append(np.frombuffer(blob, ENTRY))
            if sum(map(len, runs)) > 2 * len(runs[0]) + (1 << 16):
                runs = [merge_runs(runs)]
    if runs:
        yield slot, merge_runs(runs)


def _as_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["slot", "entries"])


def _sent(made, low: int, bits: int):
    """What ``made`` gives, cut for the slots that differ from a run's own in ``bits`` bits from ``low`` on, by the
    digest's own bits there."""
    mask = ((1 << bits) - 1) << low

    def run(batches):
        for slot, entries in made(batches):
            to = (slot & ~mask) | (entries["d3"].astype(np.int64) & mask)
            yield _as_batch([(int(t), entries[to == t].tobytes()) for t in np.unique(to)])
    return run


def rounds(n_runs: int, fan_in: int = 2) -> list[tuple[int, int]]:
    """(lowest bit, bits) of each round that merges ``n_runs`` runs, ``fan_in`` (a power of two) at a time."""
    depth, step = max(0, n_runs - 1).bit_length(), max(1, fan_in.bit_length() - 1)
    return [(low, min(step, depth - low)) for low in range(0, depth, step)]


def merge_tree(rows: DataFrame, fan_in: int = 2) -> DataFrame:
    """(slot, entries), runs of one slot together, as the last round is to merge them: every text in one slot.

    Each task merges the runs it gets and sends them on in one pass."""
    last_run = rows.agg(F.max("run")).first()[0]
    todo = rounds(0 if last_run is None else last_run + 1, fan_in) or [(0, 0)]   # pieces of a single run are merged too
    tasks = max(1, min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 if last_run is None else last_run + 1))
    runs, made = rows.select("digest", "n_bytes", "check", "doc_id", "row"), _leaf_runs
    for n, (low, bits) in enumerate(todo, 1):
        sent = runs.mapInArrow(_sent(made, low, bits), RUN)
        if n % ROUNDS_A_WRITE == 0:
            sent = materialize(sent, f"round-{n}")
        runs, made = sent.repartition(tasks, "slot").sortWithinPartitions("slot"), _merged
    return runs


def _root_entries(batches):
    """The last merge, a row for each text."""
    for _, e in _merged(batches):
        digests = np.stack([e[f"d{c}"] for c in range(4)], axis=1).astype(">u8").tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([digests[a:a + 32] for a in range(0, len(digests), 32)], pa.binary()), *(pa.array(e[c].astype(np.int64)) for c in ("n_bytes", "check")),
             pa.array(e["doc_id"].astype(np.int64), mask=e["has_id"] == 0), *(pa.array(e[c].astype(np.int64)) for c in ("row", "copies"))],
            ["digest", "n_bytes", "check", "keep_id", "keep_row", "copies"])


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fan_in: int = 2) -> DataFrame:
    """Every row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    return _groups(digest_runs(docs, doc_id, text), fan_in).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _groups(rows: DataFrame, fan_in: int) -> DataFrame:
    root = merge_tree(rows, fan_in).mapInArrow(
        _root_entries, "digest binary, n_bytes long, check long, keep_id long, keep_row long, copies long")
    # Down the same way: one entry a (digest, run), then the rows of the run.
    down = rows.select(*KEY, "run").distinct().join(root, KEY)
    found = rows.join(down, [*KEY, "run"])
    return found.select("doc_id", "keep_id", F.col("copies").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"), "row")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fan_in: int = 2) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; all columns stay.

    Kept rows are found by (id, digest); rows that repeat both are brought down to one after the
    join, in the same partitioning.
    """
    an_id, a_sha = unused(docs, "__llm_id"), unused(docs, "__llm_sha")
    keep = (exact_groups(docs, doc_id, text, fan_in).filter("kept")
            .select(F.col("doc_id").alias(an_id), F.col("text_sha256").alias(a_sha)))
    tagged = docs.withColumns({an_id: F.col(quoted(doc_id)).cast("long"), a_sha: F.sha2(_value(text), 256)})
    matched = tagged.alias("t").join(
        keep.alias("k"), F.col(f"t.{an_id}").eqNullSafe(F.col(f"k.{an_id}")) & (F.col(f"t.{a_sha}") == F.col(f"k.{a_sha}")),
        "left_semi")
    return matched.dropDuplicates([an_id, a_sha]).select(*map(quoted, docs.columns))
