"""Removal of repeated passages by difference-cover blockwise suffix sorting.

A byte goes when a ``WINDOW``-byte string that covers it also starts earlier: in a document before this
one, or in the same document at a smaller offset. Whether a suffix ties with an earlier one for WINDOW
bytes is all that is asked of the suffix array, so no suffix is sorted that can't tie, and suffixes are
sorted a bucket at a time:

  units     documents with equal texts are one unit, numbered in document order; of a repeated text all
            rows but the first are wholly repeated.
  cover     D is a perfect difference set modulo V: any two suffixes i, j have one shift d < V for which
            i+d and j+d both lie in the cover. The cover samples are ranked beforehand by their next
            WINDOW-V+1 bytes: shared by several samples, or alone. A suffix whose samples are all
            alone can't tie; it is resolved without being moved or sorted.
  ties      long ties: suffixes that may tie are cut into segments at places given by the text itself, and
            a segment that occurs earlier as a whole is resolved by one comparison of up to
            SEGMENT suffixes.
  buckets   the suffixes of the first occurrence of each segment are dealt by hash into buckets; a task
            sorts one bucket at a time, and what ties with an earlier suffix is given back to its unit.
  cut       the covered bytes of each unit are cut out of its text.

The three sorts share one map and one reduce. What is equal within a map flush is settled there and
one record is sent for it, so a passage that a third of all documents hold reaches a bucket once a flush.
Suffixes are compared by hashes of WINDOW bytes: 64 bits beside the bucket's own.

Defined results: a null text is empty and has no bytes. Documents are ordered by doc_id, null ids
last; rows that share an id are ordered by the SHA-256 of their text, and of rows equal in both all but
one are wholly repeated. Texts under WINDOW bytes lose nothing. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, parallelism

WINDOW = 100
#: A perfect difference set: every difference modulo V occurs once.
V, D = 57, (0, 1, 3, 13, 32, 36, 43, 52)
SAMPLE = WINDOW - V + 1
#: Bytes of text handled at once, and records held before they are sent.
PIECE, FLUSH = 1 << 20, 1 << 20
#: A segment ends where a hash of the text at its place has SEGMENT_BITS zero bits, or after SEGMENT suffixes.
SEGMENT_BITS, SEGMENT = 4, 64
#: Units of a reply; buckets of a task; bytes of a task's records aimed at.
BLOCK_BITS, BUCKETS, TASK_BYTES = 8, 6, 48 << 20
#: Bytes up to which what is known of units is broadcast to the texts; beyond, a shuffle join.
BROADCAST_BYTES = 64 << 20

COVER = np.array(D, dtype=np.int64)
_BELOW = np.array([sum(d < r for d in D) for r in range(V)], dtype=np.int64)
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_LOW40 = np.uint64((1 << 40) - 1)

SENT = "bucket int, block long, blob binary"


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes at every offset of ``text``, which ends in eight spare bytes."""
    return np.ndarray((len(text) - 7,), dtype="<u8", buffer=text.data, strides=(1,))


def _hash(words: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    h = np.full(len(at), (seed * 0x165667B19E3779F9 + length) & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    offsets = [*range(0, length - 7, 8)] + ([length - 8] if length % 8 else [])
    for k, o in enumerate(offsets):
        h ^= h >> np.uint64(29)
        h = (h + words[at + o]) * _M[(k + seed) % 4]
    h ^= h >> np.uint64(32)
    h *= _M[1]
    return h ^ (h >> np.uint64(29))


def _samples_below(x):
    """How many cover positions lie below x."""
    return len(D) * (x // V) + _BELOW[x % V]


def _planes(values: np.ndarray, dtype: str) -> bytes:
    """Values byte plane by byte plane, so that planes of zeros compress away."""
    a = np.ascontiguousarray(values.astype(dtype))
    return a.view(np.uint8).reshape(len(a), -1).T.tobytes()


def _unplanes(data: memoryview, n: int, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    raw = np.frombuffer(data, np.uint8, n * width).reshape(width, n)
    return np.ascontiguousarray(raw.T).view(dtype).reshape(n)


def _pack(unit, at, span, h, width: int) -> bytes:
    """Records in order of (unit, at): runs of units, gaps of places, spans, hashes of ``width`` bytes."""
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    counts = np.diff(np.r_[starts, len(unit)])
    gaps = at.copy()
    gaps[1:] -= at[:-1]
    gaps[starts] = at[starts]
    hashes = np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(len(h), 8)[:, :width].tobytes()
    return b"".join([np.array([len(unit), len(starts)], "<u4").tobytes(), unit[starts].astype("<i8").tobytes(), counts.astype("<u4").tobytes(),
                     _planes(gaps, "<u4"), span.astype(np.uint8).tobytes(), hashes])


def _unpack(blob: bytes, width: int):
    view = memoryview(blob)
    n, runs = np.frombuffer(view, "<u4", 2).tolist()
    p = 8
    units = np.frombuffer(view[p:], "<i8", runs)
    counts = np.frombuffer(view[p + 8 * runs:], "<u4", runs).astype(np.int64)
    p += 12 * runs
    at = np.cumsum(_unplanes(view[p:], n, "<u4").astype(np.int64))
    starts = np.cumsum(counts) - counts
    before = np.where(starts > 0, at[starts - 1], 0)
    at -= np.repeat(before, counts)
    span = np.frombuffer(view[p + 4 * n:], np.uint8, n)
    raw = np.zeros((n, 8), np.uint8)
    raw[:, :width] = np.frombuffer(view[p + 5 * n:], np.uint8, n * width).reshape(n, width)
    return np.repeat(units, counts), at, span, raw.view("<u8").reshape(n)


def _replies(unit, at, span) -> Iterator[tuple[int, bytes]]:
    """(block, blob) of places given back to their units."""
    if not len(unit):
        return
    o = np.lexsort((at, unit))
    unit, at, span = unit[o], at[o], span[o]
    block = unit >> BLOCK_BITS
    cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(block[a]), b"".join([_planes(unit[a:b] & ((1 << BLOCK_BITS) - 1), "u1"), _planes(at[a:b], "<u4"), _planes(span[a:b], "u1")])


class _Sender:
    """Gathers the records of a task and sends them by bucket, one of each hash a flush."""

    def __init__(self, buckets: int, width: int, shared: bool):
        self.buckets, self.width, self.shared, self.held, self.n = buckets, width, shared, [], 0

    def add(self, unit, at, span, bucket, h) -> Iterator[pa.RecordBatch]:
        if len(unit):
            self.held.append((unit, at.astype(np.uint32), span.astype(np.uint8), bucket.astype(np.int32), h))
            self.n += len(unit)
        if self.n >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        unit, at, span, bucket, h = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.n = [], 0
        at = at.astype(np.int64)
        step, ahead = np.diff(unit), np.diff(at)
        if ((step < 0) | (step == 0) & (ahead <= 0)).any():
            o = np.lexsort((at, unit))
            o = o[np.r_[True, (np.diff(unit[o]) != 0) | (np.diff(at[o]) != 0)]]  # a unit that two batches hold counts once
            unit, at, span, bucket, h = unit[o], at[o], span[o], bucket[o], h[o]
        o = np.lexsort((h, bucket))  # stable: places stay in order within a hash
        same = (h[o[1:]] == h[o[:-1]]) & (bucket[o[1:]] == bucket[o[:-1]])
        again = np.zeros(len(h), bool)
        again[o[1:]] = same
        settled = again.copy()
        if self.shared:   # the first of a repeated sample is shared as well
            settled[o[:-1]] |= same
        rows = [(int(block) % self.buckets, block, blob) for block, blob in _replies(unit[settled], at[settled], span[settled])]
        keep = np.flatnonzero(~again)
        keep = keep[np.argsort(bucket[keep], kind="stable")]
        cuts = np.flatnonzero(np.r_[True, np.diff(bucket[keep]) != 0, True])
        for a, b in zip(cuts[:-1], cuts[1:]):
            k = keep[a:b]
            rows.append((int(bucket[k[0]]), None, _pack(unit[k], at[k], span[k], h[k], self.width)))
        for a in range(0, len(rows), 256):
            part = rows[a:a + 256]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.int64()),
                                              pa.array([r[2] for r in part], pa.binary())], ["bucket", "block", "blob"])


class _Piece:
    """Neighbouring texts, or a part of a long one: places [first, last) of each, and the bytes they look at."""

    def __init__(self, parts: list[tuple[int, int, int, int]], data: np.ndarray):
        # (row, offset of the text in data, first place, last place)
        row, offset, first, last = (np.array(x, dtype=np.int64) for x in zip(*parts))
        self.row, self.offset, self.first, self.last = row, offset, first, last
        self.flat = np.cumsum(last - first) - (last - first)
        self.size = int((last - first).sum())
        lo, hi = int((offset + first).min()), int((offset + last).max()) + WINDOW
        text = np.zeros(min(hi, len(data)) - lo + 8, np.uint8)
        text[:-8] = data[lo:hi]
        self.lo, self.words = lo, _words(text)

    def places(self, flat: np.ndarray):
        """(index of the part, place in its text, offset in the piece) of flat places."""
        part = np.searchsorted(self.flat, flat, side="right") - 1
        at = flat - self.flat[part] + self.first[part]
        return part, at, at + self.offset[part] - self.lo


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[_Piece]:
    """The places of all texts at which a string of ``length`` bytes starts, about PIECE bytes at a time."""
    text = batch.column("text")
    if not len(text):
        return
    offsets = np.frombuffer(text.buffers()[1], "<i4" if pa.types.is_string(text.type) else "<i8", len(text) + 1 + text.offset)[text.offset:].astype(np.int64)
    data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None else np.zeros(0, np.uint8)
    parts, held = [], 0
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        last = b - a - length + 1
        for first in range(0, max(last, 0), PIECE):
            end = min(last, first + PIECE)
            if held + end - first > PIECE and parts:
                yield _Piece(parts, data)
                parts, held = [], 0
            parts.append((row, a, first, end))
            held += end - first
    if parts:
        yield _Piece(parts, data)


def _units(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    """The batch with each unit once, and the units."""
    unit = np.asarray(batch.column("unit"), dtype=np.int64)
    _, first = np.unique(unit, return_index=True)
    if len(first) < len(unit):
        first.sort()
        batch, unit = batch.take(pa.array(first)), unit[first]
    return batch, unit


def _marks(blob) -> tuple[np.ndarray, np.ndarray]:
    """(places, spans) known of a unit."""
    if blob is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = memoryview(zlib.decompress(blob))
    n = len(raw) // 5
    return np.cumsum(_unplanes(raw, n, "<u4").astype(np.int64)), np.frombuffer(raw[4 * n:], np.uint8, n).astype(np.int64)


def _cover_samples(buckets: int):
    def run(batches):
        out = _Sender(buckets, 5, shared=True)
        for batch in batches:
            batch, unit = _units(batch)
            for piece in _pieces(batch, SAMPLE):
                lo, hi = _samples_below(piece.first), _samples_below(piece.last)
                flat = np.cumsum(hi - lo) - (hi - lo)
                part = np.repeat(np.arange(len(lo)), hi - lo)
                index = np.arange(len(part)) - flat[part] + lo[part]
                at = V * (index // len(D)) + COVER[index % len(D)]
                h = _hash(piece.words, at + piece.offset[part] - piece.lo, SAMPLE, 1)
                yield from out.add(unit[piece.row[part]], at, np.zeros(len(at), np.uint8), (h >> np.uint64(40)) % np.uint64(buckets), h & _LOW40)
        yield from out.flush()
    return run


def _ranges(piece: _Piece, part, lo, hi) -> np.ndarray:
    """Flat places of the piece that lie in [lo, hi) of their part, as a mask."""
    lo, hi = np.maximum(lo, piece.first[part]), np.minimum(hi, piece.last[part])
    ok = lo < hi
    shift = (piece.flat - piece.first)[part[ok]]
    delta = np.bincount(lo[ok] + shift, minlength=piece.size + 1).astype(np.int32)
    delta -= np.bincount(hi[ok] + shift, minlength=piece.size + 1).astype(np.int32)
    return np.cumsum(delta[:-1]) > 0


def _known(piece: _Piece, marks: list):
    """What is known of the piece's rows: (part, place, span) of each mark."""
    own = [marks[r] for r in piece.row]
    return (np.repeat(np.arange(len(own)), [len(x[0]) for x in own]), np.concatenate([x[0] for x in own]), np.concatenate([x[1] for x in own]))


def _may_tie(piece: _Piece, samples: list) -> np.ndarray:
    """Suffixes that start at most V - 1 bytes before a shared sample."""
    part, at, _ = _known(piece, samples)
    return _ranges(piece, part, at - (V - 1), at + 1)


def _suffixes(buckets: int, whole_segments: bool):
    """Records of segments of suffixes that may tie, or of the single suffixes outside resolved segments."""
    def run(batches):
        out = _Sender(buckets, 8, shared=False)
        for batch in batches:
            batch, unit = _units(batch)
            samples = [_marks(x) for x in batch.column("samples").to_pylist()]
            resolved = None if whole_segments else [_marks(x) for x in batch.column("segments").to_pylist()]
            for piece in _pieces(batch, WINDOW):
                open_ = _may_tie(piece, samples)
                if not whole_segments:
                    part, at, span = _known(piece, resolved)
                    open_ &= ~_ranges(piece, part, at, at + span)
                flat = np.flatnonzero(open_)
                if not len(flat):
                    continue
                part, at, byte = piece.places(flat)
                if whole_segments:
                    cut = ((piece.words[byte] * _M[0]) >> np.uint64(64 - SEGMENT_BITS)) == 0
                    cut[0] = True
                    cut[1:] |= (np.diff(flat) > 1) | (np.diff(part) != 0)
                    since = np.arange(len(flat)) - np.maximum.accumulate(np.where(cut, np.arange(len(flat)), 0))
                    first = np.flatnonzero(since % SEGMENT == 0)
                    last = np.r_[first[1:], len(flat)] - 1
                    span = last - first + 1
                    h, g = (_hash(piece.words, byte[first], WINDOW, s) * _M[2] ^ _hash(piece.words, byte[last], WINDOW, s + 4) + span.astype(np.uint64) for s in (2, 3))
                    part, at = part[first], at[first]
                else:
                    span = np.ones(len(flat), np.int64)
                    h, g = (_hash(piece.words, byte, WINDOW, s) for s in (2, 3))
                yield from out.add(unit[piece.row[part]], at, span, (g >> np.uint64(32)) % np.uint64(buckets), h)
        yield from out.flush()
    return run


def _sort_buckets(width: int, shared: bool):
    """One bucket at a time: all records of a repeated hash (``shared``), or all but the first of it."""
    def settle(blobs):
        unit, at, span, h = (np.concatenate(x) for x in zip(*(_unpack(b, width) for b in blobs)))
        o = np.argsort(h, kind="stable")
        same = h[o[1:]] == h[o[:-1]]
        tied = np.zeros(len(h), bool)
        tied[1:] |= same
        tied[:-1] |= same
        o = o[tied]
        if not shared and len(o):
            o = o[np.lexsort((at[o], unit[o], h[o]))]
            # a unit that several rows hold may come twice: equal places are one suffix
            run = np.cumsum(np.r_[True, h[o[1:]] != h[o[:-1]]]) - 1
            lead = o[np.flatnonzero(np.r_[True, run[1:] != run[:-1]])][run]
            o = o[(unit[o] != unit[lead]) | (at[o] != at[lead])]
        return unit[o], at[o], span[o]

    def replies(held):
        rows = list(_replies(*(np.concatenate(x) for x in zip(*held))))
        for a in range(0, len(rows), 512):
            part = rows[a:a + 512]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.binary())], ["block", "blob"])

    def run(batches):
        # what is settled is held over the task's buckets: a block of units gets one reply from a task, not one from a bucket
        bucket, blobs, held, n = None, [], [], 0
        for batch in batches:
            for b, block, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "blob"))):
                settled = None
                if block is not None:
                    settled = _reply(block, blob)
                elif b == bucket:
                    blobs.append(blob)
                else:
                    settled = settle(blobs) if len(blobs) > 1 else None
                    bucket, blobs = b, [blob]
                if settled is not None:
                    held.append(settled)
                    n += len(settled[0])
                if n >= FLUSH:
                    yield from replies(held)
                    held, n = [], 0
        if len(blobs) > 1:
            held.append(settle(blobs))
        if held:
            yield from replies(held)
    return run


def _reply(block: int, blob: bytes):
    """(unit, place, span) of a reply."""
    n, view = len(blob) // 6, memoryview(blob)
    low = np.frombuffer(view, np.uint8, n).astype(np.int64)
    return (block << BLOCK_BITS) + low, _unplanes(view[n:], n, "<u4").astype(np.int64), np.frombuffer(view[5 * n:], np.uint8, n)


def _by_unit(batches):
    """Blocks of replies, in order of the block, to one blob of places a unit."""
    def settle(block, blobs):
        unit, at, span = (np.concatenate(x) for x in zip(*(_reply(block, blob) for blob in blobs)))
        o = np.lexsort((at, unit))
        unit, at, span = unit[o], at[o], span[o]
        cuts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1], True])
        units, blobs = [], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            units.append(int(unit[a]))
            blobs.append(zlib.compress(_planes(np.diff(at[a:b], prepend=0), "<u4") + span[a:b].tobytes(), 1))
        return pa.RecordBatch.from_arrays([pa.array(units, pa.int64()), pa.array(blobs, pa.binary())], ["unit", "marks"])

    block, blobs = None, []
    for batch in batches:
        for b, blob in zip(batch.column("block").to_pylist(), batch.column("blob").to_pylist()):
            if b != block:
                if blobs:
                    yield settle(block, blobs)
                block, blobs = b, []
            blobs.append(blob)
    if blobs:
        yield settle(block, blobs)


def _marks_by_unit(sent: DataFrame, tasks: int, width: int, shared: bool, name: str) -> DataFrame:
    """(unit, marks) of what the buckets settle, in shared scratch."""
    settled = (sent.repartition(tasks, "bucket").sortWithinPartitions("bucket")
               .mapInArrow(_sort_buckets(width, shared), "block long, blob binary"))
    by_unit = settled.repartition(tasks, "block").sortWithinPartitions("block").mapInArrow(_by_unit, "unit long, marks binary")
    return materialize(by_unit, f"suffix-{name}")


def _cut(batches):
    """The bytes that resolved segments and suffixes cover go."""
    for batch in batches:
        batch, unit = _units(batch)
        removed, spans, digests = [], [], []
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for text, *blobs in zip(texts, batch.column("segments").to_pylist(), batch.column("suffixes").to_pylist()):
            data = np.frombuffer(text, np.uint8)
            delta = np.zeros(len(data) + 1, np.int32)
            for at, span in map(_marks, blobs):
                np.add.at(delta, at, 1)
                np.add.at(delta, at + span - 1 + WINDOW, -1)
            gone = np.cumsum(delta[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int((np.diff(gone.astype(np.int8), prepend=0) > 0).sum()))
            digests.append(hashlib.sha256(data[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(unit, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
                                         ["unit", "n_removed", "n_spans", "kept_sha256"])


def _text(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def _with_known(docs: DataFrame, known: DataFrame, bytes_: int) -> DataFrame:
    """The texts of the units of ``known``, with its columns. Its bytes are checked: up to BROADCAST_BYTES they are broadcast."""
    side = F.broadcast(known) if bytes_ <= BROADCAST_BYTES else known
    same = docs["id"].eqNullSafe(known["first_id"]) & (docs["sha"] == known["sha"])
    return docs.join(side, same).drop(known["sha"], known["first_id"], docs["id"], docs["sha"])


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row: (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), _text(f"`{text}`").alias("text"))
    texts = texts.withColumn("sha", F.unhex(F.sha2("text", 256)))
    rows = materialize(texts.select("id", "sha", F.octet_length("text").cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row")), "suffix-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("first_id"), F.col("row").alias("first_row")))
    classes = rows.groupBy("sha").agg(first.alias("first"), F.max("n_bytes").alias("n_bytes")).select("sha", "first.*", "n_bytes")
    units = materialize(classes.orderBy("no_id", "first_id", "sha").select(F.monotonically_increasing_id().alias("unit"), "first_id", "first_row", "sha", "n_bytes"), "suffix-units")
    n_units, n_bytes = units.filter(F.col("n_bytes") >= WINDOW).agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    long_units = units.filter(F.col("n_bytes") >= WINDOW).select("unit", "first_id", "sha")
    tasks = max(parallelism(spark), n_bytes // TASK_BYTES)
    buckets = BUCKETS * tasks

    def known(*tables: tuple[str, DataFrame]) -> tuple[DataFrame, int]:
        """Long units that ``tables`` know something of, their marks as columns, and the bytes of all that."""
        out = None
        for name, marks in tables:
            marks = marks.withColumnRenamed("marks", name)
            out = marks if out is None else out.join(marks, "unit", "full")
        size = sum(m.agg(F.coalesce(F.sum(F.octet_length("marks") + 64), F.lit(0))).first()[0] for _, m in tables)
        return long_units.join(out, "unit"), size

    distinct = _with_known(texts, long_units, 64 * n_units)
    samples = _marks_by_unit(distinct.select("unit", "text").mapInArrow(_cover_samples(buckets), SENT), tasks, 5, True, "samples")
    tied = _with_known(texts, *known(("samples", samples)))
    segments = _marks_by_unit(tied.select("unit", "text", "samples").mapInArrow(_suffixes(buckets, True), SENT), tasks, 8, False, "segments")
    table, size = known(("samples", samples), ("segments", segments))
    still = _with_known(texts, table.filter("samples is not null"), size)
    suffixes = _marks_by_unit(still.select("unit", "text", "samples", "segments").mapInArrow(_suffixes(buckets, False), SENT), tasks, 8, False, "suffixes")
    cut = (_with_known(texts, *known(("segments", segments), ("suffixes", suffixes))).select("unit", "text", "segments", "suffixes")
           .mapInArrow(_cut, "unit long, n_removed long, n_spans long, kept_sha256 string"))
    # rows that repeat a unit's id and text give its result again
    cut = materialize(cut, "suffix-cut").dropDuplicates(["unit"])
    found = units.join(cut, "unit", "left").select(F.col("sha").alias("of"), "first_row", "n_removed", "n_spans", "kept_sha256")
    each = rows.join(found, F.col("sha") == F.col("of"))
    leads = F.col("row") == F.col("first_row")
    whole = (~leads) & (F.col("n_bytes") >= WINDOW)
    return each.select(
        F.col("id").alias("doc_id"), "n_bytes",
        F.when(whole, F.col("n_bytes")).when(leads, F.coalesce("n_removed", F.lit(0))).otherwise(0).cast("long").alias("n_removed"),
        F.when(whole, 1).when(leads, F.coalesce("n_spans", F.lit(0))).otherwise(0).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).when(leads & F.col("kept_sha256").isNotNull(), F.col("kept_sha256"))
        .otherwise(F.lower(F.hex("sha"))).alias("kept_sha256"))
