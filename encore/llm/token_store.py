"""Token-id output: shards of raw ids behind a minimal perfect hash index.

A shard is one Parquet row: the ids of its documents one after another (little-endian, 16 bits
while the vocabulary allows it, else 32), their offsets, and an index. The index is a minimal
perfect hash of the shard's document keys: a key's bucket gives a displacement, key and
displacement give a slot of 0..n-1, and the slot holds the key's fingerprint and its place in the
payload. A keyed read is two array accesses whatever the size of the shard; a key that isn't there
fails the fingerprint. ``bounds`` (first and last key) prune shards through Parquet statistics.

Documents are in ascending id order over all shards, so a document's ``start`` is the number of ids
before it. Shards are cut at ``SHARD_IDS`` ids; one longer document is a shard of its own.

Defined results: null text counts as empty, a document then has the end id alone. A null id comes
first. Rows that repeat an id are kept, ordered by their text; the key is (id, occurrence).
An empty table gives an empty store.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import parallelism, worker_model

SHARD_IDS = 1 << 20
CACHE_WORDS, CACHE_OTHERS, CACHED_LENGTH = 400_000, 100_000, 48
#: Text that is cut into pieces at once.
BLOCK_BYTES = 8 << 20
NULL_KEY = -(1 << 63)

SHARD_SCHEMA = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("shard", T.LongType()),
    T.StructField("first_key", T.LongType()), T.StructField("last_key", T.LongType()),
    T.StructField("n_docs", T.LongType()), T.StructField("n_ids", T.LongType()), T.StructField("width", T.IntegerType()),
    T.StructField("keys", T.BinaryType()), T.StructField("occurrences", T.BinaryType()), T.StructField("nulls", T.BinaryType()),
    T.StructField("displacements", T.BinaryType()), T.StructField("slots", T.BinaryType()),
    T.StructField("fingerprints", T.BinaryType()), T.StructField("offsets", T.BinaryType()), T.StructField("payload", T.BinaryType()),
])


# ---- minimal perfect hash -------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=np.uint64).copy()
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x7FB5D329728EA185)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x81DADEF4BC2DD44D)
        x ^= x >> np.uint64(33)
    return x


def key_hash(keys: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(keys.astype(np.int64).view(np.uint64) + _mix(occurrences.astype(np.uint64) + np.uint64(1)))


def _slot(hashes, displacement, n: int):
    with np.errstate(over="ignore"):
        return _mix(hashes + np.asarray(displacement, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (_mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


def build_index(hashes: np.ndarray, trials: int = 64) -> np.ndarray:
    """Displacement of each bucket: a value >= 0 is hashed with the key, -1 - s names slot s."""
    n = len(hashes)
    buckets = max(1, (n + 1) // 2)
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    sizes = np.bincount(bucket, minlength=buckets)
    out = np.zeros(buckets, dtype=np.int64)
    taken = [False] * n
    members: dict[int, list[int]] = {}
    crowded = np.flatnonzero(sizes[bucket] > 1)
    for i, b in zip(crowded.tolist(), bucket[crowded].tolist()):
        members.setdefault(b, []).append(i)
    # Slots under a block of displacements are made at once; the first block for all keys.
    steps = np.arange(trials, dtype=np.uint64)[:, None]
    first = _slot(hashes[None, :], steps, n).astype(np.int64)
    for b in sorted(members, key=lambda k: -len(members[k])):
        own, d = members[b], 0
        tried = first[:, own].tolist()
        while True:
            if d and d % trials == 0:
                tried = _slot(hashes[own][None, :], steps + np.uint64(d), n).astype(np.int64).tolist()
            slots = tried[d % trials]
            if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                break
            d += 1
        for s in slots:
            taken[s] = True
        out[b] = d
    singles = np.flatnonzero(sizes == 1)
    out[singles] = -1 - np.flatnonzero(~np.asarray(taken, dtype=bool))[: len(singles)]
    return out


def lookup_slots(hashes: np.ndarray, displacements: np.ndarray, n: int) -> np.ndarray:
    d = displacements[(hashes % np.uint64(len(displacements))).astype(np.int64)]
    return np.where(d < 0, -1 - d, _slot(hashes, np.maximum(d, 0), n).astype(np.int64))


class Shard:
    """Reader of one shard row."""

    def __init__(self, row: dict):
        self.n = row["n_docs"]
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.occurrences = np.frombuffer(row["occurrences"], "<u4")
        self.nulls = np.frombuffer(row["nulls"], "u1").astype(bool)
        self.displacements = np.frombuffer(row["displacements"], "<i8")
        self.slots = np.frombuffer(row["slots"], "<u4")
        self.fingerprints = np.frombuffer(row["fingerprints"], "<u4")
        self.offsets = np.frombuffer(row["offsets"], "<i8")
        self.payload = np.frombuffer(row["payload"], "<u2" if row["width"] == 2 else "<u4")

    def places(self, keys: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
        """Place of each key in the shard, -1 where it isn't stored."""
        if not self.n:
            return np.full(len(keys), -1)
        hashes = key_hash(keys, occurrences)
        slot = lookup_slots(hashes, self.displacements, self.n)
        place = self.slots[slot].astype(np.int64)
        there = (self.fingerprints[slot] == fingerprint(hashes)) & (self.keys[place] == keys) & (self.occurrences[place] == occurrences)
        return np.where(there, place, -1)

    def ids(self, place: int) -> np.ndarray:
        return self.payload[self.offsets[place]: self.offsets[place + 1]]


# ---- tokenizing -----------------------------------------------------------------

#: A word of Latin-1 letters and the run of ASCII marks behind it: to the tokenizer two pieces, whatever the marks.
WORD_AND_MARK = "^(?P<word>[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]{1,%d})(?P<mark>[!-/:-@\\[-`{-~]{0,8})$" % CACHED_LENGTH


class Generations:
    """A bounded cache: when the young generation is full it becomes the old one, so frequent keys stay."""

    def __init__(self, room: int):
        self.room, self.young, self.old = room, {}, {}

    def get_all(self, keys: list[str], build) -> list[bytes]:
        """The values of distinct ``keys``; ``build(list)`` makes those that are not there."""
        found = list(map(self.young.get, keys))
        gone = [i for i, v in enumerate(found) if v is None]
        if gone:
            older = self.old.get
            new = [i for i in gone if (v := older(keys[i])) is None or found.__setitem__(i, v)]
            for i, v in zip(new, build([keys[i] for i in new]) if new else (), strict=True):
                found[i] = v
            self.young.update((keys[i], found[i]) for i in gone if len(keys[i]) <= CACHED_LENGTH)
            if len(self.young) > self.room:
                self.old, self.young = self.young, {}
        return found


class ChunkEncoder:
    """The tokenizers library behind a cache of its answers for the pieces between white space.

    Valid for tokenizers that drop white space and never join text across it (the caller's word-end
    vocabulary); a piece's ids don't depend on its neighbours. Texts are cut and their distinct pieces found
    by Arrow, many texts at a time; only distinct words are looked up, and only new ones are encoded.
    """

    def __init__(self, path: str):
        # Each task encodes on its own core; the library's threads would compete for the others.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.dtype = "<u4" if self.wide else "<u2"
        self.words, self.others = Generations(CACHE_WORDS), Generations(CACHE_OTHERS)
        self.word_end = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.word_end[i] = token.endswith("</w>")

    def _encode_each(self, pieces: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only, encoded together: each ends with its one word-end token."""
        out: list[bytes] = []
        for i in range(0, len(words), 1024):
            part = words[i: i + 1024]
            ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype=self.dtype)
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) != len(part) or (len(ids) and ends[-1] != len(ids)):
                return self._encode_each(words)
            packed, width, start = ids.tobytes(), ids.dtype.itemsize, 0
            for end in ends.tolist():
                out.append(packed[start * width: end * width])
                start = end
        return out

    def _ids(self, distinct: pa.Array, cache: Generations, encode) -> pa.Array:
        """Ids of ``distinct`` strings (null: no ids) as one binary array."""
        coded = distinct.dictionary_encode()
        ids = pa.array(cache.get_all(coded.dictionary.to_pylist(), encode), pa.large_binary())
        return ids.take(coded.indices).fill_null(b"")

    def _piece_ids(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces. A word with or without marks is put together from the ids of its
        lower-case letters and of the marks; every other piece is encoded as it is."""
        split = pc.extract_regex(pieces, WORD_AND_MARK)
        is_word = split.is_valid()
        word, mark = (pc.if_else(is_word, pc.struct_field(split, i), None) for i in (0, 1))
        other = pc.if_else(is_word, None, pieces)
        return pc.binary_join_element_wise(self._ids(pc.utf8_lower(word), self.words, self._encode_words),
                                           self._ids(pc.fill_null(mark, ""), self.others, self._encode_each),
                                           self._ids(other, self.others, self._encode_each), pa.scalar(b"", pa.large_binary()))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; null counts as empty."""
        # These three are white space to the tokenizer too, whatever its table holds besides them and the space.
        for space in "\n\t\r":
            texts = pc.replace_substring(texts, space, " ")
        pieces = pc.split_pattern(texts.fill_null(""), " ")
        coded = pieces.flatten().dictionary_encode()
        ids = self._piece_ids(coded.dictionary).take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy())])
        bounds = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(pieces).to_numpy())])].tolist()
        start, payload = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset], ids.buffers()[2]
        packed = memoryview(payload)[start:] if payload is not None else b""
        return [bytes(packed[a:b]) for a, b in zip(bounds, bounds[1:])]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]


def text_blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about BLOCK_BYTES of text, or one longer text."""
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(total, (total[start - 1] if start else 0) + BLOCK_BYTES, "right"))
        end = max(end, start + 1)
        yield batch.slice(start, end - start)
        start = end


def encoder(path: str) -> ChunkEncoder:
    """The encoder in this worker."""
    return worker_model.get(("token store", path), lambda: ChunkEncoder(path))


# ---- writing and reading --------------------------------------------------------

def _shard_row(part: int, shard: int, dtype: str, keys: list, occurrences: list, chunks: list[bytes]) -> dict:
    width = np.dtype(dtype).itemsize
    nulls = np.asarray([k is None for k in keys], dtype="u1")
    key = np.asarray([NULL_KEY if k is None else k for k in keys], dtype="<i8")
    occurrence = np.asarray(occurrences, dtype="<u4")
    # A null key and the smallest id share a number, so null keys count from the top.
    occurrence = np.where(nulls == 1, np.uint32(0xFFFFFFFF) - occurrence, occurrence).astype("<u4")
    hashes = key_hash(key, occurrence)
    displacements = build_index(hashes)
    slot = lookup_slots(hashes, displacements, len(key))
    slots, prints = np.empty(len(key), "<u4"), np.empty(len(key), "<u4")
    slots[slot] = np.arange(len(key), dtype="<u4")
    prints[slot] = fingerprint(hashes)
    offsets = np.concatenate([[0], np.cumsum([len(c) // width for c in chunks])]).astype("<i8")
    return {"part": part, "shard": shard, "first_key": int(key[0]), "last_key": int(key[-1]), "n_docs": len(key),
            "n_ids": int(offsets[-1]), "width": width, "keys": key.tobytes(), "occurrences": occurrence.tobytes(),
            "nulls": nulls.tobytes(), "displacements": displacements.astype("<i8").tobytes(), "slots": slots.tobytes(),
            "fingerprints": prints.tobytes(), "offsets": offsets.tobytes(), "payload": b"".join(chunks)}


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, shard_ids: int = SHARD_IDS,
                doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text and write the shards in ascending id order under ``path``."""
    spark = docs.sparkSession
    arrow = pa.schema([(f.name, {"long": pa.int64(), "integer": pa.int32(), "binary": pa.binary()}[f.dataType.typeName()])
                       for f in SHARD_SCHEMA])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer)
        end = b"" if end_id is None else np.asarray([end_id], dtype=model.dtype).tobytes()
        part, shard, size, previous, occurrence = TaskContext.get().partitionId(), 0, 0, object(), 0
        keys: list = []
        occurrences: list = []
        chunks: list[bytes] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_shard_row(part, shard, model.dtype, keys, occurrences, chunks)], schema=arrow)

        for batch in (block for whole in batches for block in text_blocks(whole)):
            for key, ids in zip(batch.column(0).to_pylist(), model.encode_all(batch.column(1)), strict=True):
                occurrence = occurrence + 1 if key == previous else 0
                previous = key
                ids += end
                if keys and size + len(ids) > shard_ids * np.dtype(model.dtype).itemsize:
                    yield flush()
                    shard, size, keys, occurrences, chunks = shard + 1, 0, [], [], []
                keys.append(key)
                occurrences.append(occurrence)
                chunks.append(ids)
                size += len(ids)
        if keys:
            yield flush()

    ordered = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
               .repartitionByRange(parallelism(spark), F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()))
    ordered.mapInArrow(run, SHARD_SCHEMA).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def _starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, shard, base): ids before each shard, from the counts of parts and of shards within them."""
    counts = read_shards(spark, path).select("part", "shard", "n_ids")
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # One row per write task: at most the session's number of shuffle partitions.
    sums = sorted((r["part"], r["ids"]) for r in parts.collect())
    base, before = {}, 0
    for part, ids in sums:
        base[part], before = before, before + ids
    offsets = spark.createDataFrame(list(base.items()) or [(0, 0)], "part long, part_base long")
    from pyspark.sql.window import Window

    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
            .join(F.broadcast(offsets), "part").select("part", "shard", (F.col("part_base") + F.col("inside")).alias("base")))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, each read by its key."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                places = shard.places(shard.keys, shard.occurrences)
                ids = [shard.ids(p) for p in places.tolist()]
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard.keys, pa.int64(), mask=shard.nulls), pa.array([row["part"]] * shard.n, pa.int64()),
                    pa.array([row["shard"]] * shard.n, pa.int64()), pa.array(shard.offsets[places], pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())],
                    names=["doc_id", "part", "shard", "inside", "n_tokens", "ids_crc32"])

    found = read_shards(spark, path).mapInArrow(
        run, "doc_id long, part long, shard long, inside long, n_tokens long, ids_crc32 long")
    return (found.join(_starts(spark, path), ["part", "shard"])
            .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))


def get(spark: SparkSession, path: str, doc_id: int, occurrence: int = 0) -> list[int] | None:
    """Ids of one document: shards pruned by key bounds, then the index."""
    near = read_shards(spark, path).filter((F.col("first_key") <= doc_id) & (F.col("last_key") >= doc_id)).drop("part")
    for row in near.toLocalIterator():
        shard = Shard(row.asDict())
        place = int(shard.places(np.asarray([doc_id], dtype=np.int64), np.asarray([occurrence], dtype=np.uint32))[0])
        if place >= 0 and not shard.nulls[place]:
            return shard.ids(place).tolist()
    return None
