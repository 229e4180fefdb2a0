"""N-gram Jaccard join: prefix filtering, T-occurrence search by DivideSkip, and its components.

Two documents link when the Jaccard similarity of their sets of word shingles reaches ``percent``
per cent. Of n shingles a partner must share at least T = ceil(percent n / 100), so at least one of its
n - T + 1 short lists once the T - 1 longest are set aside. Across the cluster one shared short list makes a
candidate; in blocks of candidates DivideSkip merges short lists, probes long ones and decides:

  sets      documents with equal sets are one class; what follows works on class representatives.
  order     shingles that a 1/16 sample finds in many sets are *long*; all others are short. Any order
            gives exact results, this one keeps lists of common passages out of the merge.
  merge     Spark shuffles the postings of the n - T + 1 shortest lists of every set. Sets that share no
            list there can't link.
  star      inside a list, sets are not paired with each other: each is proposed to the leader of one
            of its lists only, so a turn has no more candidates than there are sets. First the set with
            the fullest lists leads (the one that edits set least apart), then one by hash.
  bound     bitmaps of both sets bound their intersection from above; pairs that can't reach T go.
  probe     blocks of one query set and its candidates: the candidates' hashes are turned into the
            query's inverted lists over the block, and DivideSkip counts occurrences in them: a heap
            merges the short lists, candidates that may still reach T are looked up in the long
            ones by binary search. Its counts are the exact overlaps and decide every pair.
  exact     links join sets to components. What may still be missing are links between sets of one list
            that lie in different components. Where one of the two components is a crowd (more than
            CROWD sets), the sets of the smaller one are set against the larger one's, in blocks: no
            row is made for a pair. Among the others, each set of a list outside the list's largest
            component is paired with every set outside its own. So all pairs that can still change a
            component are probed, none inside one.

Defined results: words are [^\\x20\\x09-\\x0D]+ after lower-casing A-Z; with fewer words than a shingle has, the
whole sequence is the one shingle; without words (null, empty, white space) the set is empty and
links with nothing. Rows that repeat an id each give a row; their component is the least that any text
of the id has. Rows with a null id link with nothing and have a null component. Shingles are
compared as 56-bit hashes, sets as 64-bit ones.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import heapq
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_memory, materialize, parallelism, small_batches

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: A shingle in this many sampled sets counts as long; the sample is one set in SAMPLE.
SAMPLE, LONG_IN_SAMPLE, MAX_LONG = 16, 2, 1 << 20
BLOCK = 256
#: A component of more sets is probed in blocks; a block holds at most this many shingles beside one set.
CROWD, BLOCK_SHINGLES = 64, 1 << 21
#: Sets that a task remembers so as not to give out their lists again; sampled shingles it counts at once.
SEEN = 1 << 18
#: The most sets of a list in a block of bitmaps.
LIST_BLOCK = 4096


# ---- shingle sets ---------------------------------------------------------------

def _byte_codes() -> np.ndarray:
    out = np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=8, key=b"shingle").digest() for b in range(256)), np.uint64)
    return out | np.uint64(1)


_CODES = _byte_codes()
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done, step = 1, np.uint64(base)
    with np.errstate(over="ignore"):
        while done < n:
            out[done: 2 * done] = out[: min(done, n - done)] * step
            step, done = step * step, 2 * done
    return out


class Shingler:
    """Sorted distinct 56-bit hashes of a text's word shingles, by prefix sums of a byte polynomial."""

    def __init__(self, words: int = 5):
        self.words, self.up, self.down = words, _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)

    def __call__(self, text: str | None) -> np.ndarray:
        raw = (text or "").encode("utf-8").translate(LOWER).split()
        if not raw:
            return np.zeros(0, dtype=np.uint64)
        joined = b" ".join(raw)
        while len(joined) > len(self.up):
            self.up, self.down = _powers(_BASE, 2 * len(self.up)), _powers(_INVERSE, 2 * len(self.down))
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        k = min(self.words, len(raw))
        with np.errstate(over="ignore"):
            sums = np.zeros(len(joined) + 1, dtype=np.uint64)
            np.cumsum(_CODES[np.frombuffer(joined, np.uint8)] * self.up[: len(joined)], out=sums[1:])
            first, last = starts[: len(raw) - k + 1], ends[k - 1:]
            h = (sums[last] - sums[first]) * self.down[first]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            h >>= np.uint64(8)
        return np.unique(h)


def pack(hashes: np.ndarray) -> bytes:
    """Seven bytes a hash, little-endian."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 7, 8), dtype=np.uint8)
    out[:, :7] = np.frombuffer(packed, np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel()


def needed(n: int, percent: int) -> int:
    """T of a set of n: the least intersection with any partner."""
    return -(-percent * n // 100)


def linked(common, n: int, m: int, percent: int) -> bool:
    return 100 * common >= percent * (n + m - common)


def set_bits(hashes: np.ndarray) -> bytes:
    """A bitmap of a set: two to four bits for each member, a power of two in all."""
    size = 1 << max(3, int(2 * max(1, len(hashes)) - 1).bit_length())
    bits = np.zeros(size, dtype=bool)
    bits[(hashes & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def most_common(n: int, own: bytes, other: bytes) -> int:
    """A bound, never too low, on the intersection of a set of n with another one: every bit that is set
    for the one alone stands for a member the other lacks. Bitmaps fold onto the smaller size."""
    a, b = np.frombuffer(own, np.uint8), np.frombuffer(other, np.uint8)
    size = min(len(a), len(b))
    a, b = np.bitwise_or.reduce(a.reshape(-1, size)), np.bitwise_or.reduce(b.reshape(-1, size))
    return n - int(np.bitwise_count(a & ~b).sum())


def set_key(hashes: np.ndarray) -> int:
    """64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, x): one narrow row per document; x names the set, null for empty sets."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memory()
        shingle = Shingler(words)
        for batch in batches:
            n, x = [], []
            for value in batch.column(1):
                h = shingle(value.as_py())
                n.append(len(h))
                x.append(set_key(h) if len(h) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(x, pa.int64())], names=["doc_id", "n", "x"])

    return docs.mapInArrow(run, "doc_id long, n long, x long")


def _long_shingles(docs: DataFrame, words: int) -> np.ndarray:
    """Sorted hashes of shingles that many sampled sets hold: an order hint, at most MAX_LONG (8 MB)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memory()
        shingle, held, size = Shingler(words), [], 0

        def counted():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])

        for batch in batches:
            for value in batch.column(0):
                held.append(shingle(value.as_py()))
                size += len(held[-1])
                if size >= SEEN:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    sample = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SAMPLE)) == 0).select("text")
    rows = (sample.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= LONG_IN_SAMPLE)
            .orderBy(F.desc("c"), "h").limit(MAX_LONG).select("h").toArrow())
    return np.sort(rows["h"].to_numpy().astype(np.int64).view(np.uint64))


def short_lists(h: np.ndarray, long: np.ndarray, percent: int) -> np.ndarray:
    """The n - T + 1 shingles of a set that come first in the order (not long, then by hash)."""
    p = len(h) - needed(len(h), percent) + 1
    if len(long):
        at = np.minimum(np.searchsorted(long, h), len(long) - 1)
        is_long = long[at] == h
        h = np.concatenate([h[~is_long], h[is_long]])
    return h[:p]


def _postings(docs: DataFrame, words: int, percent: int, long: np.ndarray) -> DataFrame:
    """(h, x) of the short lists. A task gives out each set once, so copies reach a list at most
    once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(long)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memory()
        shingle, order, seen = Shingler(words), shared.value, set()
        for batch in batches:
            hs, xs = [], []
            for value in batch.column(0):
                h = shingle(value.as_py())
                if not len(h) or (x := set_key(h)) in seen:
                    continue
                if len(seen) >= SEEN:  # bounded; what is given out again is merged by Spark
                    seen.clear()
                seen.add(x)
                hs.append(short_lists(h, order, percent))
                xs.append(np.full(len(hs[-1]), x, dtype=np.int64))
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(xs))], names=["h", "x"])

    return docs.select("text").mapInArrow(run, "h long, x long")


def _shared(postings: DataFrame) -> DataFrame:
    """(list, x, lists): the lists that hold two sets or more, equal lists as one with their number.

    The texts' postings are shuffled once, on h; lists are equal when their sets' hashes add up to
    the same two sums. Shingles of one passage or of one group of near copies mostly share a list."""
    one = postings.repartition(parallelism(postings.sparkSession), "h").groupBy("h", "x").agg(F.lit(1).alias("one"))
    own = Window.partitionBy("h")
    named = (one.withColumns({"size": F.count(F.lit(1)).over(own),
                              "one": F.sum(F.shiftright(F.xxhash64("x"), 20)).over(own), "two": F.sum(F.shiftright(F.xxhash64("x", F.lit(1)), 20)).over(own)})
             .filter("size > 1"))
    return named.groupBy(F.xxhash64("one", "two", "size").alias("h"), "x").agg(F.count(F.lit(1)).alias("lists"))


#: Rows of two narrow columns (some 32 MB in memory) up to which a list of ids is broadcast.
BROADCAST_IDS = 1 << 20


def _checked(ids: DataFrame, name: str) -> DataFrame:
    """Distinct ids, written and counted: broadcast up to BROADCAST_IDS, beyond that joined by shuffle."""
    ids = materialize(ids, name)
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _hashes_of(docs: DataFrame, sets: DataFrame, near: DataFrame, words: int) -> DataFrame:
    """(x, n, bits, hashes) of the sets in ``near``, made again from one document of each."""
    chosen = sets.join(near, "x", "left_semi").groupBy("x").agg(F.min("doc_id").alias("doc_id"))
    chosen = _checked(chosen, "chosen")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memory()
        shingle = Shingler(words)
        schema = pa.schema([("x", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()), ("hashes", pa.binary())])
        for batch in batches:
            found, size = [], 0
            for x, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                h = shingle(value.as_py())
                if len(h) and set_key(h) == x:  # an id may have several texts
                    found.append({"x": x, "n": len(h), "bits": set_bits(h), "hashes": pack(h)})
                    size += h.nbytes
                if size > 4 << 20:  # small batches: the hashes are larger than the texts they come from
                    yield pa.RecordBatch.from_pylist(found, schema=schema)
                    found, size = [], 0
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    return docs.join(chosen, "doc_id").select("x", "text").mapInArrow(run, "x long, n long, bits binary, hashes binary")


# ---- probing --------------------------------------------------------------------

def divide_skip(query: list[int], lists: dict[int, list[int]], need: int) -> dict[int, int]:
    """Occurrences, by DivideSkip, of the ids that occur in at least ``need`` of the query's lists.

    The longest lists, at most need - 1, are set aside; a heap merges the others, and ids that may still
    reach ``need`` are looked up in the long lists by binary search."""
    own = sorted((lists[q] for q in query if q in lists), key=len)
    if len(own) < need:
        return {}
    # Merging costs the short lists' total, probing one search per long list and candidate.
    total = sum(map(len, own))
    aside = min(need - 1, len(own), max(0, int(need / (0.0085 * np.log2(max(2, total)) + 1))))
    short, long = own[: len(own) - aside], own[len(own) - aside:]
    heap = [(ids[0], i, 0) for i, ids in enumerate(short) if ids]
    heapq.heapify(heap)
    out: dict[int, int] = {}
    while heap:
        current, count = heap[0][0], 0
        while heap and heap[0][0] == current:
            _, i, at = heap[0]
            count += 1
            if at + 1 < len(short[i]):
                heapq.heapreplace(heap, (short[i][at + 1], i, at + 1))
            else:
                heapq.heappop(heap)
        if count >= need - aside:
            for k, ids in enumerate(long):
                if count + len(long) - k < need:
                    break
                at = bisect.bisect_left(ids, current)
                count += at < len(ids) and ids[at] == current
            if count >= need:
                out[current] = count
    return out


def block_links(query: np.ndarray, members: list[np.ndarray], percent: int) -> list[int]:
    """Places of the ``members`` that link with ``query``."""
    n = len(query)
    fits = [i for i, m in enumerate(members) if 100 * min(n, len(m)) >= percent * max(n, len(m))]
    if not n or not fits:
        return []
    found = divide_skip(query.tolist(), inverted_lists(query, members, fits), needed(n, percent))
    return [i for i, common in found.items() if linked(common, n, len(members[i]), percent)]


def inverted_lists(query: np.ndarray, members: list[np.ndarray], fits: list[int]) -> dict[int, list[int]]:
    """The query's shingles to the ascending places of the members that hold them, from one sort of the members' hashes."""
    hashes = np.concatenate([members[i] for i in fits])
    places = np.repeat(np.asarray(fits, dtype=np.int32), [len(members[i]) for i in fits])
    order = np.argsort(hashes, kind="stable")   # members stay in order within a hash
    hashes, places = hashes[order], places[order]
    first, last = np.searchsorted(hashes, query, "left"), np.searchsorted(hashes, query, "right")
    return {q: places[a:b].tolist() for q, a, b in zip(query.tolist(), first.tolist(), last.tolist()) if a < b}


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` that may link by their bitmaps: an exact filter, a thirtieth of the hashes' size."""
    def may_link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memory()
        for batch in batches:
            keep = [linked(min(most_common(n, x, y), most_common(m, y, x)), n, m, percent)
                    for n, x, m, y in zip(*[batch.column(c).to_pylist() for c in ("a_n", "a_bits", "b_n", "b_bits")], strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ids = _checked(pairs.select(F.col("a").alias("x")).unionByName(pairs.select(F.col("b").alias("x"))).distinct(), "asked")
    sets = sets.select("x", "n", "bits").join(ids, "x", "left_semi")
    side = lambda c: sets.select(F.col("x").alias(c), F.col("n").alias(f"{c}_n"), F.col("bits").alias(f"{c}_bits"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(may_link, "a long, b long")


def _probe(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the candidate ``pairs`` (a, b) that link. ``sets``: (x, n, bits, hashes).

    A query's candidates are cut into blocks of about BLOCK, so a query set with many candidates is
    spread; its hashes go to each of its blocks, those of a candidate to each block that has it."""
    pairs = materialize(_possible(materialize(pairs, "candidates"), sets, percent), "pairs")
    spread = pairs.join(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "a")
    spread = spread.withColumn("block", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("b"), F.col("blocks"))).otherwise(0).cast("int"))
    wanted = (spread.select(F.col("b").alias("x"), "a", "block", F.lit(1).alias("member"))
              .unionByName(spread.select(F.col("a").alias("x"), "a", "block", F.lit(0).alias("member")).distinct()))
    ids = _checked(wanted.select("x").distinct(), "wanted")
    rows = wanted.join(sets.select("x", "hashes").join(ids, "x", "left_semi"), "x")

    def run(key: tuple, block: pa.Table) -> pa.Table:
        query, members, names = None, [], []
        for member, x, hashes in zip(*[block[c].to_pylist() for c in ("member", "x", "hashes")], strict=True):
            if member:
                members.append(unpack(hashes))
                names.append(x)
            else:
                query = unpack(hashes)
        found = [names[i] for i in block_links(query, members, percent)] if query is not None else []
        return pa.table({"a": pa.array([key[0].as_py()] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return rows.groupBy("a", "block").applyInArrow(run, "a long, b long")


class Bitmaps:
    """Bitmaps of a block's members, a matrix for each size, and the bound of ``most_common`` on all at once."""

    def __init__(self, sizes: list[int], bits: list[bytes]):
        self.sizes = np.asarray(sizes, dtype=np.int64)
        places: dict[int, list[int]] = {}
        for i, b in enumerate(bits):
            places.setdefault(len(b), []).append(i)
        self.groups = [(np.asarray(at), np.stack([np.frombuffer(bits[i], np.uint8) for i in at])) for at in places.values()]

    def may_link(self, n: int, own: bytes, percent: int) -> list[int]:
        found: list[int] = []
        whole = np.frombuffer(own, np.uint8)
        for at, matrix in self.groups:
            m = self.sizes[at]
            fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            if not fits.any():
                continue
            at, m, other = at[fits], m[fits], matrix[fits]
            size = min(len(whole), other.shape[1])
            a = np.bitwise_or.reduce(whole.reshape(-1, size))
            b = np.bitwise_or.reduce(other.reshape(len(at), -1, size), axis=1)
            common = np.minimum(n - np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64),
                                m - np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64))
            found += at[linked(common, n, m, percent)].tolist()
        return sorted(found)


def _probe_crowds(at: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of sets with larger components that are crowds and share a list with them.

    ``at``: (h, x, n, comp, size). A crowd's sets are cut into blocks and its queries into slices, both
    small enough for a worker; each (block, slice) is one group, which gives out links only."""
    crowd_of = at.filter(F.col("size") > CROWD).select("h", F.col("comp").alias("crowd"), F.col("size").alias("crowd_size")).distinct()
    asked = materialize(at.join(crowd_of, "h").filter(F.struct("size", "comp") < F.struct("crowd_size", "crowd"))
                        .select(F.col("x").alias("a"), "crowd").distinct(), "crowd-queries")
    each = F.least(F.lit(BLOCK), F.greatest(F.lit(4), F.floor(F.lit(BLOCK_SHINGLES) / F.max("n"))))
    sets = at.filter(F.col("size") > CROWD).select("x", "n", F.col("comp").alias("crowd")).distinct()
    # One row a crowd that is asked.
    crowds = materialize(asked.groupBy("crowd").agg(F.count(F.lit(1)).alias("queries"))
                         .join(sets.groupBy("crowd").agg(F.count(F.lit(1)).alias("sets"), each.alias("each")), "crowd")
                         .select("crowd", F.ceil(F.col("sets") / F.col("each")).cast("int").alias("blocks"),
                                 F.ceil(F.col("queries") / F.col("each")).cast("int").alias("slices")), "crowds")
    place = lambda c, seed, parts: F.pmod(F.xxhash64(c, F.lit(seed)), F.col(parts)).cast("int")
    all_of = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    wanted = (sets.join(crowds, "crowd").select("x", "crowd", place("x", 0, "blocks").alias("block"), all_of("slices").alias("slice"), F.lit(1).alias("member"))
              .unionByName(asked.join(crowds, "crowd").select(F.col("a").alias("x"), "crowd", all_of("blocks").alias("block"),
                                                              place("a", 1, "slices").alias("slice"), F.lit(0).alias("member"))))
    ids = _checked(wanted.select("x").distinct(), "wanted")
    rows = wanted.join(members.join(ids, "x", "left_semi"), "x").select("crowd", "block", "slice", "member", "x", "n", "bits", "hashes")

    def run(table: pa.Table) -> pa.Table:
        own = {m: table.filter(pc.equal(table["member"], m)) for m in (0, 1)}
        names, lists = own[1]["x"].to_pylist(), [unpack(h) for h in own[1]["hashes"].to_pylist()]
        bitmaps = Bitmaps(own[1]["n"].to_pylist(), own[1]["bits"].to_pylist())
        a, b = [], []
        for x, n, bits, hashes in zip(*[own[0][c].to_pylist() for c in ("x", "n", "bits", "hashes")], strict=True):
            near = bitmaps.may_link(n, bits, percent)
            found = [names[near[i]] for i in block_links(unpack(hashes), [lists[i] for i in near], percent)]
            a += [x] * len(found)
            b += found
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("crowd", "block", "slice").applyInArrow(run, "a long, b long")


def _list_pairs(big: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: pairs of sets of one list, in different components, whose bitmaps may link.

    ``big``: (h, x, comp, total, longest). A list is cut into blocks of about the root of its size (BLOCK to
    LIST_BLOCK sets, fewer if they are long); each two blocks, and each block with itself, are one
    group. Rows dealt out grow with the size's power of 1.5 up to LIST_BLOCK squared sets; bitmaps are still
    compared for all pairs of similar size, but pairs beyond the bound make no row."""
    each = F.least(F.greatest(F.lit(BLOCK), F.least(F.lit(LIST_BLOCK), F.ceil(F.sqrt("total")))),
                   F.greatest(F.lit(4), F.floor(F.lit(BLOCK_SHINGLES) / F.col("longest"))))
    dealt = (big.withColumn("parts", F.ceil(F.col("total") / each).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("x", "h"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "x", "comp"))
    ids = _checked(big.select("x").distinct(), "listed")
    rows = dealt.join(members.select("x", "n", "bits").join(ids, "x", "left_semi"), "x")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        first, second = key[1].as_py(), key[2].as_py()
        asked = table.filter(pc.equal(table["own"], first))
        others = asked if first == second else table.filter(pc.equal(table["own"], second))
        names, comps = others["x"].to_pylist(), others["comp"].to_pylist()
        bitmaps = Bitmaps(others["n"].to_pylist(), others["bits"].to_pylist())
        found: set[tuple[int, int]] = set()
        for x, comp, n, bits in zip(*[asked[c].to_pylist() for c in ("x", "comp", "n", "bits")], strict=True):
            found.update((min(x, names[i]), max(x, names[i])) for i in bitmaps.may_link(n, bits, percent) if comps[i] != comp)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return rows.groupBy("h", "i", "j").applyInArrow(run, "a long, b long")


# ---- components -----------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(x, comp): the least node that each node of ``links`` (a, b) reaches.

    Each round a node takes the least label around it, then the label of its label. A hot node's
    labels are pre-aggregated before each shuffle; rounds are written to shared scratch."""
    edges = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "x"), "labels")
    while True:
        around = edges.join(labels.select(F.col("x").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        lower = labels.join(around.withColumnRenamed("a", "x"), "x").select("x", "comp", F.least("comp", "near").alias("near"))
        jumped = lower.join(labels.select(F.col("x").alias("near"), F.col("comp").alias("beyond")), "near") \
            .select("x", F.col("comp").alias("before"), F.least("near", "beyond").alias("comp"))
        after = materialize(jumped, "labels")
        if not after.filter("comp < before").limit(1).count():
            return after.select("x", "comp")
        labels = after.select("x", "comp")


def _with_components(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return rows.withColumn("comp", F.col("x"))
    return rows.join(comps, "x", "left").withColumn("comp", F.coalesce("comp", "x"))


def _grow(links: DataFrame | None, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components and links after ``new`` links are added."""
    new = materialize(new, "links")
    links = new if links is None else links.unionByName(new)
    return components(links), links


def _fits(n: Column, m: Column, percent: int) -> Column:
    return (F.lit(100) * F.least(n, m)) >= (F.lit(percent) * F.greatest(n, m))


def jaccard_components(docs: DataFrame, percent: int = 75, words: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs``: doc_id, n_shingles, component_id (least id reachable by links, itself included)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = materialize(_sets(rows, words), "sets")
    known = rows.filter("doc_id is not null")
    classes = sets.filter("x is not null and doc_id is not null")
    long = _long_shingles(known, words)
    shared = _shared(_postings(known, words, percent, long))
    size_of = classes.groupBy("x").agg(F.max("n").alias("n"))
    postings = materialize(shared.join(size_of, "x"), "postings")
    members = materialize(_hashes_of(known, classes, postings.select("x").distinct(), words), "members")

    full = (postings.join(postings.groupBy("h").agg(F.count(F.lit(1)).alias("full")), "h")
            .groupBy("x").agg(F.sum(F.col("full") * F.col("lists")).alias("fullness")))
    comps, links = None, None
    for first, second in ((F.lit(-1) * F.col("fullness"), F.col("x")), (F.xxhash64("x", F.lit(1)), F.col("x"))):
        at = _with_components(postings.join(full, "x"), comps)
        leader = at.groupBy("h").agg(F.min_by(F.struct("x", "n", "comp"), F.struct(first, second)).alias("lead"))
        # Of the leaders of its lists, a set is proposed to the one that it shares most lists with.
        pairs = (at.join(leader, "h").filter((F.col("comp") != F.col("lead.comp")) & _fits(F.col("n"), F.col("lead.n"), percent))
                 .groupBy(F.col("x").alias("b"), F.col("lead.x").alias("a")).agg(F.sum("lists").alias("lists"))
                 .groupBy("b").agg(F.max(F.struct("lists", "a"))["a"].alias("a")).select("a", "b"))
        comps, links = _grow(links, _probe(pairs, members, percent))
    at = _with_components(postings, comps)
    crowds = at.select("x", "comp").distinct().groupBy("comp").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > CROWD)
    lists = materialize(at.join(_checked(crowds, "crowd-sizes"), "comp", "left").withColumn("size", F.coalesce("size", F.lit(0))), "list-components")
    # The rest, exactly: sets against crowds, and in each list, without the crowds, every set outside the list's
    # largest component against all sets outside its own.
    crowded = _probe_crowds(lists, members, percent)
    at = lists.filter(F.col("size") <= CROWD).drop("size")
    sizes = at.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("size"), F.max("n").alias("longest"))
    largest = (sizes.groupBy("h").agg(F.max(F.struct("size", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"),
                                      F.sum("size").alias("total"), F.max("longest").alias("longest")).filter("comps > 1")
               .select("h", F.col("top.comp").alias("top"), "total", "longest"))
    open_lists = materialize(at.join(largest, "h"), "open-lists")
    in_blocks = _list_pairs(open_lists.filter(F.col("total") > CROWD), members, percent)
    open_lists = open_lists.filter(F.col("total") <= CROWD)
    minor = open_lists.filter("comp != top").select("h", F.col("x").alias("a"), F.col("n").alias("an"), F.col("comp").alias("acomp"))
    pairs = (minor.join(open_lists.select("h", F.col("x").alias("b"), F.col("n").alias("bn"), F.col("comp").alias("bcomp")), "h")
             .filter((F.col("acomp") != F.col("bcomp")) & _fits(F.col("an"), F.col("bn"), percent))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionByName(in_blocks).distinct())
    comps, links = _grow(links, _probe(pairs, members, percent).unionByName(crowded))

    # Component ids: the least doc_id of the sets of a component.
    owned = _with_components(classes.groupBy("x").agg(F.min("doc_id").alias("least")), comps)
    ids = owned.groupBy("comp").agg(F.min("least").alias("component_id"))
    per_set = owned.join(ids, "comp").select("x", "component_id")
    by_set = (classes.join(per_set, "x").groupBy("doc_id").agg(F.min("component_id").alias("component_id")))
    return (sets.join(by_set, "doc_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component, the one with the least id; rows with a null id stay."""
    found = jaccard_components(docs, **options)
    drop = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__llm_id")).distinct()
    return docs.join(drop, docs["doc_id"].cast("long") == drop["__llm_id"], "left_anti")
