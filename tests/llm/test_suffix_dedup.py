"""Removal of repeated passages against brute force over every 100-byte string."""

from __future__ import annotations

import hashlib
import random

import pytest

from encore.llm import suffix_dedup

SCHEMA = "doc_id long, text string, unit long, sha string, `a.b` int, `block` int"


def brute_force(rows, window=suffix_dedup.WINDOW):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by a set of all strings seen so far."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    texts.sort(key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1]).digest()))
    seen, out = set(), []
    for doc_id, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - window + 1):
            if text[i:i + window] in seen:
                gone[i:i + window] = b"\1" * window
            seen.add(text[i:i + window])
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows, partitions=3):
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(partitions)
    return sorted((tuple(r) for r in suffix_dedup.repeated_passages(docs).collect()), key=str)


def passages(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(1, 6))) for _ in range(200)]

    def text(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    shared = [text(rnd.randint(15, 120)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rnd.choice(shared) if rnd.random() < 0.4 else text(rnd.randint(1, 40)) for _ in range(rnd.randint(1, 6))]
        rows.append((rnd.randint(-5, 10**12) if i % 7 else i, " ".join(parts)))
    copy = rows[11][1]
    near = copy[:len(copy) // 2] + "!" + copy[len(copy) // 2:]
    rows += [(900, copy), (901, copy), (902, near), (901, copy), (901, near), (None, copy), (None, shared[0]), (None, None)]
    rows += [(903, ""), (904, None), (905, "z" * 1000), (906, "z" * 250 + "y" + "z" * 99), (907, "ab" * 400), (908, shared[1][:99]), (909, shared[1][:100])]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_every_string(spark, seed):
    rows = passages(seed)
    assert result(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("partitions", [1, 7])
def test_a_passage_that_two_documents_share(spark, partitions):
    """Repeats that one flush holds whole: the first occurrence is a shared sample too."""
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abcdefghij ") for _ in range(n))
    passage = text(400)
    rows = [(i, text(300)) for i in range(20)] + [(50, text(77) + passage + text(90)), (51, text(200) + passage + text(33)), (52, text(5) + passage[100:260])]
    got = result(spark, rows, partitions)
    assert got == brute_force(rows) and sum(r[2] > 0 for r in got) == 2


def test_small_pieces_and_flushes(spark, monkeypatch):
    """Texts cut into many pieces, records sent in many flushes: one process holds all, so the small sizes reach it."""
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    monkeypatch.setattr(suffix_dedup, "FLUSH", 50)
    rows = sorted((t or "", i) for i, (_, t) in enumerate(passages(4)))
    texts = list(dict.fromkeys(t for t, _ in rows))

    def by_unit(sent, width, shared):
        rows = sorted((r for b in sent for r in b.to_pylist()), key=lambda r: r["bucket"])
        settled = list(suffix_dedup._sort_buckets(width, shared)([pa.RecordBatch.from_pylist(rows, pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("blob", pa.binary())]))]))
        rows = sorted((r for b in settled for r in b.to_pylist()), key=lambda r: r["block"])
        return {r["unit"]: r["marks"] for b in suffix_dedup._by_unit([pa.RecordBatch.from_pylist(rows, pa.schema([("block", pa.int64()), ("blob", pa.binary())]))]) for r in b.to_pylist()}

    def batch(**known):
        columns = {"unit": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)}
        columns |= {k: pa.array([v.get(u) for u in range(len(texts))], pa.binary()) for k, v in known.items()}
        return pa.RecordBatch.from_pydict(columns)

    samples = by_unit(suffix_dedup._cover_samples(7)([batch()]), 5, True)
    segments = by_unit(suffix_dedup._suffixes(7, True)([batch(samples=samples)]), 8, False)
    suffixes = by_unit(suffix_dedup._suffixes(7, False)([batch(samples=samples, segments=segments)]), 8, False)
    cut = [r for b in suffix_dedup._cut([batch(segments=segments, suffixes=suffixes)]) for r in b.to_pylist()]
    want, seen = [], set()
    for text in (t.encode() for t in texts):  # here units are in order of the list
        gone = bytearray(len(text))
        for i in range(len(text) - 99):
            if text[i:i + 100] in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(text[i:i + 100])
        want.append(hashlib.sha256(bytes(b for b, g in zip(text, gone) if not g)).hexdigest())
    assert [r["kept_sha256"] for r in cut if texts[r["unit"]]] == [w for w, t in zip(want, texts) if t]


def test_cover_has_every_shift():
    for i in range(suffix_dedup.V):
        for j in range(suffix_dedup.V):
            assert any((i + d) % suffix_dedup.V in suffix_dedup.D and (j + d) % suffix_dedup.V in suffix_dedup.D for d in range(suffix_dedup.V))


def test_packed_records_round_trip():
    import numpy as np

    unit, at = np.array([3, 3, 7, 2**40]), np.array([5, 2**31, 0, 9])
    span, h = np.array([1, 64, 100, 2]), np.array([2**63, 1, 2**40 - 1, 0], np.uint64)
    for got, want in zip(suffix_dedup._unpack(suffix_dedup._pack(unit, at, span, h, 8), 8), (unit, at, span, h)):
        assert (got == want).all()


def test_empty_table_and_short_texts(spark):
    assert result(spark, []) == []
    rows = [(1, "short"), (1, "short"), (2, None)]
    assert result(spark, rows) == brute_force(rows)
