"""The tree-merge of digest runs: rounds, order of runs, verified digests, odd column names."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import exact_dedup


def entries(rows):
    out = np.zeros(len(rows), exact_dedup.ENTRY)
    for i, (digest, check, doc_id, row, copies) in enumerate(rows):
        out[i] = (digest >> 2, 0, 0, digest, 10, check, doc_id is not None, doc_id or 0, row, copies)
    return out


def test_rounds_are_binomial():
    assert exact_dedup.rounds(32) == [(k, 1) for k in range(5)]
    assert exact_dedup.rounds(33)[-1] == (5, 1) and len(exact_dedup.rounds(33)) == 6
    assert exact_dedup.rounds(32, fan_in=4) == [(0, 2), (2, 2), (4, 1)]
    assert exact_dedup.rounds(1) == []


def test_merged_runs_are_sorted_and_keep_the_largest_verified_id():
    rnd = random.Random(2)
    rows = [(rnd.randint(0, 20), rnd.randint(0, 1), rnd.choice([None, 1, 2, 2**40]), i, rnd.randint(1, 3)) for i in range(400)]
    runs = [exact_dedup.merge_runs([entries(rows[a:a + 40])]) for a in range(0, 400, 40)]
    whole = exact_dedup.merge_runs(runs)
    best, copies = {}, collections.Counter()
    for digest, check, doc_id, row, n in rows:
        key = digest, check   # equal digests of texts that differ stay apart
        copies[key] += n
        best[key] = max(best.get(key, (False, 0, -1e9)), (doc_id is not None, doc_id or 0, -row))
    got = {(int(e["d3"]), int(e["check"])): (bool(e["has_id"]), int(e["doc_id"]), -int(e["row"])) for e in whole}
    assert got == best and {(int(e["d3"]), int(e["check"])): int(e["copies"]) for e in whole} == copies
    keys = [tuple(int(e[c]) for c in exact_dedup.IDENTITY) for e in whole]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


@pytest.mark.parametrize("fan_in", [2, 8])
def test_32_partitions_with_a_hot_text(spark, fan_in):
    rnd = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"t{rnd.randint(0, 150)}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(32)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs, fan_in=fan_in).collect()}
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    assert got == {i: (max(groups[t]), len(groups[t]), i == max(groups[t])) for i, t in rows}
    runs = exact_dedup.digest_runs(docs)
    root = exact_dedup.merge_tree(runs, fan_in).mapInArrow(exact_dedup._root_entries, "digest binary, n_bytes long, check long, keep_id long, keep_row long, copies long").collect()
    assert len(root) == len(groups) and sum(r.copies for r in root) == 1200


def test_columns_of_any_name_are_kept(spark):
    docs = spark.createDataFrame([(1, "x", 99, 5), (2, "x", 98, 6), (3, "y", 97, 7)], "doc_id long, text string, __llm_id int, `a.b` int")
    got = sorted(tuple(r) for r in exact_dedup.deduplicate(docs).collect())
    assert got == [(2, "x", 98, 6), (3, "y", 97, 7)]
    renamed = docs.withColumnsRenamed({"doc_id": "the.id", "text": "the`text"})
    assert exact_dedup.deduplicate(renamed, "the.id", "the`text").count() == 2
    assert exact_dedup.exact_groups(renamed, "the.id", "the`text").agg(F.sum("group_size")).first()[0] == 5
