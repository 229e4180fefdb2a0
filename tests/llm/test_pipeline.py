"""The pipeline's stages against brute force at sf0.01, and its contract."""

from __future__ import annotations

import collections
import hashlib
import os
import platform
import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of documents, then of each stage's result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        out.append(result.collect())
        if name != "bpe":
            assert result.columns == docs.columns
        docs = result
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "mixing", "bpe"]


def test_toxicity_keeps_clean_documents(spark, stages):
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages[1]}
    clean = [d for d, t in toxic.items() if not t]
    assert sum(d in kept for d in clean) >= 0.99 * len(clean)
    assert 0 < len(kept) < len(stages[0])


def test_labelled_toxic_documents_go(spark, stages):
    """Of the rows that taught the lexicon nearly all go; those left have no learned term."""
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r["toxic"]}
    kept = {r["doc_id"] for r in stages[1]}
    assert len(toxic - kept) >= 0.6 * len(toxic)


def test_columns_of_any_name_pass(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120).selectExpr(
        "*", "doc_id AS `a.b`", "'x' AS __llm_score", "99 AS __llm_id", "98 AS __llm_draw", "1 AS m_id", "2 AS score")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-odd-{name}")
        rows = docs.collect()
        assert rows and all(r["a.b"] == r["doc_id"] and r["__llm_id"] == 99 and r["__llm_score"] == "x" and r["__llm_draw"] == 98 for r in rows)


def test_exact_copies_go(stages):
    largest = {}
    for r in stages[1]:
        largest[r["text"] or ""] = max(largest.get(r["text"] or "", -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(largest.values())


def test_one_of_each_group_of_near_copies_stays(stages):
    sets = {}
    for r in stages[2]:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    holders = collections.defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    common = collections.Counter((a, b) for ids in holders.values() for a in ids for b in ids if a < b)
    comp = {d: d for d in sets}
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    for _ in range(len(links) + 1):
        moved = False
        for a, b in links:
            low = min(comp[a], comp[b])
            moved |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
        if not moved:
            break
    assert sorted(r["doc_id"] for r in stages[3]) == sorted(set(comp.values()))


def test_mix_comes_near_its_targets(stages):
    words = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    before, after, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in stages[3]:
        before[r["source"]] += words(r)
        largest[r["source"]] = max(largest[r["source"]], words(r))
    for r in stages[4]:
        after[r["source"]] += words(r)
    names = sorted(before)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:
        left = sum(before.values()) - sum(target.values())
        over = [s for s in open_ if left * weight[s] / sum(weight[o] for o in open_) > 3 * before[s]]
        if not over:
            break
        for s in over:
            open_.discard(s)
            target[s] = 3 * before[s]
    target |= {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
    for s in names:  # whole documents: off by less than half of one
        assert abs(after[s] - target[s]) <= largest[s] / 2 + 1
    assert max(collections.Counter(r["doc_id"] for r in stages[4]).values()) <= 3


def test_encoding_is_exact(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    texts = {r["doc_id"]: r["text"] or "" for r in stages[4]}
    assert len(stages[5]) == len(stages[4])
    for r in stages[5]:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        assert (r["n_tokens"], r["ids_sha256"], bytes(r["ids"])) == (len(ids), hashlib.sha256(raw).hexdigest(), raw)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.skipif(not os.path.exists("/proc/self/status") or platform.libc_ver()[0] != "glibc", reason="reads Linux's memory figures")
def test_join_tasks_give_back_what_earlier_stages_left():
    """A Python worker serves all stages in turn: pages freed by an earlier one must not stay beside the join."""
    from encore.llm import ngram_join

    def anonymous_mb():
        with open("/proc/self/status") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("RssAnon")) / 1024

    class Tasks:
        def mapInArrow(self, run, schema):
            return run

    task = ngram_join._sets(Tasks(), 5)
    held = [bytes([i % 251]) * 1000 for i in range(150_000)]   # beyond Python's own allocator
    kept = held[-1:]   # at the end of the heap: what is before it stays with the process
    del held
    before = anonymous_mb()
    assert list(task(iter(()))) == []
    assert before - anonymous_mb() > 70 and len(kept) == 1
