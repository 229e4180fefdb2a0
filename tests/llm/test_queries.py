"""The registered queries against their contracts, over whole tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from tokenizers import Tokenizer

from encore.llm import langid, pii
from encore.llm.queries import QUERIES


def run(spark, n):
    name = next(q for q in QUERIES if q.startswith(f"op{n}_"))
    return QUERIES[name](spark, SF_SMALL)


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    return {r.doc_id: r for r in rows}


def crc_fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


@pytest.mark.parametrize("n, folds, held", [(6, 4, 2), (7, 5, 0)])
def test_labelled_scores(spark, documents, n, folds, held):
    df = run(spark, n)
    assert dict(df.dtypes) | {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"} == dict(df.dtypes)
    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        assert r.held_out == (crc_fold(r.doc_id, folds) == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_languages(spark, documents):
    rows = run(spark, 10).collect()
    learned = {d.lang for i, d in documents.items() if d.lang is not None and crc_fold(i, 3) != 1}
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        text = documents[r.doc_id].text
        assert r.held_out == (crc_fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, text or ""))) and r.lang_pred in learned | {"und"}
    known = [r for r in rows if r.held_out and documents[r.doc_id].lang]
    assert np.mean([r.lang_pred == documents[r.doc_id].lang for r in known]) > 0.9


def test_mix(spark, documents):
    rows = run(spark, 2).collect()
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for i, d in documents.items()}
    total = collections.Counter()
    for i, d in documents.items():
        total[d.source] += words[i]
    taken = collections.Counter()
    for r in rows:
        assert r.size == words[r.doc_id] and r.source_size == total[documents[r.doc_id].source] and 0 <= r.taken <= 3 * r.size
        taken[documents[r.doc_id].source] += r.taken
    targets = {documents[r.doc_id].source: r.target for r in rows}
    assert len(rows) == len(documents) and abs(sum(targets.values()) - sum(total.values())) < 1e-6 * sum(total.values())
    assert all(abs(taken[s] - targets[s]) <= 1 and targets[s] <= 3 * total[s] + 1e-9 for s in targets)
    assert sorted(map(str, run(spark, 2).collect())) == sorted(map(str, rows))


def library(name):
    made = Tokenizer.from_file(public_tokenizers.path(name))
    made.no_truncation()
    made.no_padding()
    return made


def test_bpe(spark, documents):
    made = library("byte_bpe_50k.json")
    for r in run(spark, 3).collect():
        ids = made.encode(documents[r.doc_id].text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(made.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_token_output(spark, documents):
    made, start = library("word_bpe_49k.json"), 0
    found = {r.doc_id: r for r in run(spark, 4).collect()}
    for i in sorted(documents):
        ids = [*made.encode(documents[i].text or "", add_special_tokens=False).ids, 2]
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(found) == len(documents)


def test_exact_groups(spark, documents):
    groups = collections.defaultdict(list)
    for i, d in documents.items():
        groups[d.text or ""].append(i)
    for r in run(spark, 5).collect():
        text = documents[r.doc_id].text or ""
        own = groups[text]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(own), len(own), r.doc_id == max(own), hashlib.sha256(text.encode()).hexdigest())


def test_edited_texts(spark, documents):
    order = sorted(documents)
    rows = {r.doc_id: r for r in run(spark, 8).collect()}
    for k, i in enumerate(order):
        text, following = (documents[j].text or "" for j in (i, order[(k + 1) % len(order)]))
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + following[:quarter]
        assert rows[i].n_chars == len(text) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
        if edited == text:
            assert rows[i].fingerprint == rows[i].edited_fingerprint


def test_personal_data(spark, documents):
    """Base spans by the contract's own patterns; the method only adds spans."""
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(kind, match):
        digits = re.sub("[^0-9]", "", match)
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")),
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]

    for r in run(spark, 9).collect():
        text = documents[r.doc_id].text or ""
        spans = sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(patterns.items()) for m in re.finditer(p, text) if ok(kind, m.group()))
        base = [f"{kind}:{s}:{e}" for s, _, kind, e in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        counts = collections.Counter(kind for _, _, kind, _ in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in patterns]
        assert set(base) <= set(r.spans.split(",")) | {""}


def test_repeated_passages(spark, documents):
    seen, want = set(), {}
    for i in sorted(documents):
        text = (documents[i].text or "").encode()
        gone = bytearray(len(text))
        for a in range(len(text) - 99):
            if text[a:a + 100] in seen:
                gone[a:a + 100] = b"\1" * 100
            seen.add(text[a:a + 100])
        want[i] = len(text), sum(gone), hashlib.sha256(bytes(b for b, g in zip(text, gone) if not g)).hexdigest()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in run(spark, 12).collect()} == want


def grams(text):
    """All n-grams of a text, the long way."""
    plain = "".join(c if c.isalpha() else " " for c in text.lower())
    return {plain[i:i + n] for n in range(1, langid.ORDERS + 1) for i in range(len(plain) - n + 1)}


def test_string_kernel_and_ridge_the_long_way():
    texts = ["the cat sat on a mat", "a dog and the log", "on the road again", "der hund und die katze", "die strasse und der weg", "ein mann und ein haus",
             "le chat est sur la table", "la route et le chien"]
    names = ["en"] * 3 + ["de"] * 3 + ["fr"] * 2
    presence = langid.Presence()
    bits = np.array([presence(t) for t in texts])
    kernel = lambda a, b: len(grams(a) & grams(b)) / math.sqrt(len(grams(a)) * len(grams(b)))
    x = bits.astype(np.float32)
    got = langid.normalised(x, x, np.sqrt(x.sum(axis=1)))
    # equal but for n-grams that share a bucket
    assert np.abs(got - [[kernel(a, b) for b in texts] for a in texts]).max() < 0.03
    # all texts as landmarks: ridge regression in the kernel's own space, solved in its dual form
    model = langid.fit(bits, names, landmarks=len(texts), ridge=0.1)
    weight = np.array([1 / names.count(y) for y in names])
    weight *= len(names) / weight.sum()
    gram = got.astype(float)
    new = ["the man on the road", "und das haus", "le chien sur la route", "xyz"]
    y = np.array([presence(t) for t in new]).astype(np.float32)
    between = langid.normalised(y, x, np.sqrt(x.sum(axis=1))).astype(float)
    scores = np.zeros((len(new), 3))
    for c, language in enumerate(sorted(set(names))):
        target = np.array([1.0 if n == language else -1.0 for n in names])
        scores[:, c] = between @ np.linalg.solve(gram + 0.1 * np.diag(1 / weight), target)
    out = np.exp(4 * (scores - scores.max(axis=1, keepdims=True)))
    out /= out.sum(axis=1, keepdims=True)
    languages, best = model.predict(new)
    assert languages == [sorted(set(names))[k] for k in out.argmax(axis=1)]
    assert np.allclose(best, out.max(axis=1), atol=1e-3)
