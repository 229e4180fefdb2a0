"""Operators against brute force on small fixtures, with the awkward rows every operator must take."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from encore.llm import bpe, exact_dedup, fingerprints, langid, mixing, ngram_join, pii, quality, token_store, toxicity
from encore.llm.common import BATCH_BYTES, small_batches
from encore.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, score double, x long, h long"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


def awkward(seed=1):
    """Nulls, empty and long texts, ties, repeated rows, near copies and clashing column names."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(300)]

    def text(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    base = text(60).split()
    near = [" ".join(base[:i] + ["changed"] + base[i + 1:]) for i in range(0, 60, 4)]
    texts = [None, "", "   \n", "One", "one", "a b c d", "a b c d", text(4000), *near, *[text(rnd.randint(1, 50)) for _ in range(25)],
             "x" * 3000, "say <|endoftext|> it", "tab\tand\r\nline  two", "É é ñ 漢字 🙂"]
    rows = [(i, t, ("en", "de", None)[i % 3], ("s1", "s2", None)[i % 3], 0, 1, 0.5, 7, 9) for i, t in enumerate(texts)]
    rows += [(None, text(12), "en", "s1", None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def rows():
    return [(r[0], r[1], r[3]) for r in awkward()]


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tokenizer(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


# ---- op1 ------------------------------------------------------------------------

def brute_components(rows):
    sets = {}
    for i, t, _ in rows:
        w = words_of((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[i] = {tuple(w[k: k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]) and comp[a] > comp[b]:
                    comp[a] = comp[b]
                    changed = True
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def test_ngram_components(docs, rows):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs).collect() if r["doc_id"] is not None}
    expected = brute_components([r for r in rows if r[0] is not None])
    assert found == expected
    assert len({c for _, c in found.values()}) < len(found)  # the near copies did link
    assert ngram_join.one_of_each(docs).count() == len({c for _, c in found.values()}) + 2


def test_ngram_chain_over_components(spark):
    """A chain of near copies whose ends don't link is one component."""
    w = [f"w{i}" for i in range(40)]
    texts = []
    for k in range(12):
        texts.append(" ".join(w))
        w[k * 3] = f"n{k}"
    rows = [(i, t, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(df).collect()}
    assert found == brute_components(rows)


def test_ngram_crowd_of_near_copies(spark, monkeypatch):
    """Sets that a large component's sets share lists with, linked to none, some or all of them."""
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        w = list(base)
        for k in range(rnd.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            w[rnd.randrange(60)] = f"e{i}_{k}"
        rows.append((3 * i + 1, " ".join(w), None))
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    expected = brute_components(rows)
    assert 20 < max(collections.Counter(c for _, c in expected.values()).values()) < 160
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 1000)  # several blocks and slices
    monkeypatch.setattr(ngram_join, "CROWD", 20)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(df).collect()}
    assert found == expected


def test_ngram_lists_of_many_small_components(spark, monkeypatch):
    """A passage that many documents share: its lists hold many sets of different components, some linked."""
    rnd = random.Random(5)
    passage, rows = [f"p{i}" for i in range(30)], []
    for i in range(60):
        own = [f"o{i}_{k}" for k in range(rnd.randrange(4, 30))]
        for copy in range(rnd.choice([1, 1, 2, 3])):
            rows.append((7 * len(rows) + 2, " ".join(own[: len(own) - copy] + passage), None))
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    expected = brute_components(rows)
    monkeypatch.setattr(ngram_join, "CROWD", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", 16)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(df).collect()}
    assert found == expected
    assert len(set(c for _, c in found.values())) < len(rows)


def test_bitmaps_bound_never_too_low():
    rnd = np.random.default_rng(3)
    pool = rnd.integers(0, 1 << 56, 400, dtype=np.uint64)
    sets = [np.unique(rnd.choice(pool, rnd.integers(1, 300))) for _ in range(60)]
    assert all((ngram_join.unpack(ngram_join.pack(s)) == s).all() for s in sets)
    bits = [ngram_join.set_bits(s) for s in sets]
    bitmaps = ngram_join.Bitmaps([len(s) for s in sets], bits)
    for s, own in zip(sets, bits):
        near = set(bitmaps.may_link(len(s), own, 50))
        assert near >= {i for i, m in enumerate(sets) if ngram_join.linked(len(np.intersect1d(s, m)), len(s), len(m), 50)}
        assert near == {i for i, m in enumerate(sets) if 2 * min(len(s), len(m)) >= max(len(s), len(m)) and ngram_join.linked(
            min(ngram_join.most_common(len(s), own, bits[i]), ngram_join.most_common(len(m), bits[i], own)), len(s), len(m), 50)}


def test_divide_skip():
    rnd = random.Random(5)
    for _ in range(200):
        lists = {q: sorted(rnd.sample(range(30), rnd.randint(0, 30))) for q in range(rnd.randint(1, 25))}
        need = rnd.randint(1, max(1, len(lists)))
        counts = collections.Counter(i for ids in lists.values() for i in ids)
        assert ngram_join.divide_skip(list(lists), lists, need) == {i: c for i, c in counts.items() if c >= need}


# ---- op2 ------------------------------------------------------------------------

def test_mixing(docs, rows):
    mix = mixing.draws(docs, depth=2)
    found = mix.select("doc_id", "source", "size", "source_size", "target", mixing.taken(mix).alias("taken"), "draws").collect()
    assert len(found) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(words_of(t))
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, total = {}, set(names), sum(sizes.values())
    while True:
        left = total - sum(target.values())
        over = [s for s in open_ if left * weight[s] / sum(weight[o] for o in open_) > 3 * sizes[s] + 1e-9]
        if not over:
            break
        for s in over:
            open_.discard(s)
            target[s] = 3 * sizes[s]
    for s in open_:
        target[s] = left * weight[s] / sum(weight[o] for o in open_)
    taken = collections.Counter()
    for r in found:
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= 0.5
    again = mixing.draws(docs, depth=2).select("doc_id", "source", "text_hash", "draws").collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), str(r["draws"]))
    assert sorted(map(key, again)) == sorted(map(key, found))


def test_splitting_tree_deals_exact_quotas(spark):
    quotas = {"a": 700, "b": 31, "c": 0, None: 5}
    ranges = mixing.splitting_tree(spark.createDataFrame(list(quotas.items()), "source string, draws long"), 3, 11).collect()
    per_shard = collections.Counter()
    for s, n in quotas.items():
        own = sorted((r["first"], r["last"]) for r in ranges if r["source"] == s)
        assert [a for a, _ in own] == [0, *[b for _, b in own[:-1]]][: len(own)] and (own[-1][1] if own else 0) == n
    for r in ranges:
        per_shard[r["shard"]] += r["last"] - r["first"]
    assert max(per_shard.values()) - min(per_shard.values()) <= 1


def test_hypergeometric_matches_its_distribution(spark):
    df = spark.range(20_000).select(mixing.hypergeometric(F.lit(50).cast("long"), F.lit(20).cast("long"), F.lit(10).cast("long"),
                                                          (F.col("id") + 0.5) / 20_000).alias("k"))
    counts = {r["k"]: r["count"] / 20_000 for r in df.groupBy("k").count().collect()}
    from math import comb
    for k in range(11):
        assert counts.get(k, 0) == pytest.approx(comb(20, k) * comb(30, 10 - k) / comb(50, 10), abs=2e-4)


# ---- op3, op4 -------------------------------------------------------------------

def test_bpe_equals_the_library(docs, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, model = tokenizer("byte_bpe_50k.json"), bpe.load(path)
    rnd = random.Random(2)
    letters = " \n\t\x0b\x1c\x85\xa0 ab'sSt12é漢🙂́<|endoftext|>-_"
    texts = [t or "" for _, t, _ in rows] + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    for text, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = model.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == e.ids
        assert model.decode(ids) == library.decode(e.ids, skip_special_tokens=False)
    found = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"]) for r in bpe.digests(docs, path).collect())
    expected = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((str(i), len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()))
    assert found == sorted(expected)
    trip = bpe.decode(bpe.encode(docs.select("doc_id", "text"), path), path)
    assert trip.filter("coalesce(text, '') <> decoded").count() == 0


def test_token_store_round_trip(spark, docs, rows):
    library = tokenizer("word_bpe_49k.json")
    path = scratch_path(spark, "store-test")
    token_store.write_store(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2, shard_ids=500)
    found = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_store.read_documents(spark, path).collect()]
    expected, start = [], 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        expected.append((i, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(found, key=lambda r: r[1]) == expected
    assert token_store.get(spark, path, 5) == library.encode("a b c d", add_special_tokens=False).ids + [2]
    assert token_store.get(spark, path, 10**9) is None


def test_chunked_tokens_equal_whole_texts():
    library, model = tokenizer("word_bpe_49k.json"), token_store.encoder(public_tokenizers.path("word_bpe_49k.json"))
    rnd = random.Random(4)
    letters = " \n\t\r\x0b\x1c\x85\xa0 ab'sSt12éÉ漢🙂́<|endoftext|>ΣİªẞA.,,-_"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    for text, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(model.encode(text), model.dtype).tolist() == e.ids


def test_a_word_is_encoded_once_whatever_its_capitals_and_marks():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, model = tokenizer("word_bpe_49k.json"), token_store.ChunkEncoder(path)
    asked, encode = [], model._encode_words
    model._encode_words = lambda words: asked.extend(words) or encode(words)
    texts = ["Streaming streaming*** STREAMING!! streaming.", None, "", " \t", "(streaming), don't stop", "\u00c9t\u00e9&&& \u00e9t\u00e9 x<|endoftext|>", "a" * 60 + "##"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, model.dtype).tolist() for b in model.encode_all(pa.array(texts, pa.string()))] == want
    assert sorted(asked) == ["stop", "streaming", "\u00e9t\u00e9"]
    blocks = list(token_store.text_blocks(pa.record_batch({"doc_id": [1, 2, 3], "text": ["a" * token_store.BLOCK_BYTES, None, "b"]})))
    assert [b.num_rows for b in blocks] == [2, 1]


def test_perfect_hash_is_minimal_and_refuses_strangers():
    for n in (1, 2, 7, 500):
        hashes = token_store.key_hash(np.arange(n) * 13, np.zeros(n, np.uint32))
        slots = token_store.lookup_slots(hashes, token_store.build_index(hashes), n)
        assert sorted(slots.tolist()) == list(range(n))


# ---- op5 ------------------------------------------------------------------------

def test_exact_groups(docs, rows):
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    found = exact_dedup.exact_groups(docs, fan_in=2).collect()
    assert len(found) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = by_sha[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids) and r["keep_id"] == (max(known) if known else None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sum(r["kept"] for r in found) == len(groups)


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, "b", 3), (2, "c", 4), (None, "d", 5), (None, "d", 6)], "doc_id long, text string, row long")
    found = exact_dedup.exact_groups(df.repartition(3)).collect()
    assert len(found) == 6 and sum(r["kept"] for r in found) == 4
    assert sorted((r["doc_id"] or 0, r["text"]) for r in exact_dedup.deduplicate(df).collect()) == [(0, "d"), (1, "a"), (2, "b"), (2, "c")]


def test_texts_without_words_stay_once_in_the_mix(spark, docs, rows):
    odd = [(900, None, "s1"), (901, "", "s2"), (902, " \n\t", None), (903, None, "nothing else"), (None, None, "s1"), (None, None, "s1")]
    table = docs.select("doc_id", "text", "source").unionByName(spark.createDataFrame(odd, "doc_id long, text string, source string"))
    found = [tuple(r) for r in mixing.mixed_documents(table, depth=2).collect() if not words_of(r["text"])]
    assert sorted(map(str, found)) == sorted(str(r) for r in [*rows, *odd] if not words_of(r[1]))


# ---- op6, op7, op10 -------------------------------------------------------------

def classified(spark, positive, seed=3):
    rnd = random.Random(seed)
    texts, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        texts.append((i, positive(rnd) if bad else " ".join(rnd.choice(["alpha", "bravo", "carol", "delta", "river"]) for _ in range(20)), "en", "s", 0))
        labels.append((i, 0 if bad else 1, int(bad)))
    return (spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity(spark, docs, empty):
    bad = lambda r: " ".join(r.choice(["alpha", "bravo", "carol"]) for _ in range(9)) + " " + r.choice(["insultus", "vilewretch", "gruntling"])
    texts, labels = classified(spark, bad)
    model = toxicity.train(texts, labels)
    assert {"insultus", "vilewretch", "gruntling"} <= set(model.lexicon.words) | set(model.lexicon.stems) | \
        {w for w in ("insultus", "vilewretch", "gruntling") if any(w.startswith(s) for s in model.lexicon.stems)}
    scored = {r["doc_id"]: r["score"] for r in toxicity.with_score(texts, model).collect()}
    assert all((scored[i] >= 0.3) == (i % 4 == 0) for i in scored)
    assert model.lexicon.lookup("vilewretsh") == (model.lexicon.words["vilewretch"], False) if "vilewretch" in model.lexicon.words else True
    assert 0 <= min(r[0] for r in toxicity.with_score(docs, model, score="s").select("s").collect())
    assert toxicity.with_score(empty, model, score="s").count() == 0
    nothing = toxicity.train(empty, labels)
    assert {r[0] for r in toxicity.with_score(texts, nothing).select("score").collect()} < {r for r in [0.0]} | {nothing.scores(np.zeros((1, 6)))[0]} | {0.0}


def test_levenshtein_automaton_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        return row[-1]

    rnd = random.Random(6)
    terms = {"".join(rnd.choice("abc") for _ in range(rnd.randint(5, 8))): 1.0 for _ in range(30)}
    lexicon = toxicity.Lexicon(terms)
    for _ in range(400):
        w = "".join(rnd.choice("abc") for _ in range(rnd.randint(5, 9)))
        expected = min(distance(w, t) for t in terms) <= 1
        assert (lexicon.lookup(w) is not None) == expected, w


def test_disguised_spellings_of_learned_terms(spark):
    lexicon = toxicity.Lexicon({"idiot": 2.0, "trash": 3.0, "scum": 4.0, "moron": 5.0}, {"grun": 6.0})
    read = toxicity.Evidence(lexicon)
    for text, weight in {"id1ot": 2, "m*ron,": 5, "(tr4sh)": 3, "sc*m!": 4, "$cum": 4, "idi-ot": 2, "gr*ntling": 6, "gr.untling": 6,
                         "idoit": 2, "moorn": 5, "tarsh": 3, "*tr4sh*": 3}.items():
        assert read(f"you {text} go")[2] == pytest.approx(np.log1p(weight)), text
    # Words of a token that are hits themselves count once, and most tokens are none.
    assert read("idiot,trash")[0] == pytest.approx(np.log1p(5)) and read("idiot,trash")[2] == 0 and read("trash1")[2] == 0
    for text in ("it's", "1234", "x1y2z3", "scam", "h1dden", "a.b@c.example"):
        assert read(f"you {text} go") == [0.0] * toxicity.N_FEATURES, text
    assert read('he said "id1ot" twice')[1:3] == [pytest.approx(np.log1p(2)), 0]
    # Swaps against brute force.
    rnd = random.Random(7)
    for _ in range(200):
        term = "".join(rnd.choice("abcd") for _ in range(rnd.randint(5, 8)))
        i = rnd.randrange(len(term) - 1)
        assert toxicity.Lexicon({term: 1.0}).lookup(term[:i] + term[i + 1] + term[i] + term[i + 2:], True) is not None
    bad = lambda r: " ".join(r.choice(["alpha", "bravo", "carol"]) for _ in range(9)) + " " + r.choice(["insultus", "vilewretch", "gruntling"])
    model = toxicity.train(*classified(spark, bad))
    odd = ["alpha bravo carol ins*ltus", "alpha bravo carol v1lewretch", "alpha bravo carol gr0ntling", "alpha bravo carol"]
    scores = [r["score"] for r in toxicity.with_score(spark.createDataFrame([(t,) for t in odd], "text string").coalesce(1), model).collect()]
    assert min(scores[:3]) > scores[3]


def test_quotation_is_told_from_abuse():
    text = 'he wrote "you gruntling" and left'
    at = text.index("gruntling")
    assert toxicity.is_quoted(text, at, at + 9)
    assert not toxicity.is_quoted("you gruntling go", 4, 13)


def test_quality(spark, docs, empty):
    texts, labels = classified(spark, lambda r: " | ".join(r.choice(["%%%", "12", "zz!!"]) for _ in range(30)))
    model = quality.train(texts, labels)
    scored = {r["doc_id"]: r["score"] for r in quality.with_score(texts, model).collect()}
    assert all((scored[i] >= 0.5) == (i % 4 != 0) for i in scored)
    assert quality.with_score(docs, model, score="s").filter("s is null or s < 0 or s > 1").count() == 0
    assert quality.with_score(empty, model, score="s").count() == 0
    assert quality.train(empty, labels).scores(np.zeros((2, len(quality.FEATURES)))).tolist() == [0.5, 0.5]


def test_discriminant_equals_the_density_formula():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(300, len(quality.FEATURES)))
    y = (rnd.random(300) < 0.4).astype(int)
    model = quality.fit(x, y)
    z = (x - model.centre) / model.scale
    logs = []
    for c in (0, 1):
        cov = np.linalg.inv(model.factors[c]) @ np.linalg.inv(model.factors[c]).T
        d = z - model.means[c]
        logs.append(model.log_priors[c] - 0.5 * (np.log(np.linalg.det(cov)) + np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_language(spark, docs, empty):
    rnd = random.Random(8)
    alphabets = {"aa": "abcde", "bb": "vwxyz"}
    rows = [(i, " ".join("".join(rnd.choice(alphabets[k]) for _ in range(5)) for _ in range(20)), k, "s", 0) for i in range(80) for k in [("aa", "bb")[i % 2]]]
    texts = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = langid.train(texts, per_language=30, landmarks=8)
    assert langid.predict(texts, model).filter("language.lang_pred <> lang").count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (4, "abc")], "doc_id long, text string")
    found = {r["doc_id"]: tuple(r["language"]) for r in langid.predict(odd, model).collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0) and found[4][0] == "aa"
    assert langid.predict(docs, model).count() == docs.count()
    assert langid.predict(odd, langid.train(empty)).filter("language.lang_pred <> 'und'").count() == 0


# ---- op8 ------------------------------------------------------------------------

def test_letters_above_the_first_plane(spark):
    texts = [("en", "the letters of this")] * 30 + [("de", "die Zeichen aus jenem")] * 30 + [("got", "𐌰𐌱𐌲 𐌳𐌴𐌵 𐌶𐌷𐌸")] * 30
    model = langid.train(spark.createDataFrame([(i, t, y) for i, (y, t) in enumerate(texts)], "doc_id long, text string, lang string"),
                         per_language=30, landmarks=8)
    names, scores = model.predict(["🙂🎉", "🇩🇪 🇫🇷", "𝟎𝟏𝟐 𝟗", "𐌴𐌵𐌶", "𝒶𝒷𝒸", "𠀀𠀁"])
    assert list(zip(names[:3], scores[:3])) == [("und", 0.0)] * 3
    assert names[3] == "got" and "und" not in names[3:] and min(scores[3:]) > 0
    # An emoji is a blank of an n-gram like any other character that is no letter.
    presence = langid.Presence()
    assert (presence("one 🙂 two") == presence("one - two")).all()
    assert [i for i in range(0x110000) if presence.letter[i] != chr(i).isalpha()] == []


def test_edited_neighbours(docs, rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for k, (i, t, _) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        q = len(t) // 4
        expected.append((str(i), hashlib.sha256((t[: len(t) - q] + following[:q]).encode()).hexdigest(), len(t)))
    found = fingerprints.fingerprints(docs).collect()
    assert sorted((str(r["doc_id"]), r["edited_sha256"], r["n_chars"]) for r in found) == sorted(expected)
    by_text = collections.defaultdict(set)
    text_of = {i: t or "" for i, t, _ in rows if i is not None}
    for r in found:
        if r["doc_id"] is not None:
            by_text[text_of[r["doc_id"]]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(f) == 1 for f in by_text.values())


def test_collision_rate_is_generalised_jaccard(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(40):
        a = [rnd.choice([f"t{k}" for k in range(30)]) for _ in range(80)]
        rows.append((i, " ".join(a), " ".join(a[: rnd.randint(10, 80)] + [f"u{rnd.randint(0, 20)}" for _ in range(20)])))
    df = spark.createDataFrame(rows, "row long, a string, b string")
    sig = fingerprints.signatures(df, ("a", "b"), groups=64)
    near = {r["row"]: r["near"] for r in sig.select("row", fingerprints.likeness(F.col("items0"), F.col("items1")).alias("near")).collect()}
    errors = []
    for i, a, b in rows:
        x, y = collections.Counter(a.split()), collections.Counter(b.split())
        errors.append(near[i] - sum((x & y).values()) / sum((x | y).values()))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_fingerprints_of_one_row_and_none(spark, empty):
    one = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    row = fingerprints.fingerprints(one).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"a b c a").hexdigest()
    assert fingerprints.fingerprints(empty).count() == 0


# ---- op9 ------------------------------------------------------------------------

def brute_spans(t):
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and pii.luhn(d):
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(found, key=lambda x: (x[1], pii.KINDS.index(x[0]), x[2]))


def test_base_spans():
    rnd = random.Random(3)
    for letters in ("a@.b-_1", "0123.", "0 -4", "+12 ().-9", "aé@b.c1+ 4-"):
        for _ in range(4000):
            t = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 45)))
            assert pii.base_spans(t) == brute_spans(t), t


def test_bootstrap_finds_unseen_identifiers(spark, docs, empty):
    rnd = random.Random(4)
    rows = [(i, f"please call us {'+1 (%03d) 555-%04d' % (rnd.randint(100, 999), i)} today") for i in range(30)]
    rows += [(100, "please call us 5550-1234 today"), (101, "room 2024 is free"), (102, None), (102, None)]
    found = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[100]["spans"] == "phone:15:24" and found[100]["base"] == "" and found[100]["n_phone"] == 0
    assert found[101]["spans"] == "" and found[102]["spans"] == ""
    assert all(found[i]["spans"] == found[i]["base"] != "" for i in range(30))
    assert pii.find(docs).count() == docs.count()
    assert pii.find(empty).count() == 0


def test_contexts_elsewhere_count_against_a_value(spark):
    rnd = random.Random(5)
    after = ("today", "now", "soon", "again", "first", "tomorrow", "anytime", "daily", "weekdays", "early")
    rows = [(i, f"please call us {'+1 (%03d) 555-%04d' % (rnd.randint(100, 999), i)} {after[i % 10]}") for i in range(60)]
    # A year once in the context of phones and elsewhere; a number mostly in it and elsewhere.
    rows += [(100, "please call us 2024 today"), (101, "room 2024 is free"), (102, "since 2024 they are here")]
    rows += [(110 + i, f"please call us 5550-1234 {w}") for i, w in enumerate(after)] + [(120, "part 5550-1234 is sold")]
    found = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i] for i in (100, 101, 102)] == [""] * 3
    assert [found[110 + i] for i in range(10)] == ["phone:15:24"] * 10
    assert found[120] == ""


def test_identity_is_the_whole_value():
    def value(token):
        return pii.mentions(f"see {token} here", [])[0]["value"]
    assert value("http://h.example/1234" + "a" * 80 + "b") != value("http://h.example/1234" + "a" * 80 + "c")
    assert value("٢٠٢٤") != value("٢٠٢٥") and value("a-1234") != value("a1234")
    assert value("٢٠٢٤") == value("２０２４") == value("2024") == value("(2024).")


# ---- all ------------------------------------------------------------------------

def test_empty_tables(spark, empty):
    assert ngram_join.jaccard_components(empty).count() == 0
    assert mixing.draws(empty, depth=1).count() == 0
    assert mixing.mixed_documents(empty, depth=1).count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0
    assert bpe.digests(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    path = scratch_path(spark, "store-empty")
    token_store.write_store(empty, path, public_tokenizers.path("word_bpe_49k.json"))
    assert token_store.read_documents(spark, path).count() == 0


def test_block_links_by_divide_skip(monkeypatch):
    """Links of a block equal a plain count, and are DivideSkip's: without its counts there are none."""
    rnd = random.Random(8)
    universe = rnd.sample(range(1, 1 << 56), 60)
    for _ in range(60):
        query = np.array(sorted(rnd.sample(universe, rnd.randint(1, 30))), dtype=np.uint64)
        members = [np.array(sorted(rnd.sample(universe, rnd.randint(1, 30))), dtype=np.uint64) for _ in range(rnd.randint(0, 12))]
        members += [np.array(sorted(set(query.tolist()) - {rnd.choice(query.tolist())} | {1}), dtype=np.uint64), query]
        want = [i for i, m in enumerate(members) if 100 * len(set(m.tolist()) & set(query.tolist())) >= 75 * len(set(m.tolist()) | set(query.tolist()))]
        assert sorted(ngram_join.block_links(query, members, 75)) == want
    monkeypatch.setattr(ngram_join, "divide_skip", lambda *a: {})
    assert ngram_join.block_links(query, members, 75) == []


def test_texts_reach_python_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    texts = spark.range(12).coalesce(1).select(F.col("id").alias("doc_id"), F.expr("repeat('ab cd ', 200000)").alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["bytes"])

    spark.conf.unset(name)
    try:
        assert {r["component_id"] for r in ngram_join.jaccard_components(texts).collect()} == {0}
        found = [r["bytes"] for r in texts.select("text").mapInArrow(sizes, "bytes long").collect()]
        assert len(found) > 1 and max(found) <= BATCH_BYTES + 1_300_000
        spark.conf.set(name, "1000000")
        small_batches(spark)
        assert spark.conf.get(name) == "1000000"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
