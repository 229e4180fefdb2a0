"""Toxicity scores: a learned lexicon, misspellings by Levenshtein automata, context windows.

Learning (bounded sample of labelled rows, ``max_rows``): Spark counts, over the distinct texts of
the sample, in how many toxic and other documents each word and each word beginning occurs; terms
whose association with the label is beyond chance (log-likelihood ratio) form the lexicon, a trie
of whole words and of stems. Scoring: every distinct word of a text is looked up by intersecting
its Levenshtein automaton with the trie (states are rows of the edit-distance table; a branch ends
when its row exceeds the allowed distance); two neighbouring letters that change places are one
edit. Tokens between white space that hold digits or symbols among letters are also looked up whole,
if none of their words is a hit: words of the lexicon by the automaton, stems with the odd character
in place of a letter or between two. Terms have four letters or more; one of four is found
misspelled only by a digit or one of ``$@*``, a stem only by characters that are no letters. Each hit is then read in a window of its text, which
separates quotation (inside quotation marks, or near a reporting word) from abuse. A logistic
model over the summed evidence, fitted on the same sample, gives the score.

Defined results: null and empty texts score the same as any text without a hit. Rows are scored
alone, so repeated rows score alike and null ids and extra columns change nothing. An empty table
gives an empty result; without labelled rows of both kinds, every score is the prior (0 without
any label).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_memory, labelled_sample, materialize, small_batches

WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"\S+")
SIGNS = "$@*"  # stand for letters at the ends of a token too
# Words that mark a quotation or report near a term.
REPORTING = frozenset("""called calls cited cite quote quoted quotes said says word words term insult
zitat sagte nannte wort cita dijo palabra dit mot citation""".split())
OPENING, CLOSING = "\"'«“„‘(", "\"'»”“’)"
WINDOW = 48
STEM_LENGTHS = (4, 5, 6)
CACHE = 300_000


@dataclass
class Lexicon:
    """Weights of whole words and of stems (word beginnings), and the trie over the words."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.trie: dict = {}
        for word, weight in self.words.items():
            node = self.trie
            for c in word:
                node = node.setdefault(c, {})
            node[""] = (word, weight)
        # A term with one edit keeps its first or its second half: a cheap necessary test.
        self.heads = {w[: len(w) // 2] for w in self.words if len(w) >= 5}
        self.tails = {w[len(w) // 2:] for w in self.words if len(w) >= 5}
        self.head_sizes = sorted({len(h) for h in self.heads})
        self.tail_sizes = sorted({len(t) for t in self.tails})
        # A swap across the middle keeps neither half, but gives this beginning.
        self.crossed = {w[: len(w) // 2 - 1] + w[len(w) // 2] for w in self.words if len(w) >= 5}
        self.longest = max(map(len, self.words), default=0)
        # Stems without one letter, by what stands before and after it.
        self.gapped: dict[tuple[str, str], float] = {}
        for stem, weight in self.stems.items():
            for i in range(len(stem)):
                key = stem[:i], stem[i + 1:]
                self.gapped[key] = max(weight, self.gapped.get(key, weight))

    def lookup(self, word: str, swaps: bool = False) -> tuple[float, bool] | None:
        """(weight, exact) of the best lexicon match of a lower-case word."""
        if word in self.words:
            return self.words[word], True
        stem = max((self.stems[word[:n]] for n in STEM_LENGTHS if word[:n] in self.stems), default=None)
        if stem is not None:
            return stem, True
        if not 5 <= len(word) <= self.longest + 1:
            return None
        if not (any(word[:n] in self.heads for n in self.head_sizes) or any(word[-n:] in self.tails for n in self.tail_sizes)
                or swaps and any(word[:n] in self.crossed for n in self.head_sizes)):
            return None
        best = levenshtein_search(self.trie, word, 1, swaps)
        return (best, False) if best is not None else None

    def lookup_token(self, token: str) -> tuple[float, bool] | None:
        """(weight, False) of the best match of a lower-case token with digits or symbols among its
        letters; None if a word of it is a hit of its own."""
        first, last = 0, len(token)
        while first < last and not (token[first].isalnum() or token[first] in SIGNS):
            first += 1
        while last > first and not (token[last - 1].isalnum() or token[last - 1] in SIGNS):
            last -= 1
        core = token[first:last]
        words = WORD.findall(core)
        if not words or words == [core] or any(self.lookup(w, True) for w in words):
            return None
        found = []
        for form in {core, core.strip(SIGNS)}:
            odd = [i for i, c in enumerate(form[: max(STEM_LENGTHS)]) if not c.isalpha()]
            least = 4 if any(c.isdigit() or c in SIGNS for c in form) else 5
            if least <= len(form) <= self.longest + 1:
                found.append(levenshtein_search(self.trie, form, 1, True, least))
            for n in STEM_LENGTHS if len(odd) else ():
                at = odd[0]
                if at < n:
                    found.append(self.gapped.get((form[:at], form[at + 1: n])) if n <= len(form) else None)
                    found.append(self.stems.get(form[:at] + form[at + 1: n + 1]))
        best = max((w for w in found if w is not None), default=None)
        return (best, False) if best is not None else None


def levenshtein_search(trie: dict, word: str, distance: int, swaps: bool = False, least: int = 5) -> float | None:
    """Greatest weight of a term of ``least`` letters or more within ``distance`` edits of ``word``; with
    ``swaps``, two neighbours that change places are one edit."""
    best = None
    stack = [(trie, list(range(len(word) + 1)), None, "")]
    while stack:
        node, row, above, over = stack.pop()
        if "" in node and row[-1] <= distance and len(node[""][0]) >= least:
            best = node[""][1] if best is None else max(best, node[""][1])
        for letter, child in node.items():
            if not letter:
                continue
            step = [row[0] + 1]
            for i, c in enumerate(word, 1):
                step.append(min(step[-1] + 1, row[i] + 1, row[i - 1] + (c != letter)))
                if swaps and above is not None and i > 1 and c == over and word[i - 2] == letter:
                    step[-1] = min(step[-1], above[i - 2] + 1)
            if min(step) <= distance:
                stack.append((child, step, row, letter))
    return best


def is_quoted(text: str, start: int, end: int) -> bool:
    """Whether the term at start:end stands in a quotation: its window opens a quotation mark that
    stays open up to the term and is closed after it, or holds a reporting word."""
    before, after = text[max(0, start - WINDOW): start], text[end: end + WINDOW]
    for opening, closing in zip(OPENING, CLOSING):
        if opening == closing:
            if before.count(opening) % 2 and closing in after:
                return True
        elif before.rfind(opening) > before.rfind(closing) and closing in after:
            return True
    return not REPORTING.isdisjoint(w.lower() for w in WORD.findall(before) + WORD.findall(after))


N_FEATURES = 6


class Evidence:
    """Per-text evidence vectors, with a bounded cache of word look-ups."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.cache, self.tokens = lexicon, {}, {}

    def __call__(self, text: str | None) -> list[float]:
        if not text:
            return [0.0] * N_FEATURES
        lower = text.lower()
        words = WORD.findall(lower)
        cache, hits = self.cache, {}
        for word in set(words):
            found = cache.get(word, 0)
            if found == 0:
                found = self.lexicon.lookup(word, True)
                if len(cache) >= CACHE:
                    cache.clear()
                cache[word] = found
            if found is not None:
                hits[word] = found
        tokens, spelled = self.tokens, {}
        for token in set(lower.split()):
            if token.isalpha():
                continue
            found = tokens.get(token, 0)
            if found == 0:
                found = self.lexicon.lookup_token(token)
                if len(tokens) >= CACHE:
                    tokens.clear()
                tokens[token] = found
            if found is not None:
                spelled[token] = found[0]
        if not hits and not spelled:
            return [0.0] * N_FEATURES
        abuse = quoted = fuzzy = most = 0.0
        for m in WORD.finditer(lower):
            if (found := hits.get(m.group())) is None:
                continue
            weight, exact = found
            if is_quoted(lower, m.start(), m.end()):
                quoted += weight
            elif exact:
                abuse += weight
                most = max(most, weight)
            else:
                fuzzy += weight
        for m in TOKEN.finditer(lower) if spelled else ():
            if (weight := spelled.get(m.group())) is None:
                continue
            if is_quoted(lower, m.start(), m.end()):
                quoted += weight
            else:
                fuzzy += weight
        return [math.log1p(abuse), math.log1p(quoted), math.log1p(fuzzy), most, float(abuse > 0),
                100 * (abuse + quoted + fuzzy) / (100 + len(words))]


def _terms(text: str | None) -> set[str]:
    """Words of four letters or more, and with a star the beginnings of longer ones."""
    words = {w for w in WORD.findall((text or "").lower()) if len(w) >= 4}
    return words | {w[:n] + "*" for n in STEM_LENGTHS for w in words if len(w) > n}


def learn_lexicon(sample: DataFrame, min_gain: float = 18.0, min_odds: float = 2.0, max_terms: int = 2000,
                  redundancy: int = 3) -> Lexicon:
    """Lexicon of ``sample`` (text, label).

    Candidates: the ``max_terms`` terms with the strongest association beyond chance (log-likelihood
    ratio at least ``min_gain``, log odds ratio at least ``min_odds``). Of these, strongest first, a
    term stays if it marks three or more toxic texts that fewer than ``redundancy`` terms mark so
    far: words that only ride along in copies of a toxic text add nothing and go."""
    texts = sample.groupBy("text").agg(F.max("label").alias("label"))
    totals = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return Lexicon()

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free_memory()
        for batch in batches:
            found: dict[str, list[int]] = {}
            for text, label in zip(batch["text"], batch["label"], strict=True):
                for term in _terms(text):
                    found.setdefault(term, [0, 0])[label == 1] += 1
            yield pd.DataFrame({"term": list(found), "p": [v[1] for v in found.values()], "q": [v[0] for v in found.values()]})

    terms = (texts.mapInPandas(count, "term string, p long, q long")
             .groupBy("term").agg(F.sum("p").cast("double").alias("p"), F.sum("q").cast("double").alias("q")))
    base = n1 / (n1 + n0)
    share = F.col("p") / (F.col("p") + F.col("q"))
    gain = 2 * (F.col("p") * F.log(share / base)
                + F.when(F.col("q") > 0, F.col("q") * F.log((1 - share) / (1 - base))).otherwise(0.0))
    odds = F.log((F.col("p") + 0.5) / (n1 + 1.0)) - F.log((F.col("q") + 0.5) / (n0 + 1.0))
    chosen = (terms.filter(F.col("p") >= 3).withColumns({"gain": gain, "odds": odds})
              .filter((F.col("gain") >= min_gain) & (F.col("odds") >= min_odds))
              .orderBy(F.desc("gain"), "term").limit(max_terms).collect())
    odds_of = {r["term"]: r["odds"] for r in chosen}
    # A stem must reach beyond the words it is seen through.
    known = [t for t in odds_of if not t.endswith("*") or odds_of[t] > 0.1 + max(
        (o for w, o in odds_of.items() if not w.endswith("*") and w.startswith(t[:-1])), default=-math.inf)]
    place = {t: i for i, t in enumerate(known)}

    def mark(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"marks": [sorted(place[t] for t in _terms(text) if t in place) for text in batch["text"]]})

    marked = [r["marks"] for r in texts.filter("label = 1").mapInPandas(mark, "marks array<int>").collect()]
    where: dict[int, list[int]] = {}
    for i, marks in enumerate(marked):
        for k in marks:
            where.setdefault(k, []).append(i)
    covered, words, stems = [0] * len(marked), {}, {}
    for k, term in enumerate(known):
        if sum(covered[i] < redundancy for i in where.get(k, ())) < 3:
            continue
        for i in where[k]:
            covered[i] += 1
        (stems if term.endswith("*") else words)[term.rstrip("*")] = odds_of[term]
    return Lexicon({w: o for w, o in words.items() if not any(w[:n] in stems for n in STEM_LENGTHS)}, stems)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 60) -> np.ndarray:
    """Coefficients (intercept last) of a ridge logistic regression by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    penalty = np.full(x.shape[1], ridge * 1.0)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-8 * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-7:
            break
    return w


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        z = np.c_[evidence, np.ones(len(evidence))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = 20_000) -> ToxicityModel:
    """Lexicon and weights from at most ``max_rows`` labelled rows (the caller's training rows)."""
    small_batches(docs.sparkSession)
    sample = materialize(labelled_sample(docs, labels, label, max_rows).select("text", "label"), "toxicity-sample")
    lexicon = learn_lexicon(sample)

    def evidence(batches: Iterable) -> Iterator:
        read = Evidence(lexicon)
        for batch in batches:
            out = batch[["label"]].copy()
            for i, column in enumerate(zip(*[read(t) for t in batch["text"]], strict=True)):
                out[f"e{i}"] = column
            yield out if len(batch) else out.reindex(columns=["label", *[f"e{i}" for i in range(N_FEATURES)]])

    schema = "label int, " + ", ".join(f"e{i} double" for i in range(N_FEATURES))
    rows = sample.mapInPandas(evidence, schema).toPandas().sort_values(["label", *[f"e{i}" for i in range(N_FEATURES)]])
    y = rows["label"].to_numpy(dtype=float)
    if not len(y):
        return ToxicityModel(lexicon, np.r_[np.zeros(N_FEATURES), -30.0])
    return ToxicityModel(lexicon, fit_logistic(rows[[f"e{i}" for i in range(N_FEATURES)]].to_numpy(dtype=float), y))


def with_score(docs: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1). One pass over the texts, no shuffle; the model
    (at most ``max_terms`` terms) is the only thing sent to the executors."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        free_memory()
        own = shared.value
        read = Evidence(own.lexicon)
        for texts in batches:
            yield pd.Series(own.scores(np.asarray([read(t) for t in texts], dtype=float).reshape(-1, N_FEATURES)), dtype="float64")

    return docs.withColumn(score, score_of(F.col(text).cast("string")))
