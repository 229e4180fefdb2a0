"""BPE encoding and decoding by dynamic programming over prefixes.

The byte-pair encoding of a word's prefix ends in exactly one token. For each prefix the automaton
below names every vocabulary token that is a suffix of it; the one that is *compatible* with the
last token of the prefix before it is the last token of this prefix. Following the stored tokens
back from the end gives the ids that the merge procedure gives, without running it.

``t1, t2`` are compatible when merging ``t1 + t2`` from single bytes leaves the border between
them closed: walking up the right edge of ``t1``'s merge tree and the left edge of ``t2``'s in
order of merge rank, no merge across the border ever comes first.

Defined results: null and empty texts encode to no ids and decode to the empty text. Rows are
independent, so repeated rows, null ids and extra columns change nothing; the tokenizer's special
strings inside a text become their special id, as the tokenizers library does by default.
"""

from __future__ import annotations

import hashlib
import json
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GPT_CHUNK, free_memory, worker_model

NEVER = 1 << 60
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
#: Entries of each worker's caches of words (two generations) and of pairs; results don't depend on them.
CACHE_WORDS, CACHE_PAIRS, CACHED_LENGTH = 300_000, 600_000, 48


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies (printable Latin-1 bytes
    stand for themselves, the others follow from code point 256)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class SuffixAutomaton:
    """States are token prefixes; ``longest[s]`` is the longest token that is a suffix of state s's
    string and ``shorter[id]`` the next shorter token that is a suffix of token ``id``."""

    def __init__(self, tokens: list[bytes]):
        step: list[dict[int, int]] = [{}]
        token_at: list[int] = [-1]
        for token_id, token in enumerate(tokens):
            state = 0
            for byte in token:
                nxt = step[state].get(byte)
                if nxt is None:
                    nxt = len(step)
                    step[state][byte] = nxt
                    step.append({})
                    token_at.append(-1)
                state = nxt
            if token:
                token_at[state] = token_id
        link = [0] * len(step)
        longest = [-1] * len(step)
        shorter = [-1] * len(tokens)
        queue = [(s, 0, b) for b, s in step[0].items()]
        for state, parent, byte in queue:  # grows while read: breadth first
            back = link[parent]
            if parent:
                while back and byte not in step[back]:
                    back = link[back]
                link[state] = step[back].get(byte, 0)
            inherited = longest[link[state]]
            own = token_at[state]
            longest[state] = own if own >= 0 else inherited
            if own >= 0:
                shorter[own] = inherited
            queue.extend((s, state, b) for b, s in step[state].items())
        self.step, self.link, self.longest, self.shorter = step, link, longest, shorter


class PrefixBpe:
    """Exact byte-level BPE of a tokenizers JSON file (no dropout, no unknown token)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for name, i in vocab.items():
            if name not in self.special:
                self.token[i] = bytes(alphabet[c] for c in name)
        self.automaton = SuffixAutomaton(self.token)
        for name, i in self.special.items():
            self.token[i] = name.encode()
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(spec["model"]["merges"]):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.rank[left, right] = r
            made.setdefault(whole, (r, left, right))
        self.made = made
        #: Of the tokens that were asked for.
        self.right_edge: dict[int, list[tuple[int, int]]] = {}
        self.left_edge: dict[int, list[tuple[int, int]]] = {}
        self.split_special = (regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
                              if self.special else None)
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.pairs: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, bytes] = {}
        self.old_cache: dict[str, bytes] = {}

    @staticmethod
    def _edge(made: dict, token: int, side: int) -> list[tuple[int, int]]:
        """From the border byte up to the token: (node, rank of the merge that takes it up)."""
        edge, rank = [(token, NEVER)], NEVER
        while token in made:
            rank, token = made[token][0], made[token][side]
            edge.append((token, rank))
        return edge[::-1]

    def compatible(self, first: int, second: int) -> bool:
        known = self.pairs.get((first, second))
        if known is None:
            known = self._border_stays(first, second)
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            self.pairs[first, second] = known
        return known

    def _border_stays(self, first: int, second: int) -> bool:
        left, right, i, j = self.right_edge.get(first), self.left_edge.get(second), 0, 0
        if left is None:
            left = self.right_edge[first] = self._edge(self.made, first, 2)
        if right is None:
            right = self.left_edge[second] = self._edge(self.made, second, 1)
        while True:
            (a, a_rank), (b, b_rank) = left[i], right[j]
            across = self.rank.get((a, b), NEVER)
            # Of equal ranks the leftmost merge comes first.
            if across < a_rank and across <= b_rank and across < NEVER:
                return False
            if a_rank == NEVER and b_rank == NEVER:
                return True
            if a_rank <= b_rank:
                i += 1
            else:
                j += 1

    def word_ids(self, word: bytes) -> list[int]:
        """Ids of one pre-token: last token of each prefix, then back from the end."""
        step, link, longest, shorter = self.automaton.step, self.automaton.link, self.automaton.longest, self.automaton.shorter
        token, compatible = self.token, self.compatible
        last = [-1] * (len(word) + 1)
        state = 0
        for end, byte in enumerate(word, 1):
            nxt = step[state].get(byte)
            while nxt is None and state:
                state = link[state]
                nxt = step[state].get(byte)
            state = nxt or 0
            match = longest[state]
            while match >= 0:
                start = end - len(token[match])
                if start == 0 or compatible(last[start], match):
                    last[end] = match
                    break
                match = shorter[match]
        ids, end = [], len(word)
        while end:
            ids.append(last[end])
            end -= len(token[last[end]])
        return ids[::-1]

    def _chunk(self, chunk: str) -> bytes:
        packed = self.old_cache.get(chunk)
        if packed is None:
            ids: list[int] = []
            for word in self.words.findall(chunk):
                ids.extend(self.word_ids(word.encode("utf-8")))
            packed = array("I", ids).tobytes() if LITTLE else np.asarray(ids, dtype="<u4").tobytes()
        if len(chunk) <= CACHED_LENGTH:
            if len(self.cache) >= CACHE_WORDS:
                self.old_cache, self.cache = self.cache, {}
            self.cache[chunk] = packed
        return packed

    def _plain(self, text: str) -> bytes:
        # Pre-tokens never cross the border between two chunks, so chunks can be looked up whole.
        cache, slow = self.cache, self._chunk
        return b"".join([cache.get(c) or slow(c) for c in GPT_CHUNK.findall(text)])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.split_special or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(np.asarray([self.special[p]], dtype="<u4").tobytes() if p in self.special else self._plain(p)
                        for p in self.split_special.split(text) if p)

    def decode(self, ids: bytes) -> str:
        token = self.token
        return b"".join([token[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", errors="replace")


def load(path: str) -> PrefixBpe:
    """The model in this worker."""
    return worker_model.get(("bpe", path), lambda: PrefixBpe(path))


def encode(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``docs`` with a column ``ids`` (binary, little-endian unsigned 32-bit)."""
    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load(tokenizer)
        for texts in batches:
            yield pd.Series([model.encode(t) for t in texts], dtype=object)
    return docs.withColumn("ids", ids(F.col(text)))


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded`` (the text its ids stand for)."""
    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load(tokenizer)
        for column in batches:
            yield pd.Series([model.decode(b or b"") for b in column], dtype=object)
    return encoded.withColumn("decoded", text(F.col(ids)))


def digests(docs: DataFrame, tokenizer: str, with_ids: bool = False, keep_model: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, ``with_ids`` also the ids.

    One pass, no shuffle: encodes and decodes inside one Arrow map, so texts don't go back to the JVM.
    A worker keeps the model for its next task (``keep_model``), or frees its memory for other operators.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(tokenizer)
        for batch in batches:
            n, ids_sha, text_sha, all_ids = [], [], [], []
            for value in batch.column(1):
                ids = model.encode(value.as_py())
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(model.decode(ids).encode("utf-8")).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if not keep_model:
            del model
            free_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
