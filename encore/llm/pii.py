"""Personal data: base patterns plus bootstrapped contextual extraction.

The base finds e-mail addresses, IPv4 addresses, card numbers and phone numbers by pattern. They
are the seeds of the bootstrap. One pass writes, for each document, its base spans and its
*candidates*: tokens that look like an identifier (four digits or more, or an ``@``) and that no
base span covers; base spans and candidates both come with the words around them. The contexts
(two words before; word before and word after) are the lexical patterns of a graph with the distinct values as
instances; a value is its whole span in lower case with Unicode digits as ASCII ones, kept as a
128-bit hash. Each round scores a pattern by the trusted share of its distinct values; patterns
above ``min_score`` with at least ``min_seeds`` distinct trusted values are trusted. Each distinct
context of a value (its two patterns) has the belief 1 minus the product of the doubts of its
trusted patterns, 0 if it has none, and a value has the mean of its contexts' beliefs, so contexts
elsewhere count against it; from ``min_score`` it is trusted in the next round. At the end
candidates with a trusted value and a trusted pattern of their own are added as spans, with the kind
that most seeds of their value's best pattern have.

Defined results: null and empty texts have no spans. Rows are told apart by position, not by id, so
repeated rows and null ids each give their own row. Ties between kinds go to the earlier of email,
ip, card, phone. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("email", "ip", "card", "phone")
# The base patterns. A local part or a number that fails from its first character fails from
# any later one, so the look-behind (with the end of the last match) skips those starts; it keeps
# long runs linear and changes no match.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
DIGIT = re.compile(r"[0-9]")
TRIM = "\"'()[]{}<>,;:.!?|*#$%&="


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from the @ outwards."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_PART:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive."""
    found = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(int(p) <= 255 for p in m.group().split(".") if len(p.lstrip("0")) <= 3) \
                    and all(len(p.lstrip("0")) <= 3 for p in m.group().split(".")):
                found.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            if 12 <= m.end() - m.start():
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def joined(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _word(text: str, span: tuple[int, int]) -> str:
    """A context word: as it is up to 40 characters, longer ones by a hash of the whole word."""
    word = text[span[0]: span[1]].strip(TRIM).lower()
    return word if len(word) <= 40 else identity(word)


def identity(value: str) -> str:
    """Of the whole value, however long: equal only for equal values but for case and the script of digits."""
    value = value.lower()
    if not value.isascii():
        value = "".join(str(unicodedata.decimal(c, c)) for c in value)
    return blake2b(value.encode(), digest_size=16).hexdigest()


def mentions(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """Base spans and candidates with their value and context patterns. A text without a digit and
    without an @ has none."""
    if not spans and not DIGIT.search(text) and "@" not in text and (text.isascii() or not any(map(str.isdigit, text))):
        return []
    tokens = [m.span() for m in TOKEN.finditer(text)]
    found: list[tuple[int, int, int, int, str | None]] = []  # first token, last token, start, end, kind
    taken = [False] * len(tokens)
    t = 0
    for kind, start, end in spans:
        while t < len(tokens) and tokens[t][1] <= start:
            t += 1
        last = t
        while last + 1 < len(tokens) and tokens[last + 1][0] < end:
            last += 1
        for i in range(t, last + 1):
            taken[i] = True
        found.append((t, last, start, end, kind))
    for i, (s, e) in enumerate(tokens):
        if taken[i]:
            continue
        token = text[s:e]
        if "@" not in token and sum(map(str.isdigit, token)) < 4:
            continue
        lead = len(token) - len(token.lstrip(TRIM))
        core = token.strip(TRIM)
        if core:
            found.append((i, i, s + lead, s + lead + len(core), None))
    out = []
    for first, last, start, end, kind in found:
        w1 = _word(text, tokens[first - 1]) if first else "^"
        w2 = _word(text, tokens[first - 2]) if first > 1 else "^"
        r1 = _word(text, tokens[last + 1]) if last + 1 < len(tokens) else "$"
        out.append({"start": start, "end": end, "kind": kind, "value": identity(text[start:end]),
                    "patterns": [f"b {w2} {w1}", f"c {w1} _ {r1}"]})
    return out


MENTION = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("value", pa.string()),
                     ("patterns", pa.list_(pa.string()))])
SCAN_SCHEMA = ("uid long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, "
               "mentions array<struct<start: long, end: long, kind: string, value: string, patterns: array<string>>>")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One pass over the whole texts: base counts, base spans and mentions, in shared scratch."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, found, counts = [], [], {k: [] for k in KINDS}
            for value in batch.column(2):
                body = value.as_py() or ""
                spans = base_spans(body)
                for k in KINDS:
                    counts[k].append(sum(s[0] == k for s in spans))
                bases.append(joined(spans))
                found.append(mentions(body, spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(counts[k], pa.int64()) for k in KINDS],
                 pa.array(bases, pa.string()), pa.array(found, pa.list_(MENTION))],
                names=["uid", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "mentions"])

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, SCAN_SCHEMA), "pii-scan")


def bootstrap(scanned: DataFrame, rounds: int = 3, min_score: float = 0.8, min_seeds: int = 4) -> DataFrame:
    """(uid, start, end, kind) of the candidates that the pattern-instance graph makes trusted."""
    flat = scanned.select("uid", F.explode("mentions").alias("m")).select("uid", "m.*")
    # The graph holds each distinct value once under a pattern, however often it is repeated.
    edges = materialize(
        flat.select("value", "kind", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "pii-edges")
    # The distinct contexts of each value's candidates: all that speaks for or against it.
    contexts = materialize(flat.filter("kind is null").select("value", "patterns").distinct(), "pii-contexts")
    totals = contexts.groupBy("value").agg(F.count(F.lit(1)).alias("n_contexts"))
    seed_kind = [F.sum((F.col("trusted") & (F.col("kind") == k)).cast("int")).alias(f"n_{k}") for k in KINDS]
    scored = edges.withColumn("trusted", F.col("kind").isNotNull())
    best, least = F.max("score"), F.min("score")
    for _ in range(rounds):
        patterns = (scored.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("trusted").cast("int")).alias("seeds"), *seed_kind)
                    .filter(F.col("seeds") >= min_seeds)
                    # The share of trusted values, drawn down for small patterns.
                    .withColumn("score", F.col("seeds") / (F.col("n") + 1.0)).filter(F.col("score") >= min_score)
                    .withColumn("pattern_kind", F.reverse(F.array_sort(F.array(*[
                        F.struct(F.col(f"n_{k}").alias("n"), F.lit(-i).alias("rank"), F.lit(k).alias("kind"))
                        for i, k in enumerate(KINDS)])))[0]["kind"])
                    .select("pattern", "score", "pattern_kind"))
        # Contexts with a trusted pattern; a context has one or both of its two.
        backed = materialize(
            contexts.withColumn("pattern", F.explode("patterns")).join(patterns, "pattern").groupBy("value", "patterns")
            .agg(F.when(F.count(F.lit(1)) == 1, best).otherwise(best + least - best * least).alias("belief"),
                 F.max(F.struct("score", "pattern", "pattern_kind")).alias("top")), "pii-backed")
        instances = (backed.groupBy("value").agg(F.sum("belief").alias("belief"), F.max("top")["pattern_kind"].alias("new_kind"))
                     .join(totals, "value")
                     # Rounded, so that the order of the sum decides nothing.
                     .filter(F.round(F.col("belief") / F.col("n_contexts"), 9) >= min_score).select("value", "new_kind"))
        found = materialize(instances, "pii-instances")
        scored = (edges.join(found, "value", "left").withColumn("trusted", F.col("kind").isNotNull() | F.col("new_kind").isNotNull())
                  .select("pattern", "value", F.coalesce("kind", "new_kind").alias("kind"), "trusted"))
    trusted = backed.join(found, "value").select("value", "patterns", "new_kind")
    return flat.filter("kind is null").join(trusted, ["value", "patterns"]).select("uid", "start", "end", F.col("new_kind").alias("kind"))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Every row of ``docs``: doc_id, the base counts, ``base`` and ``spans`` (kind:start:end, joined)."""
    scanned = scan(docs, doc_id, text)
    extra = bootstrap(scanned, **options).groupBy("uid").agg(F.collect_list(F.struct("kind", "start", "end")).alias("extra"))
    rows = scanned.join(extra, "uid", "left")
    base = F.transform(F.filter("mentions", lambda m: m["kind"].isNotNull()),
                       lambda m: F.struct(m["start"].alias("start"), _rank(m["kind"]).alias("rank"), m["end"].alias("end"), m["kind"].alias("kind")))
    added = F.transform(F.coalesce("extra", F.array().cast("array<struct<kind: string, start: long, end: long>>")),
                        lambda m: F.struct(m["start"].alias("start"), _rank(m["kind"]).alias("rank"), m["end"].alias("end"), m["kind"].alias("kind")))
    spans = F.array_join(F.transform(F.array_sort(F.concat(base, added)), lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", spans.alias("spans"))


def _rank(kind):
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)

