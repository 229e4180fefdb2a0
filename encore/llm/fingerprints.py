"""Document fingerprints by consistent weighted sampling, with DataFrame functions only.

A document is a weighted set: its words (lower case, as they stand between white space), each with
the number of times it occurs as weight. For each of ``samples`` positions k and each term, three
hashes of (term, k) give r ~ Gamma(2, 1), c ~ Gamma(2, 1) and beta ~ U(0, 1); with weight w the
sample is t = floor(ln w / r + beta), ln y = r (t - beta), ln a = ln c - ln y - r, and position k of
the signature is the (term, t) with the least ln a. Two documents agree at a position with
probability equal to the generalised Jaccard similarity, the sum of the lesser weights over the sum
of the greater ones. The least ln a identifies its (term, t); the fingerprint holds 24 bits of its
hash, six hex digits for each position. The share of equal positions estimates that similarity s with a
standard error of sqrt(s (1 - s) / 32) for the 32 positions: 0.09 at 0.60, 0.08 at 0.75.

``edited_neighbours`` builds a document's edited text: its last floor(n_chars / 4) code points
replaced by the first as many of the next document in ascending id order (after the last, the first).

Defined results: null and empty texts, and texts of white space, have no terms; their items are all
``ffffff``, so two such are alike (1) and one such and a text with words are not (0). Rows that
repeat an id are ordered by their text, null ids come first; the only row of a table is its own
neighbour. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, parallelism, quoted

#: Positions of a signature: GROUPS rows of GROUP_SAMPLES, so that generated methods stay small enough to be compiled.
GROUPS, GROUP_SAMPLES = 8, 4
EMPTY_ITEM = "ffffff"
BUCKETS_PER_PARTITION = 4


# ---- the next document ----------------------------------------------------------

def _at_or_below(cuts: Column, value: Column, n: int) -> Column:
    """How many of the ``cuts`` (ascending, at most ``n``) are at or below ``value``, by binary search; 0 for null."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.coalesce(F.get(cuts, low + step - 1) <= value, F.lit(False)), low + step).otherwise(low))


def bucketed(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` with a column ``bucket``: about ``count`` buckets of neighbouring ids, of about equal size.

    Cuts are quantiles in two levels, each of about the root of ``count``: the first in the plan, the
    second, one row for each of the first, joined as data. So the plan stays small however many buckets there are."""
    side = max(1, math.isqrt(max(0, count - 1)) + 1)
    points = [i / side for i in range(1, side)] or [0.5]
    quantiles = lambda: F.array_sort(F.percentile_approx("doc_id", points, max(10_000, 50 * side)))
    first = sorted(set(rows.agg(quantiles().alias("c")).first()["c"] or []))
    upper = _at_or_below(F.array(*map(F.lit, first)).cast("array<bigint>"), F.col("doc_id"), len(first))
    placed = rows.withColumn("upper", upper)
    # one row of about ``side`` numbers for each of about ``side`` values
    inner = materialize(placed.groupBy("upper").agg(quantiles().alias("cuts")), "fingerprint-cuts")
    known = placed.join(F.broadcast(inner), "upper")
    lower = _at_or_below(F.coalesce(F.col("cuts"), F.array().cast("array<bigint>")), F.col("doc_id"), len(points))
    return known.withColumn("bucket", F.col("upper") * (side + 1) + lower).drop("upper", "cuts")


def edited_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, row, guest, doc_id, body, edited): every row, null texts as empty, with its edited text.

    Rows are dealt to buckets of neighbouring ids (quantiles). The least rows of each bucket also
    go, as guests, to the bucket before it, those of the first bucket to the last, so each next
    document is found inside a bucket and texts are shuffled once. Guests (``guest`` = 1) follow
    their bucket's own rows and have no edited text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("body"))
    placed = bucketed(rows, parallelism(spark) * BUCKETS_PER_PARTITION)
    # One row per bucket: its least id, and the bucket before it (of the first, the last).
    in_order = Window.orderBy("bucket")
    least = placed.groupBy("bucket").agg(F.max(F.col("doc_id").isNull()).alias("has_null"), F.min("doc_id").alias("min_id"))
    least = materialize(least.select("bucket", F.when(~F.col("has_null"), F.col("min_id")).alias("least"),
                                     F.coalesce(F.lag("bucket").over(in_order), F.max("bucket").over(Window.partitionBy())).alias("before")), "fingerprint-buckets")
    known = placed.join(F.broadcast(least), "bucket")
    is_first = F.col("doc_id").eqNullSafe(F.col("least"))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("before").alias("bucket"), F.lit(1).alias("guest"))
    dealt = (known.withColumn("place", F.explode(F.when(is_first, F.array(own, guest)).otherwise(F.array(own))))
             .select("place.bucket", "place.guest", "doc_id", "body"))
    inside = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "body")
    n = F.char_length("body")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("body"), F.lit(1), n - quarter), F.substring(F.col("next"), F.lit(1), quarter))
    return (dealt.withColumns({"next": F.lead("body").over(inside), "row": F.row_number().over(inside)})
            .select("bucket", "row", "guest", "doc_id", "body", F.when(F.col("guest") == 0, edited).alias("edited")))


# ---- consistent weighted sampling -----------------------------------------------

def _unit(bits: Column, shift: int, width: int) -> Column:
    """A uniform number inside (0, 1) from ``width`` bits."""
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(0.5)) / float(1 << width)


def log_a(term: Column, group: Column, position: int, log_weight: Column) -> Column:
    """ln a of a term at one position of a group, with the given ln w."""
    first, second = (F.xxhash64(term, group, F.lit(2 * position + i)) for i in range(2))
    r = -F.ln(_unit(first, 0, 21) * _unit(first, 21, 21))
    log_c = F.ln(-F.ln(_unit(second, 0, 21) * _unit(second, 21, 21)))
    beta = (F.shiftrightunsigned(first, 42) * float(1 << 22) + F.shiftrightunsigned(second, 42) + F.lit(0.5)) / float(1 << 44)
    return log_c - r * (F.floor(log_weight / r + beta) - beta + F.lit(1.0))


def _words(body: Column, side: int) -> Column:
    """Hashes of a text's words, repeats included, with the side in the lowest bit."""
    trimmed = F.btrim(F.lower(F.coalesce(body, F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    empty = F.array().cast("array<bigint>")
    hashes = F.transform(F.split(trimmed, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2)).bitwiseOR(F.lit(side)))
    return F.when(trimmed == "", empty).otherwise(hashes)


def term_weights(texts: DataFrame, bodies: tuple[str, str]) -> DataFrame:
    """``texts`` with a row for each distinct word of the two columns ``bodies``: term (a hash), and the
    times w0 and w1 that it occurs in either.

    Words are hashed, sorted and run-length counted inside the row: no shuffle, and no state beyond one
    document. A row without words keeps one row with null term."""
    keep = [c for c in texts.columns if c not in bodies]
    h, v, s = F.col("h"), F.col("v"), F.col("s")
    hashed = texts.select(*keep, F.sort_array(F.concat(*[_words(F.col(b), i) for i, b in enumerate(bodies)])).alias("h"))
    # Where a run of equal hashes begins; then each run's hash. A term's runs of both sides are neighbours.
    runs = hashed.select(*keep, "h", F.when(F.size("h") > 0, F.filter(
        F.sequence(F.lit(0), F.size("h") - 1), lambda i: (i == 0) | (F.get(h, i) != F.get(h, i - 1)))).alias("s"))
    valued = runs.select(*keep, F.concat("s", F.array(F.size("h"))).alias("s"), F.transform("s", lambda i: F.get(h, i)).alias("v"))
    n = F.size("v")

    def entry(i: Column) -> Column:
        value, count = F.get(v, i), F.get(s, i + 1) - F.get(s, i)
        odd = value.bitwiseAND(F.lit(1)) == 1
        paired = ~odd & F.coalesce(F.get(v, i + 1) == value + 1, F.lit(False))
        return F.struct(F.shiftright(value, 1).alias("term"), F.when(odd, 0).otherwise(count).alias("w0"),
                        F.when(odd, count).when(paired, F.get(s, i + 2) - F.get(s, i + 1)).otherwise(0).alias("w1"))

    leading = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(v, i).bitwiseAND(F.lit(1)) == 0)
                       | (F.get(v, i) - 1 != F.get(v, i - 1)))
    return valued.select(*keep, F.inline_outer(F.transform(F.when(n > 0, leading), entry)))


def signatures(texts: DataFrame, bodies: tuple[str, str], groups: int = GROUPS) -> DataFrame:
    """``texts`` without ``bodies``, and their signatures ``items0`` and ``items1``: arrays of hex strings.

    ``texts`` must be told apart by its other columns; if it is partitioned by some of them, nothing
    is shuffled. A term's random numbers are made once for both texts."""
    key = [c for c in texts.columns if c not in bodies]
    sampled = (term_weights(texts, bodies)
               .select(*key, "term", F.ln("w0").alias("lw0"), F.ln("w1").alias("lw1"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
               .groupBy(*key, "g").agg(*[F.min(log_a(F.col("term"), F.col("g"), j, F.col(f"lw{i}"))).alias(f"a{i}_{j}")
                                         for j in range(GROUP_SAMPLES) for i in (0, 1)]))

    def item(a: Column) -> Column:
        return F.when(a.isNull(), F.lit(EMPTY_ITEM)).otherwise(F.lower(F.lpad(F.hex(F.pmod(F.xxhash64(a), F.lit((1 << 24) - 1))), 6, "0")))

    items = F.struct("g", *[F.array(*[item(F.col(f"a{i}_{j}")) for j in range(GROUP_SAMPLES)]).alias(f"items{i}") for i in (0, 1)])
    return (sampled.groupBy(*key).agg(F.array_sort(F.collect_list(items)).alias("parts"))
            .select(*key, *[F.flatten(F.transform("parts", lambda p: p["items0"])).alias("items0"),
                            F.flatten(F.transform("parts", lambda p: p["items1"])).alias("items1")]))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal positions of two signatures."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.size(a).cast("double")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    pairs = edited_neighbours(docs, doc_id, text)
    signed = signatures(pairs.withColumns({"n_chars": F.char_length("body").cast("long"),
                                           "sha": F.unhex(F.sha2(F.coalesce("edited", F.lit("")), 256))}), ("body", "edited"))
    inside = Window.partitionBy("bucket").orderBy("row")
    own, changed = F.col("items0"), F.col("items1")
    return (signed.withColumn("following", F.lead("items0").over(inside)).filter("guest = 0")
            .select("doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), F.concat_ws("", own).alias("fingerprint"),
                    F.concat_ws("", changed).alias("edited_fingerprint"), likeness(own, changed).alias("near_edited"),
                    likeness(own, F.col("following")).alias("near_next")))
