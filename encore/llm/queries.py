"""Registered queries of the operators of this package, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (bpe, conversation_repair, exact_dedup, fingerprints, langid, mixing, ngram_join, pii, quality, suffix_dedup, token_store,
               toxicity, whitening)
from .common import fold, table

THRESHOLD = 0.3

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


@register("op3_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op4_token_output")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "token-store")
    token_store.write_store(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_store.read_documents(spark, path)


@register("op5_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def _with_fold(docs: DataFrame, folds: int, held: int) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold(F.col("doc_id"), folds) == held).alias("held_out"))


def _scored(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "held_out", "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


@register("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(fold(F.col("doc_id"), 4) != 2))
    return _scored(toxicity.with_score(_with_fold(docs, 4, 2), model))


@register("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.filter(fold(F.col("doc_id"), 5) != 0))
    return _scored(quality.with_score(_with_fold(docs, 5, 0), model))


@register("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(fold(F.col("doc_id"), 3) != 1))
    predicted = langid.predict(_with_fold(docs, 3, 1), model)
    return predicted.select("doc_id", "held_out", "language.lang_pred", "language.score")


@register("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@register("op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.draws(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", mixing.taken(mix).alias("taken"), "source", "draws")


@register("op8_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@register("op1_ngram_join", r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
    FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id, s.n
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@register("op12_suffix_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@register("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


# Each conversation's states walk over its rows at once; a state is its cost in nine digits, then its audit, so
# that the least text is the cheapest and then the ASCII-least.
def _plus(state: str, cost: str, edit: str) -> str:
    return f"printf('%09d', CAST({state}[1:9] AS INT) + {cost}) || {state}[10:] || '{edit}'"


def _repair_sql() -> str:
    none = "'~'"
    after = {c: [f"CASE WHEN w.{c} < '~' THEN {_plus(f'w.{c}', '2', 'D')} ELSE '~' END"] for c in "nsua"}
    for c, out, kept in (("n", "u", "u"), ("n", "s", "s"), ("s", "u", "u"), ("a", "u", "u"), ("u", "a", "a")):
        after[out].append(f"CASE WHEN w.{c} < '~' AND NOT r.gone AND r.initial = '{kept}' THEN {_plus(f'w.{c}', 'r.more', 'K')} ELSE '~' END")
        if out != "s":
            after[out].append(f"CASE WHEN w.{c} < '~' AND NOT r.gone THEN {_plus(f'w.{c}', '1 + r.more', 'R')} ELSE '~' END")
    insert = lambda c: f"CASE WHEN {c} < '~' THEN {_plus(c, '5', 'I')} ELSE '~' END"
    steps = ", ".join(f"least({', '.join(after[c])}) AS {c}0" for c in "nsua")
    u1 = f"least(u0, {insert('n0')}, {insert('s0')}, {insert('a0')})"
    a1 = f"least(a0, {insert('u1')})"
    u2 = f"least(u1, {insert('a1')})"
    return rf"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS key
    FROM conversations
), crc AS (
    SELECT *, list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, octet_length(key) + 1), lambda i: ('0x' || hex(key)[2 * i - 1 : 2 * i])::UBIGINT)),
        lambda c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda x: x::UBIGINT)),
                              lambda v, x: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)) AS c
    FROM keyed
), fates AS (
    SELECT *, xor(c, 4294967295::UBIGINT) % 20 AS fate FROM crc
), rows AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
           CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM fates, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS t(copy) WHERE fate <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM rows
), seen AS (
    SELECT *, role[1:1] AS initial, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS stop,
           i > min(i) OVER (PARTITION BY conv_id, role, text) AS again,
           lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair
    FROM placed
), faults AS (
    SELECT *, CASE WHEN stop = '' THEN 'b' WHEN again THEN 'd' WHEN stop NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM seen
), coded AS (
    SELECT *, fault IN ('b', 'd') AS gone, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS more FROM faults
), walk AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000000' AS n, {none} AS s, '000000005I' AS u, '000000010II' AS a FROM conversations
    UNION ALL
    SELECT conv_id, i, n0, s0, {u2}, a1 FROM (
        SELECT *, {a1} AS a1 FROM (
            SELECT *, {u1} AS u1 FROM (
                SELECT r.conv_id, r.i, {steps}
                FROM walk w JOIN coded r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1)))
), ends AS (
    SELECT conv_id, arg_max(least(n, a), i) AS best FROM walk GROUP BY conv_id
), audits AS (
    SELECT conv_id, CAST(best[1:9] AS BIGINT) AS cost, best[10:] AS audit FROM ends
), edits AS (
    SELECT conv_id, p, audit[p : p] AS edit, length(replace(audit[1 : p], 'I', '')) AS i,
           length(replace(audit[1 : p], 'D', '')) AS place
    FROM audits, unnest(range(1, length(audit) + 1)) AS t(p)
), outs AS (
    SELECT e.*, c.role, c.text, e.place - CAST(max(CASE WHEN e.place = 1 AND e.edit = 'K' AND c.initial = 's' THEN 1 ELSE 0 END)
               OVER (PARTITION BY e.conv_id) AS BIGINT) AS turn_of
    FROM edits e LEFT JOIN coded c ON c.conv_id IS NOT DISTINCT FROM e.conv_id AND c.i = e.i AND e.edit <> 'I'
    WHERE e.edit <> 'D'
), repaired AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN turn_of % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
                               chr(10) ORDER BY p) AS text
    FROM outs GROUP BY conv_id
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
           count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
           count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM coded GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(r.text, '')) AS repaired_sha256
FROM audits a LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
"""


@register("op13_conversation_repair", _repair_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))
