"""The corpus pipeline: documents that are toxic, exact copies or near copies go; the rest is mixed by
source and encoded.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last return the
columns of ``documents``. Rows with null ids or texts pass: a null text is scored, compared and
mixed as an empty one (texts without words stay once in the mix), a null id is never a near copy. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from encore.llm.common import fold, materialize, quoted, table, unused

REJECT_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of rejection; the model learns as in query op6."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(table(spark, sf_dir, "documents"), labels.filter(fold(F.col("doc_id"), 4) != 2))
    score = unused(docs, "__llm_score")
    return toxicity.with_score(docs, model, score=score).filter(F.col(score) < REJECT_FROM).select(*map(quoted, docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (Jaccard 0.75 of five-word shingles), the document with the least id."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (up to three times), in shard order."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every row."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True, keep_model=False)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_jaccard_join", drop_near_copies),
          ("mixing", mix_sources), ("bpe", encode)]

# A learned score, hashed draws and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
