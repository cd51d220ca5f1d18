"""A corpus pipeline in four stages. Each takes (spark, docs, sf_dir) and returns the next stage's documents.

1. language: fits the language model on the documents it gets, and drops those in none of the learned languages: null
   texts, texts without a letter, and texts that are more random trigrams than language in the inferred mixture.
2. near_duplicates: keeps one document, that with the smallest id, of each group of near copies: texts with four fifths
   of their distinct five-word shingles in common. SimHash's byte-position index gives the first candidates, an index on
   shingles those that no number of bits guarantees, and the shingles decide all of them (shingles.near_copies).
3. mixture: brings the sources to their target weights; a document comes as often as the mix takes it.
4. tokens: encodes every row and returns its token count and digests.

Every stage's result is written as Parquet to the shared folder and read again as the next one's documents; what a stage
wrote on the way, and the documents before it, are removed then.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from seekframe.llm import bpe, language_id, mixing, shingles, simhash
from seekframe.llm.common import release, scratch, settle, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, find=shingles.near_copies)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("mixture", mixture), ("tokens", tokens)]

#: SQL can express neither the mixture inference, nor shingles over XXH64, nor BPE; tests/llm hold run() against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch() as mine:
            docs, path = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, [*mine, *last], path)
        last = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
