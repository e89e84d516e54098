"""From raw documents to token ids: five stages, each on all that the one
before it kept.

1. quality: line-first cleaning; documents that fail the rules go.
2. neardup: one document of each near-duplicate group stays (five-word
   shingles, similarity 0.8 or more).
3. pii: personal data is replaced by its kind in the texts.
4. mix: sources are brought to their target weights; a row for every copy.
5. encode: byte-level BPE ids of every text.

All but the last return the columns of ``documents``. Null ids, null and empty
texts, repeated rows, extra columns and empty tables are treated as the
operators' modules say; texts that are null or have no words go in stage 1.
"""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gainkit.llm import minhash, mixing, pii, quality, spbpe
from gainkit.session import Scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with Scratch(spark, "neardup") as scratch:
        return minhash.drop_duplicates(docs, scratch, k=5, threshold=Fraction(4, 5))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spbpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", quality_stage), ("neardup", neardup_stage), ("pii", pii_stage), ("mix", mix_stage), ("encode", encode_stage)]

#: the near-duplicate and encoding stages have no SQL; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's rows written and read again as the next one's documents."""
    with Scratch(spark, "pipeline") as scratch:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for i, (_, stage) in enumerate(STAGES):
            last, docs = docs, scratch.cut(stage(spark, docs, sf_dir))
            if i:
                scratch.drop(last)
        return docs
