"""From raw documents to packed training sequences; each stage's rows are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import langid, mixing, packing, pii, simhash
from tidemark.llm.common import table, written
from tidemark.llm.queries import tokenizer_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text no language model accepts go; models learn from all labelled ones."""
    return langid.accept(docs, langid.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id.

    Alike are texts whose SimHash fingerprints of three-word shingles differ in at most two bits.
    """
    return simhash.keep_one(docs, bits=2, n=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts are replaced by their kinds in brackets."""
    return pii.mask(docs, pii.learn(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated, up to three times, so that sources meet their targets."""
    return mixing.take(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs every document, repeated ones as often, into sequences of 1,024 tokens."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models, tokenizers and iterated packing are beyond SQL; tests hold the stages against
#: brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
