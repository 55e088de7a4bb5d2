"""The registered queries of this package: thin digests of its operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bisectors, geometric, html_extract, id_planes, langid, line_dedup, mixing, packing, pii, quality, simhash, spotsigs, token_counts,
)
from .common import table


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies on this machine; executors have the same files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    back = id_planes.round_trip(docs, tokenizer_file("word_bpe_49k.json"), end_id=1)
    return back.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.attribute_tokens(docs, tokenizer_file("byte_bpe_50k.json"), rule="most")


def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), end_id=2, capacity=1024)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.learn(docs), ["doc_id"])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.linked_documents(table(spark, sf_dir, "documents"))
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(remainder == 1, F.lit(False)))
    models = langid.learn(docs.where(remainder != 1))
    return langid.identify(docs, models, ["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score")


def op11_geometric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometric.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_lines(table(spark, sf_dir, "documents"), least_chars=40, least_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_bisectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisectors.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2)


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_id_planes": op2_id_planes,
    "op3_token_counts": op3_token_counts,
    "op4_spotsigs": op4_spotsigs,
    "op5_best_fit": op5_best_fit,
    "op6_pii": op6_pii,
    "op7_simhash": op7_simhash,
    "op8_quality_rules": op8_quality_rules,
    "op9_entropy_balancing": op9_entropy_balancing,
    "op10_language_id": op10_language_id,
    "op11_geometric_blocks": op11_geometric_blocks,
    "op12_line_dedup": op12_line_dedup,
    "op13_bisectors": op13_bisectors,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op8_quality_rules": quality.oracle(),
    "op11_geometric_blocks": geometric.oracle(),
    "op12_line_dedup": line_dedup.oracle(),
    "op13_bisectors": bisectors.oracle(),
}
