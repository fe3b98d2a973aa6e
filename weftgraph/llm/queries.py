"""One registered query per operator, on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import (
    chat_format,
    collocations,
    license_scan,
    mixing,
    near_dedup,
    packing,
    quality_model,
    quality_rules,
    sharding,
    source_audit,
    substring_dedup,
    url_filter,
    vector_search,
)
from weftgraph.llm.common import stored, table

TOKENIZER = "byte_bpe_50k.json"

URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


def tokenizer_path() -> str:
    """The tokenizer file of the registered queries, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs)


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vector_search.integer_vectors(table(spark, sf_dir, "embeddings"))
    return vector_search.top_k(vectors, F.col("id") % 50 == 0, 5).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )


def perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = "concat(s.start, ':', s.length)"
    return chat_format.perspectives(table(spark, sf_dir, "conversations")).withColumn(
        "mask", F.expr(f"array_join(transform(mask, s -> {span}), ',')")
    )


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_dedup.near_duplicates(docs, width=3, percent=85)


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    parts = stored(packing.pieces(docs, tokenizer_path()), "pieces").withColumnRenamed("id", "doc_id")
    return packing.pack(parts).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_model.fit(docs, labels)
    return quality_model.classify(docs.select("doc_id", "text"), model).drop("text")


def rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(rows, "standard-2").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality_rules.passes("base-1")).alias("base_failed"),
        "kept",
        "fail_bits",
    )


def divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.source_divergence(table(spark, sf_dir, "documents"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    outcomes = url_filter.page_outcomes(pages)
    return url_filter.judge_urls(pages, outcomes, URL_RULES).drop("bad_bound")


QUERIES = {
    "op1_license_scan": licenses,
    "op2_repeated_passages": passages,
    "op3_nearest_vectors": nearest,
    "op4_perspectives": perspectives,
    "op5_minimax_shards": shards,
    "op6_source_mix": source_mix,
    "op7_near_duplicates": near_duplicates,
    "op8_packed_sequences": sequences,
    "op9_quality_classifier": quality,
    "op10_rule_ledger": rule_ledger,
    "op11_source_divergence": divergence,
    "op12_collocations": phrases,
    "op13_url_verdicts": url_verdicts,
}
