"""Corpus preparation: five stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import mixing, near_dedup, packing, quality_model, substring_dedup
from weftgraph.llm.common import WORD, fresh, stored, table
from weftgraph.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from ``labels`` and ``docs``.

    Every row is judged by its text alone, so repeated rows stay or go together; a null text
    is judged as an empty one. Nulls in other columns do not matter.
    """
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return quality_model.classify(docs, model).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicate texts.

    Rows are told apart by their place in the stored table, not by id: of rows equal in
    everything one stays, rows that share an id are judged by their own texts, and so are
    those with a null id. Null and blank texts are linked with nothing and stay.
    """
    (row,) = fresh(docs, "row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_dedup.near_duplicates(numbered.select(row, "text"), width=5, percent=80, id_col=row)
    gone = stored(found.where("not kept").select(row), "near-duplicates")
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines and passages; those of which nothing is left go.

    The earliest occurrence by id stays. Null and blank texts stay as they are.
    """
    cut = substring_dedup.remove_repeats(docs)
    left = (F.col("removed_words") == 0) | F.col("text").rlike(WORD)
    columns = [
        F.when(F.col("removed_words") > 0, F.length("text")).otherwise(F.col(c)).cast(kind).alias(c)
        if c == "n_chars"
        else F.col(c)
        for c, kind in docs.dtypes
    ]
    return cut.where(left).select(*columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the weights 3, 1, 2 by code point, up to two copies of a document.

    A null source is one of its own and comes last. Texts without words have no size and
    are not taken. Equal rows are taken as often as each of them is due.
    """
    plan = stored(mixing.mix_sources(docs), "mix-plan")
    return mixing.mixed_documents(docs, plan)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 2,048 tokens.

    A null text is an empty one, which is a piece of one token; repeated rows are packed
    once each, and an empty table makes no sequence.
    """
    parts = stored(packing.pieces(docs, tokenizer_path()), "pieces")
    return packing.pack(parts).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mix", mix),
    ("packing", pack),
]

# Trained scorers, sketches and tokenizers are beyond SQL; tests/llm holds brute-force checks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"stage-{number}")
    return docs
