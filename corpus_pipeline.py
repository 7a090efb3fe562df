"""A pipeline over ``documents``: each stage is written as Parquet and read by the next one.

Language ID drops what it cannot place, line dedup shortens texts, near-dedup keeps one
document of each group, PII is masked, and packing turns what is left into pieces of
training sequences. All stages but the last return the columns of their input; ``n_chars``
follows the text. An empty table passes through all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm import byte_gru, line_templates, order_minhash, packing, pii_spans
from clickweir.llm.frames import table, unused, written
from clickweir.llm.queries import tokenizer_path
from clickweir.session import fresh_dir, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
MIN_LANGUAGE_SCORE = 0.4


def _resized(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is recognised; texts without a letter go."""
    languages, net = byte_gru.fit(docs, ~byte_gru.held_out())
    found = unused(docs, "found_language")
    named = docs.withColumn(found, byte_gru.language(languages, net))
    return named.where(
        (F.col(found)["lang_pred"] != byte_gru.UNKNOWN) & (F.col(found)["score"] >= MIN_LANGUAGE_SCORE)
    ).drop(found)


def drop_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without lines that recur in others."""
    return _resized(line_templates.drop_recurring(docs, **line_templates.PASSAGES))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return order_minhash.deduplicated(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return _resized(pii_spans.mask(docs))


def pack_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of training sequences of the texts that are left."""
    return packing.digest(packing.pack(docs, tokenizer_path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_documents),
]

# Stages run a tokenizer and a trained network: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        kept = fresh_dir(spark, f"pipeline-{name}")
        with scratch(spark):  # what the stage has written on its way goes with its end
            docs = written(stage(spark, docs, folder), kept)
    return STAGES[-1][1](spark, docs, folder)
