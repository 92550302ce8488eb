"""From raw documents to training sequences: language, repeated lines, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; what it returns is written and
read again before the next stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm import jaccard, language_id, line_dedup, packing
from scoreloom.llm.common import broadcast_if_small, prepare
from scoreloom.llm.queries import LANGUAGES, packing_tokenizer
from scoreloom.session import materialize, scratch


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages; the model is fitted on their own labels,
    which are no evidence beside it.

    Null and blank texts are rejected.
    """
    prepare(spark)
    model = language_id.fit(docs, LANGUAGES)
    found = language_id.identify(docs, model, host=F.col("source"))
    rejected = found.where("not kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    rejected = broadcast_if_small(materialize(rejected, "rejected"))
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("__hash"))
    return docs.join(rejected, same, "left_anti")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line equals or nearly equals.

    A document that loses lines and keeps no text goes.
    """
    prepare(spark)
    found = line_dedup.repeated_lines(docs)
    number = "__removed"
    cleaned = line_dedup.without_lines(docs, found, removed=number)
    cleaned = cleaned.where((F.col(number) == 0) | (F.trim(F.translate("text", "\r\n\t", "   ")) != ""))
    return cleaned.select(*[F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Documents without id stay. An id that several rows share stays if one of them does.
    """
    prepare(spark)
    with scratch() as keep:
        found = jaccard.near_duplicates(docs)
        dropped = found.groupBy("doc_id").agg(F.min(F.col("component_id") != F.col("doc_id")).alias("dropped"))
        dropped = keep(materialize(dropped.where("dropped").select("doc_id"), "dropped"))
    dropped = broadcast_if_small(dropped)
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    prepare(spark)
    pieces = packing.pack(docs, packing_tokenizer())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard", one_of_each_group),
    ("packing", packed),
]

#: Models, edit joins and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
