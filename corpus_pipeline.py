"""From raw documents to packed sequences: stages written and reread in turn.

Documents without a language go; of equal texts the one with the largest
doc_id stays; of documents that five-word shingles link at a similarity of 0.8
or more, the smallest doc_id stays; contaminated documents go; what is left is
packed into sequences.

Rows that share a doc_id but not a text are documents of their own up to the
third stage, where they stay or go together.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm.common import materialize, table
from quotelake.llm.decontamination import keep_uncontaminated
from quotelake.llm.exact_dedup import exact_dedup
from quotelake.llm.language_id import keep_identified
from quotelake.llm.ngram_join import similar_documents
from quotelake.llm.packing import pack_documents
from quotelake.session import shared_folder

TOKENIZER = "byte_bpe_50k.json"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return keep_identified(docs)


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows whose doc_id is not in ``dropped`` (one column).

    ``dropped`` is written first: the planner then knows its size and sends it to
    all tasks if it is under the session's threshold, else it sorts and merges.
    """
    ids = materialize(dropped.toDF("__dropped").distinct(), "dropped")
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["__dropped"]), "left_anti")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each set of texts that are equal but for the case of A-Z."""
    found = materialize(exact_dedup(docs).select("doc_id", "text_sha256", "kept"), "copies")
    stay, go = F.count_if("kept"), F.count_if(~F.col("kept"))
    unclear = found.groupBy("doc_id").agg(stay.alias("stay"), go.alias("go")).where("stay > 1 OR (stay = 1 AND go > 0)")
    if unclear.isEmpty():
        return without(docs, found.where(~F.col("kept")).select("doc_id"))
    # Some doc_id is repeated: its rows are told apart by their texts.
    kept = found.where("kept").select(F.col("doc_id").alias("__keep"), F.col("text_sha256").alias("__sha256"))
    normal = F.translate(F.coalesce(docs["text"], F.lit("")), UPPER, LOWER)
    digested = docs.withColumn("__text_sha256", F.sha2(normal, 256))
    same = (digested["__text_sha256"] == kept["__sha256"]) & digested["doc_id"].eqNullSafe(kept["__keep"])
    return digested.join(kept, same, "left_semi").dropDuplicates(["__text_sha256"]).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingles link."""
    groups = materialize(similar_documents(docs, words=5, percent=80).select("doc_id", "component_id"), "groups")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return without(
        docs,
        groups.groupBy("doc_id").agg(F.bool_or(first).alias("stays")).where(~F.col("stays")).select("doc_id"),
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark passages."""
    return keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained network decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = os.path.join(folder, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
