"""Corpus preparation in five stages over the documents table; each works on what the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelweave.llm.bpe import encode_documents
from labelweave.llm.common import stored
from labelweave.llm.hyperminhash import one_of_each
from labelweave.llm.positional_index import without_contaminated
from labelweave.llm.quality import keep_by_rules
from labelweave.llm.secrets import redact

#: Per cent of their five-word shingles that near-duplicates of the stage have in common.
NEAR = 80

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Only the columns of documents are returned."""
    return keep_by_rules(docs.select(*COLUMNS)).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that of the least id, or any if none of the group has an id.

    Rows are judged by their own texts, with ids or without. Texts without words resemble nothing; of their rows
    that repeat an id and a text one stays. Only the columns of documents are returned.
    """
    return one_of_each(docs.select(*COLUMNS), threshold=NEAR)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item, judged by their own text whatever their ids.

    Only the columns of documents are returned.
    """
    return without_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret's span replaced by its kind in brackets and n_chars counted anew.

    Only the columns of documents are returned.
    """
    return (redact(docs.select(*COLUMNS)).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
            .select(*COLUMNS))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with digests of the ids and of what they decode to."""
    return encode_documents(docs.select(*COLUMNS), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("byte_bpe", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage has kept is stored before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        docs = stored(docs) if i < len(STAGES) else docs
    return docs


#: SQL can neither measure fertility nor encode.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
