"""The registered queries of this subpackage and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .alignment import align_tokenizers
from .backoff_lm import language_model_scores
from .boosted_trees import quality_scores
from .bpe import encode_documents
from .common import documents
from .hyperdimensional import language_of_documents
from .hyperminhash import near_duplicates
from .merkle import merkle_report
from .piecewise import edited_fingerprints
from .positional_index import decontaminate
from .quality import quality_rules
from .quotations import reply_order
from .secrets import find_secrets
from .sql import DECONTAMINATION_SQL, MERKLE_SQL, NEAR_DUPLICATES_SQL, QUOTATIONS_SQL
from .token_transducer import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules(documents(spark, d))


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return find_secrets(documents(spark, d)).drop("found")


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    return encode_documents(documents(spark, d))


@query("op3_near_duplicates", NEAR_DUPLICATES_SQL)
def op3_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(documents(spark, d))


@query("op8_decontamination", DECONTAMINATION_SQL)
def op8_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate(documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet"))


@query("op5_language_model")
def op5_language_model(spark: SparkSession, d: str) -> DataFrame:
    return language_model_scores(documents(spark, d))


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return quality_scores(documents(spark, d), spark.read.parquet(f"{d}/labels.parquet"))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language_of_documents(documents(spark, d))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(documents(spark, d))


@query("op10_quotation_linking", QUOTATIONS_SQL)
def op10_quotation_linking(spark: SparkSession, d: str) -> DataFrame:
    return reply_order(spark.read.parquet(f"{d}/conversations.parquet"))


@query("op11_merkle_manifest", MERKLE_SQL)
def op11_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return merkle_report(documents(spark, d))


@query("op12_tokenizer_alignment")
def op12_tokenizer_alignment(spark: SparkSession, d: str) -> DataFrame:
    return align_tokenizers(documents(spark, d))


@query("op13_piecewise_fingerprints")
def op13_piecewise_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return edited_fingerprints(documents(spark, d))
