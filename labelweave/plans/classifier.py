"""Pair classifier: train from merge pairs, report, then group and assign."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelweave.operators.embed import Encoder, embed_text
from labelweave.operators.grouping import assign_records
from labelweave.operators.model import (
    NEGATIVE_SAMPLE, TEST_FRACTION, MergeModel, classification_metrics, coefficients, known_features, pair_features,
    predict, roc_auc, sample_negatives, stratified_split, train_merge_classifier, union_examples)


@dataclass
class Trained:
    pipeline: PipelineModel
    model: MergeModel
    metrics: DataFrame
    auc: float


def build_features(labels: DataFrame, positives: DataFrame, negatives: int = NEGATIVE_SAMPLE,
                   seed: int = 42, classes: DataFrame | None = None,
                   merged: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Features of all positives and a sample of non-merges, with their split. Positives with ``lex`` and ``cos`` keep them;
    *merged* tells the merges among drawn pairs, in place of the positives (see no_merges)."""
    drawn = sample_negatives(labels, merged or positives, negatives, seed, classes)
    if {"lex", "cos"} <= set(positives.columns):
        return stratified_split(known_features(positives, drawn, labels), TEST_FRACTION, seed)
    examples = union_examples(positives, drawn, seed, shuffled=False)
    return stratified_split(pair_features(examples, labels), TEST_FRACTION, seed)


def train(labels: DataFrame, positives: DataFrame, negatives: int = NEGATIVE_SAMPLE, seed: int = 42,
          classes: DataFrame | None = None, merged: Callable[[DataFrame], DataFrame] | None = None) -> Trained:
    """*positives* of representatives need *classes* (see class_table), or their copies would count as negatives."""
    # the split is read by training, metrics and AUC
    features = build_features(labels, positives, negatives, seed, classes, merged).persist()
    try:
        pipeline = train_merge_classifier(features.where(~F.col("is_test")))
        model = coefficients(pipeline)
        scored = predict(features.where("is_test"), model)
        report = classification_metrics(scored).toPandas()  # classes + 3 rows
        metrics = labels.sparkSession.createDataFrame(report)
        return Trained(pipeline, model, metrics, roc_auc(scored))
    finally:
        features.unpersist()


def assign(records: DataFrame, labels: DataFrame, model: MergeModel, title: str,
           encoder: str | Encoder = "trigrams") -> DataFrame:
    """Embed titles and give each record its best label."""
    embedded = embed_text(records, title, encoder)
    return assign_records(embedded, labels, model, title).drop("embedding")
