"""Taxonomy alignment: normalise, label, embed, match, measure, export."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelweave.functions.text import hierarchy_label
from labelweave.operators.embed import Encoder, embed_text
from labelweave.operators.matching import (
    COSINE_MIN, LEXICAL_MIN, exact_duplicates, export_aligned, filter_labels, merge_metrics,
    similar_classes, similar_pairs, sort_pairs, union_rules)


@dataclass
class Alignment:
    pairs: DataFrame
    metrics: DataFrame
    aligned: DataFrame


def prepare_labels(taxonomy: DataFrame, mode: str = "joined", pattern: str | None = None,
                   encoder: str | Encoder = "trigrams") -> DataFrame:
    """(row_id, label, embedding) from a taxonomy with ``levels``."""
    labels = taxonomy.select("row_id", hierarchy_label(F.col("levels"), mode).alias("label"))
    if pattern:
        labels = filter_labels(labels, pattern)
    return embed_text(labels, "label", encoder)


def duplicate_report(labels: DataFrame, label: str = "label") -> Alignment:
    """Exact-duplicate merges only."""
    pairs = exact_duplicates(labels, label, with_key=False)
    return Alignment(pairs, merge_metrics(labels, pairs), export_aligned(labels, pairs))


def align(labels: DataFrame, cos_min: float = COSINE_MIN, jw_min: float = LEXICAL_MIN,
          every_pair: bool = False) -> Alignment:
    """Both rules over (row_id, label, embedding).

    By default similarity runs over one representative per copy group, and each
    copy is paired with its representative: the sources that merge, the metrics of
    reduction and the export are the same, no link is lost, and no copy group is
    expanded into all of its pairs. ``every_pair`` lists those pairs as well.
    """
    exact = exact_duplicates(labels)
    find = similar_pairs if every_pair else similar_classes
    similar = find(labels, cos_min=cos_min, jw_min=jw_min)
    pairs = sort_pairs(union_rules(exact, similar))
    return Alignment(pairs, merge_metrics(labels, pairs), export_aligned(labels, pairs))
