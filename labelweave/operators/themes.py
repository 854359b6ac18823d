"""Clusters of labels turned into named, editable themes."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelweave.functions.text import capitalize, normalize_text, words
from labelweave.operators.matching import first_occurrence
from labelweave.operators.keyed import top_n_per_group
from labelweave.session import cut_lineage

# Clustering and naming defaults.
THEMES = 12
SEED = 42
NAME_WORDS = 5
MIN_WORD_CHARS = 4
EXAMPLES = 3


def theme_points(labels: DataFrame) -> DataFrame:
    """*labels* with their vectors as points, stored, as the fit reads them again and again. A row without a vector stops
    the job: ids are not aligned then."""
    aligned = F.when(F.col("embedding").isNull(), F.raise_error(F.lit("a row has no vector; check that ids are aligned"))).otherwise(
        F.col("embedding").cast("array<double>"))
    return cut_lineage(labels.withColumn("_features", array_to_vector(aligned)))


def fit_themes(points: DataFrame, k: int = THEMES, seed: int = SEED) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(points)


def cluster_themes(labels: DataFrame, k: int = THEMES, seed: int = SEED) -> DataFrame:
    """K-means cluster per label, on the vectors as given."""
    points = theme_points(labels)
    return fit_themes(points, k, seed).transform(points).drop("_features")


def cluster_keywords(clustered: DataFrame, n: int = NAME_WORDS, label: str = "label") -> DataFrame:
    """The *n* most frequent words per cluster; the first seen wins ties.

    Words are counted per cluster before any ranking, and each task keeps only
    its own best before the ranking shuffle.
    """
    tokens = clustered.select("cluster", "row_id", F.posexplode(words(normalize_text(label))).alias("pos", "word"))
    # place of a word as one number: a struct would force a sort-based aggregate
    place = F.col("row_id").cast("decimal(20,0)") * F.lit(10 ** 10).cast("decimal(11,0)") + F.col("pos")
    counts = (tokens.where(F.char_length("word") >= MIN_WORD_CHARS)
              .select("cluster", "word", place.cast("decimal(38,0)").alias("place")).groupBy("cluster", "word")
              .agg(F.count(F.lit(1)).alias("count"), F.min("place").alias("_seen")))
    return top_n_per_group(counts, ["cluster"], [F.desc("count"), F.col("_seen")], n, "rank").drop("_seen")


def name_clusters(keywords: DataFrame, clustered: DataFrame, label: str = "label") -> DataFrame:
    """(cluster, theme): the two leading words, or the cluster's first label.

    A name taken by a lower cluster gets a number, so no theme hides another.
    """
    # at most NAME_WORDS words per cluster reach this list
    lists = keywords.groupBy("cluster").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]).alias("_words"))
    first = first_occurrence(clustered.select("cluster", "row_id", F.col(label).alias("_label")), "cluster").drop("row_id")
    base = first.join(lists, "cluster", "left").select("cluster", capitalize(F.when(
        F.size(F.coalesce("_words", F.array())) >= 2,
        F.array_join(F.slice("_words", 1, 2), " / ")).otherwise(F.col("_label"))).alias("_name"))
    clash = F.row_number().over(Window.partitionBy("_name").orderBy("cluster"))
    return base.withColumn("_n", clash).select("cluster", F.when(
        F.col("_n") == 1, F.col("_name")).otherwise(F.concat("_name", F.lit(" ("), F.col("_n").cast("string"), F.lit(")"))
                                                    ).alias("theme"))


def theme_assignment(clustered: DataFrame, label: str = "label") -> DataFrame:
    """(label_id, label, theme) for every label; one row per cluster is joined back."""
    names = name_clusters(cluster_keywords(clustered, label=label), clustered, label)
    return clustered.join(names, "cluster").select(
        F.col("row_id").alias("label_id"), F.col(label).alias("label"), "theme", "cluster")


def theme_summary(themed: DataFrame) -> DataFrame:
    """(Theme, Count, Examples): size and the first labels in alphabetical order."""
    sizes = themed.groupBy("theme").agg(F.count(F.lit(1)).alias("Count"))
    lead = top_n_per_group(themed.select("theme", "label", "label_id"), ["theme"],
                           [F.col("label"), F.col("label_id")], EXAMPLES, "_rank")
    examples = lead.groupBy("theme").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("_rank", "label"))), lambda x: x["label"]), ", ").alias("Examples"))
    return sizes.join(examples, "theme", "left").select(F.col("theme").alias("Theme"), "Count", "Examples")


def rename_themes(df: DataFrame, mapping: DataFrame, theme: str = "theme") -> DataFrame:
    """New names where the mapping has one; a repeated old name takes the last name alphabetically."""
    names = mapping.groupBy("old_theme").agg(F.max("new_theme").alias("_new"))
    out = df.join(names, F.col(theme) == F.col("old_theme"), "left")
    return out.withColumn(theme, F.coalesce("_new", theme)).drop("old_theme", "_new")


def reassign_entries(themed: DataFrame, reassignments: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Move listed entries to their new theme, then apply the renames to the rest.

    ``old_theme`` of a move is the name before renaming.
    """
    moved_from = reassignments.select("label_id", F.col("old_theme").alias("theme")).distinct()
    kept = themed.select("label_id", "label", "theme").join(moved_from, ["label_id", "theme"], "left_anti")
    if mapping is not None:
        kept = rename_themes(kept, mapping)
    added = reassignments.select("label_id", "label", F.col("new_theme").alias("theme"))
    return kept.select("label_id", "label", "theme").unionByName(added)


def sort_labels(themed: DataFrame) -> DataFrame:
    """Rows of a theme together and in label order as a whole; a large theme spans neighbouring tasks."""
    return themed.orderBy("theme", "label", "label_id")
