"""Article classification against themes and types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelweave.operators.articles import (
    THEME_SAMPLE, TYPE_FALLBACK, TYPE_SAMPLE,
    article_entry_similarity, article_result, combined_score, describe_articles, theme_entries, type_entries,
    type_lookup)
from labelweave.operators.embed import Encoder, embed_text


_STATS = ["avg_similarity", "max_similarity", "top_entries", "top_scores", "keyword_similarity"]


@dataclass
class Categories:
    """Sampled, embedded category entries; small, computed once, storable."""

    themes: DataFrame  # category, name, ord, entry, embedding
    types: DataFrame   # category, name, ord, entry, embedding
    sizes: DataFrame   # category, veille_type, count


@dataclass
class Classified:
    result: DataFrame
    theme_scores: DataFrame
    type_scores: DataFrame
    described: DataFrame


def prepare_categories(themed: DataFrame, type_sheets: DataFrame, type_totals: DataFrame,
                       columns: list[str], order: list, encoder: str | Encoder = "trigrams",
                       theme_sample: int = THEME_SAMPLE, type_sample: int = TYPE_SAMPLE,
                       type_fallback: int = TYPE_FALLBACK) -> Categories:
    """*type_sheets* hold ``type`` and the sheet columns, *type_totals* (Type, Count, QSE).

    Themes and types are told apart by their whole names. The samples are those of the method; -1 takes all labels
    of a theme.
    """
    keyed = type_sheets.withColumn("sheet", F.col("type"))
    sizes = type_lookup(keyed, type_totals).select(
        F.col("sheet").alias("category"), "veille_type", "count")
    types = type_entries(keyed, columns, order, "sheet", type_sample, fallback_sample=type_fallback).join(
        sizes.select("category", F.col("veille_type").alias("name")), "category")
    # a bounded number of rows per category, reused by every classification
    return Categories(*(df.persist() for df in (
        embed_text(theme_entries(themed, theme_sample), "entry", encoder), embed_text(types, "entry", encoder), sizes)))


_KINDS = ("theme", "type")


def classify_articles(articles: DataFrame, categories: Categories,
                      encoder: str | Encoder = "trigrams") -> Classified:
    """(article_id, text) to best theme and type, with all category scores.

    The descriptions (preview, keywords, phrases, vector) are far smaller than
    the texts and are read three times, so they are kept by the executors; what is lost with one is computed
    again. The caller may unpersist ``described``. Themes and types meet the articles in one block join.
    """
    described = describe_articles(articles, encoder).persist()
    theme, kind_type = (F.lit(f"{kind}:") for kind in _KINDS)
    entries = categories.themes.withColumn("category", F.concat(theme, "category")).unionByName(
        categories.types.withColumn("category", F.concat(kind_type, "category")))
    scored = article_entry_similarity(described, entries).select(
        "article_id", F.substring_index("category", ":", 1).alias("kind"),
        F.expr("substr(category, instr(category, ':') + 1)").alias("category"), *_STATS)
    themes = scored.where(F.col("kind") == _KINDS[0]).select(
        "article_id", F.col("category").alias("theme"),
        combined_score("avg_similarity", "max_similarity", "keyword_similarity").alias("score"), *_STATS)
    types = scored.where(F.col("kind") == _KINDS[1]).join(categories.sizes, "category").select(
        "article_id", "veille_type", combined_score(
            "avg_similarity", "max_similarity", "keyword_similarity", "count").alias("score"), *_STATS)
    return Classified(article_result(described, themes, types), themes, types, described)
