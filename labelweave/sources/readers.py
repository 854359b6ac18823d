"""Readers for taxonomies, records, pairs, vectors, sheets, articles and rules."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelweave.operators.ids import dense_row_ids
from labelweave.sources.quoted import read_quoted

_SPLIT = ["source_ord", "_file", "_start"]
RULE_TAG = "cursorRule"  # fixed value: element name of a rule in a catalogue file


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """Tab when the first line holds more tabs than commas, else comma."""
    lines = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0)
    first = lines.select(
        F.length("value") - F.length(F.replace("value", F.lit("\t"), F.lit(""))),
        F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))).first()
    return "\t" if first and first[0] > first[1] else ","


def _located(df: DataFrame, source_ord: int) -> DataFrame:
    return df.select("*", F.lit(source_ord).alias("source_ord"), F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_start"))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All rows; a narrower source gets nulls for the columns it lacks."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_taxonomy(spark: SparkSession, paths: list[str], header: bool = False) -> DataFrame:
    """(row_id, source, source_ord, levels): header-less delimited files, all strings.

    Ids are dense over the sources in argument order, then file position.
    Blanks stay empty strings; cells missing in narrower sources are null.
    """
    frames = []
    for ord_, path in enumerate(paths):
        raw = spark.read.csv(path, sep=sniff_delimiter(spark, path), header=header, inferSchema=False,
                             quote='"', escape='"')
        levels = F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in raw.columns]).alias("levels")
        frames.append(_located(raw, ord_).select(F.lit(path).alias("source"), levels, *_SPLIT))
    numbered = dense_row_ids(union_sources(frames), _SPLIT)
    width = numbered.agg(F.max(F.size("levels"))).first()[0] or 0
    padded = F.transform(F.sequence(F.lit(0), F.lit(max(width - 1, 0))), lambda i: F.get("levels", i))
    return numbered.select("row_id", "source", "source_ord", padded.alias("levels"))


def read_records(spark: SparkSession, path: str, multi_line: bool = True, row_ids: bool = True) -> DataFrame:
    """Delimited records with a header, every column a string, quoted fields honoured.

    ``multi_line`` allows line breaks inside quotes; such files are read in splits like any others
    (:mod:`labelweave.sources.quoted`).
    """
    sep = sniff_delimiter(spark, path)
    if multi_line:
        return read_quoted(spark, path, sep, row_ids)
    raw = spark.read.csv(path, sep=sep, header=True, inferSchema=False, quote='"', escape='"')
    if not row_ids:
        return raw
    numbered = dense_row_ids(_located(raw, 0), _SPLIT)
    return numbered.select("row_id", *[F.col(f"`{c}`") for c in raw.columns])


def read_merge_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="source_id bigint, target_id bigint")


def read_embeddings(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """(row_id, embedding); *first* keeps ids below it (a pushed-down filter)."""
    out = spark.read.parquet(path).select("row_id", "embedding")
    return out if first is None else out.where(F.col("row_id") < first)


def check_aligned(labels: DataFrame, embeddings: DataFrame) -> None:
    """Raise unless every label has exactly one vector and the other way round."""
    counts = (labels.select("row_id", F.lit(1).alias("l"), F.lit(0).alias("e"))
              .unionByName(embeddings.select("row_id", F.lit(0).alias("l"), F.lit(1).alias("e")))
              .groupBy("row_id").agg(F.sum("l").alias("l"), F.sum("e").alias("e")))
    bad = counts.where((F.col("l") != 1) | (F.col("e") != 1)).count()
    if bad:
        raise ValueError(f"labels and embeddings differ on {bad} ids")


def read_embeddings_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(f"{path}/meta", schema="input string, model string, dim int, filter string")


def read_sheets(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """Rows of a sheet set without its summary; one *sheet* reads one partition only."""
    out = spark.read.option("basePath", f"{path}/sheets").parquet(f"{path}/sheets")
    return out if sheet is None else out.where(F.col("sheet_key") == sheet)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/summary")


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """(article_id, text, path): each file is one article. Ids are unique within the frame and set by the listing."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("path"))
    return files.select(F.monotonically_increasing_id().alias("article_id"), "text", "path")


_PAIR = r"([\w.\-:]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
_CHILD = r"<([A-Za-z_][\w.\-:]*)((?:\s+[\w.\-:]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*)\s*/?>"


def _attributes(element):
    """Attributes of one element text, in document order."""
    def group(n):
        return F.regexp_extract_all(element, F.lit(_PAIR), F.lit(n))
    values = F.zip_with(group(2), group(3), lambda a, b: F.concat(a, b))
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        values = _replace_each(values, entity, char)
    return F.map_from_arrays(group(1), values)


def _replace_each(values, entity, char):
    return F.transform(values, lambda v: F.replace(v, F.lit(entity), F.lit(char)))


def read_rules(spark: SparkSession, path: str, row_tag: str = RULE_TAG) -> DataFrame:
    """Nested rule rows from XML catalogues (one small file each).

    Scalar fields go through the XML parser; condition children and attributes
    are taken from the element text, because their document order counts.
    """
    text = F.regexp_replace("value", "(?s)<!--.*?-->", "")
    rules = spark.read.text(path, wholetext=True).select(F.explode(F.regexp_extract_all(
        text, F.lit(rf"(?s)<{row_tag}\b[^>]*(?:/>|>.*?</{row_tag}>)"), F.lit(0))).alias("rule"))
    parsed = rules.select("rule", F.from_xml(
        "rule", "_id string, _priority string, description string", {"rowTag": row_tag}).alias("x"))
    inner = F.regexp_extract("rule", r"(?s)<condition\b[^>]*>(.*?)</condition>", 1)
    condition = F.transform(F.regexp_extract_all(inner, F.lit(_CHILD), F.lit(0)), lambda e: F.struct(
        F.regexp_extract(e, r"^<([A-Za-z_][\w.\-:]*)", 1).alias("tag"), _attributes(e).alias("attrs")))
    action = F.regexp_extract("rule", r"(?s)<action\b([^>]*)>", 1)
    return parsed.select(
        F.col("x._id").alias("id"), F.col("x._priority").alias("priority"), F.col("x.description").alias("description"),
        condition.alias("condition"),
        F.when(F.contains("rule", F.lit("<action")), _attributes(action)).alias("action"))


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
