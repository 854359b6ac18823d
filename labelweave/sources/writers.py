"""Writers for taxonomies, tables, sheet sets, vectors, audits and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelweave.functions.text import sheet_key
from labelweave.operators.matching import merge_audit
from labelweave.session import broadcast_if_small

MAX_FILE_ROWS = 5_000_000
SHEET_NAME_CHARS = 31
SUFFIX_CHARS = 8


def write_taxonomy(df: DataFrame, path: str, columns: list[str] | None = None, levels: str = "levels",
                   mode: str = "error") -> None:
    """Header-less CSV in id order. *levels* arrays are spread into columns."""
    if columns is None:
        width = df.agg(F.max(F.size(levels))).first()[0] or 0
        cells = [F.get(levels, F.lit(i)).alias(f"level_{i}") for i in range(width)]
    else:
        cells = [F.col(c) for c in columns]
    df.orderBy("row_id").select(*cells).write.csv(path, header=False, emptyValue="", quote='"', escape='"', mode=mode)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "error") -> None:
    df.write.csv(path, header=True, sep=sep, quote='"', escape='"', mode=mode)


def sheet_names(df: DataFrame, name: str, fallback: Column) -> DataFrame:
    """(_name, sheet_key): a sheet name of its own for every name, within the length that sheets allow.

    Of names with one key the first keeps it. The others share it up to a suffix behind ~, which no key holds
    otherwise, numbered among all that begin alike, so that shortened keys do not meet either.
    """
    keyed = df.select(F.col(name)).distinct().select(F.col(name).alias("_name"), sheet_key(name, fallback).alias("_key"))
    nth = F.row_number().over(Window.partitionBy("_key").orderBy("_name"))
    ranked = keyed.withColumn("_nth", nth)
    more = ranked.where("_nth > 1").withColumn("_head", F.substring("_key", 1, SHEET_NAME_CHARS - SUFFIX_CHARS))
    suffix = F.row_number().over(Window.partitionBy("_head").orderBy("_key", "_nth"))
    return ranked.where("_nth = 1").select("_name", F.col("_key").alias("sheet_key")).unionByName(
        more.select("_name", F.concat("_head", F.lit("~"), suffix.cast("string")).alias("sheet_key")))


def write_sheets(df: DataFrame, path: str, name: str, order: list, summary: DataFrame | None = None,
                 fallback: str | Column = "Sheet", mode: str = "error") -> None:
    """One partition per sheet, rows in *order* inside a file, plus a summary.

    A name without any sheet-safe character goes to *fallback* plus its hash.
    A hot sheet stays spread over the tasks that hold its rows, in files of
    bounded length.
    """
    if isinstance(fallback, str):
        fallback = F.concat(F.lit(f"{fallback}_"), F.hex(F.hash(name)))
    names = broadcast_if_small(sheet_names(df, name, fallback))
    keyed = df.join(names, F.col(name).eqNullSafe(F.col("_name"))).drop("_name")
    # ranges of (sheet, order): a sheet lies in few neighbouring tasks, however many tasks there are
    (keyed.repartitionByRange("sheet_key", *order).sortWithinPartitions("sheet_key", *order).write.mode(mode)
     .option("maxRecordsPerFile", MAX_FILE_ROWS).partitionBy("sheet_key").parquet(f"{path}/sheets"))
    if summary is not None:
        summary.write.mode(mode).parquet(f"{path}/summary")


def write_embeddings(df: DataFrame, path: str, source: str, model: str, filter_pattern: str | None = None,
                     mode: str = "error") -> None:
    """Vectors as Parquet and one JSON row of metadata."""
    vectors = df.select("row_id", F.col("embedding").cast("array<float>").alias("embedding"))
    vectors.write.mode(mode).parquet(f"{path}/vectors")
    stored = df.sparkSession.read.parquet(f"{path}/vectors")
    meta = stored.agg(F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("dim")).select(
        F.lit(source).alias("input"), F.lit(model).alias("model"), "dim",
        F.lit(filter_pattern).cast("string").alias("filter"))
    meta.coalesce(1).write.mode(mode).json(f"{path}/meta")


def write_audit(pairs: DataFrame, path: str, mode: str = "append") -> None:
    """Audit lines as text, one per decision."""
    merge_audit(pairs).select("line").write.mode(mode).text(path)


def save_model(model: PipelineModel, path: str, overwrite: bool = True) -> None:
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)
