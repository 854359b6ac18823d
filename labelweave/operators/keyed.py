"""Keyed lookups and rankings that stay balanced when one key is hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key with more probe rows than this is served by a broadcast. There can be
# at most |probe| / HOT_ROWS such keys, which bounds what is broadcast.
HOT_ROWS = 1_000_000


def lookup_unique(probe: DataFrame, build: DataFrame, key: str, rows_col: str, value_col: str,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left lookup of *value_col* from *build* (unique *key*), safe for hot keys.

    *rows_col* of *build* tells how many probe rows carry the key. Hot keys are
    resolved map-side; those probe rows then shuffle under a key of their own,
    so no shuffle partition receives a whole hot group.
    """
    hot = build.where(F.col(rows_col) > hot_rows).select(
        F.col(key).alias("_hot_key"), F.col(value_col).alias("_hot_value"))
    rest = build.where(F.col(rows_col) <= hot_rows).select(
        F.col(key).alias("_key"), F.col(value_col).alias("_value"))
    tagged = probe.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    spread = F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))
    tagged = tagged.withColumn(
        "_key_out", F.when(F.col("_hot_key").isNull(), F.col(key).cast("string")).otherwise(spread))
    joined = tagged.join(rest, F.col("_key_out") == F.col("_key").cast("string"), "left")
    return (joined.withColumn(value_col, F.coalesce("_hot_value", "_value"))
            .drop("_hot_key", "_hot_value", "_key", "_value", "_key_out"))


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int,
                    rank_col: str | None = None) -> DataFrame:
    """First *n* rows per key. *order* must be total; each task keeps only its
    own first *n* per key before the shuffle."""
    rank = rank_col or "_rank"
    out = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out.where(F.col(rank) <= n)
    return out if rank_col else out.drop(rank)


def argmax_per_group(df: DataFrame, keys: list[str], score: str, tie_id: str) -> DataFrame:
    """Best row per key; equal scores go to the lowest *tie_id*."""
    others = [c for c in df.columns if c not in keys]
    # numbers aggregate by hash over all rows; whole rows are compared among the best only
    top = df.groupBy(*keys).agg(F.max(score).alias("_top"))
    met = F.col(f"l.{score}").eqNullSafe(F.col("r._top"))
    for key in keys:
        met = met & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    best = df.alias("l").join(top.alias("r"), met, "left_semi")
    return best.groupBy(*keys).agg(F.min_by(F.struct(*others), tie_id).alias("_best")).select(*keys, "_best.*")


def cap_rows(df: DataFrame, n: int, id_col: str = "row_id") -> DataFrame:
    """Rows whose dense id is below *n*: a pushable range filter."""
    return df.where(F.col(id_col) < n)


def share_of_total(df: DataFrame, count: str, out: str, scale: float = 100.0) -> DataFrame:
    """Each row's share of the summed *count*; the total is one broadcast row."""
    total = df.agg(F.sum(count).alias("_total"))
    return df.crossJoin(F.broadcast(total)).withColumn(
        out, F.try_divide(F.col(count) * F.lit(scale), F.col("_total"))).drop("_total")
