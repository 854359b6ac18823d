"""Dense 0-based row ids in source order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelweave.session import broadcast_if_small


def _positions(source_cols: list[str]):
    """Add a counter to the batches of a partition that restarts where the source changes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            change = np.zeros(n, dtype=bool)
            for name in source_cols:
                codes = batch.column(batch.schema.get_field_index(name)).dictionary_encode().indices.to_numpy(
                    zero_copy_only=False)
                change[1:] |= codes[1:] != codes[:-1]
            source = lambda row: tuple(
                batch.column(batch.schema.get_field_index(c))[row].as_py() for c in source_cols)
            change[0] = source(0) != last
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(change, at, -1))
            position = at - start
            position[start < 0] += seen - 1  # rows that go on with the source of the batch before
            last, seen = source(n - 1), int(position[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(position, pa.int64())],
                                             names=[*batch.schema.names, "_pos"])
    return run


def dense_row_ids(df: DataFrame, source_cols: list[str], id_col: str = "row_id") -> DataFrame:
    """Number rows by *source_cols* (file, split offset, ...) and position within.

    Rows of one source sit together and in order in one task, as they do in every scan of the same files, so a
    counter gives the position. A first scan of the
    source columns alone counts the rows of each source; only that table, with one row per source, is
    ordered. The data itself is never sorted, stored or shuffled.
    """
    counts = df.groupBy(*source_cols).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per input split: at most (bytes read / split size) rows
    before = Window.orderBy(*source_cols).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*source_cols, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    schema = T.StructType([*df.schema.fields, T.StructField("_pos", T.LongType())])
    placed = df.mapInArrow(_positions(source_cols), schema)
    return (placed.join(broadcast_if_small(offsets), source_cols)
            .withColumn(id_col, (F.col("_offset") + F.col("_pos")).cast("bigint")).drop("_pos", "_offset"))
