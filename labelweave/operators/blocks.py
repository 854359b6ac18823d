"""Blocked all-pairs scoring.

A theta join on vectors has no equality key. Rows are hashed by id into even
blocks, every block meets every other block in one group, and a group scores
its two blocks with one matrix product. A group never holds more than two
blocks, whatever the data looks like, so hot labels or copies cannot unbalance
it; the number of groups grows with the data.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelweave.functions.similarity import cosine_pairs, squares, unit_rows
from labelweave.session import broadcast_if_small, parallelism

BLOCK_ROWS = 8192       # most rows in one block
SMALL_BLOCK_ROWS = 128  # below this a block is not worth its own group
CHUNK_CELLS = 4_000_000  # score-matrix cells held at a time inside a group
PAIR_SLICE = 4_000       # cosines of pairs worked out at a time, few enough to stay in the cache
MAX_PARTITIONS = 50_000  # groups are dealt to so many partitions in turn


def stored_vectors(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The vectors of a column as rows."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    if lists.null_count:
        raise ValueError(f"{lists.null_count} rows have a text and no vector; check that ids are aligned")
    if len(pc.unique(pc.list_value_length(lists))) > 1:
        raise ValueError("vectors differ in length")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 1))


def unit_vectors(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The vectors of a column as rows of length one; a zero vector stays zero."""
    return unit_rows(stored_vectors(lists))


class Side:
    """One block inside a group: ids, texts, vectors and a group code. Products of unit vectors tell roughly which pairs
    are near; their cosine is that of the stored vectors."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("id").to_numpy()
        self.text = np.array(table.column("text").to_pylist(), dtype=object)
        self.group = np.array(table.column("grp").to_pylist(), dtype=object)
        self._vectors(table)

    def _vectors(self, table: pa.Table):
        self.raw = stored_vectors(table.column("vec"))
        self.square = squares(self.raw)
        self.unit = unit_rows(self.raw)

    def __len__(self):
        return len(self.ids)

    def cosines(self, i: np.ndarray, other: "Side", j: np.ndarray) -> np.ndarray:
        """Cosines of rows *i* with rows *j* of *other*."""
        return np.concatenate([np.zeros(0)] + [
            cosine_pairs(self.raw[a], self.square[a], other.raw[b], other.square[b])
            for a, b in ((i[at:at + PAIR_SLICE], j[at:at + PAIR_SLICE]) for at in range(0, len(i), PAIR_SLICE))])

    def chunks(self, other: "Side") -> Iterator[slice]:
        step = max(1, min(1024, CHUNK_CELLS // max(len(other), 1)))
        for start in range(0, len(self), step):
            yield slice(start, min(start + step, len(self)))


Scorer = Callable[[Side, Side, bool], Iterator[dict]]


def _blocks(rows: int, at_least: int, block_rows: int) -> int:
    wanted = max(math.ceil(rows / block_rows), at_least)
    return max(1, min(wanted, math.ceil(rows / min(SMALL_BLOCK_ROWS, block_rows))))


def _shape(df: DataFrame, side: int, salt: int, blocks: int, kind: str = "array<float>") -> DataFrame:
    grp = F.col("grp") if "grp" in df.columns else F.lit(None).cast("string")
    part = F.col("part") if "part" in df.columns else F.lit(0)
    # a row without a text has nothing to compare
    return df.where(F.col("text").isNotNull()).select(
        F.lit(side).alias("side"), F.col("id").cast("bigint").alias("id"), F.col("text"), grp.alias("grp"),
        F.col("vec").cast(kind).alias("vec"), part.alias("part"),
        F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(blocks)).alias("blk"))


def _run(keyed: DataFrame, groups: int, scorer: Scorer, schema: str, same: Callable[[int], bool]) -> DataFrame:
    arrow = _arrow_schema(schema)

    def score(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        side = table.column("side").to_numpy()
        left = Side(table.filter(pa.array(side == 0)))
        diagonal = same(key[1].as_py())
        right = left if diagonal else Side(table.filter(pa.array(side == 1)))
        if len(left) == 0 or len(right) == 0:
            return
        for part in scorer(left, right, diagonal):
            yield pa.RecordBatch.from_pydict(part, schema=arrow)

    return dealt(keyed, groups).applyInArrow(score, schema=schema)


def dealt(keyed: DataFrame, groups: int) -> GroupedData:
    """*keyed* grouped by ``pair``. Groups are compute-heavy but small in bytes, so partitions must not be merged by size:
    each group has its own, or, with very many groups, they are dealt to the partitions in turn."""
    slots = min(groups, MAX_PARTITIONS)
    spread = keyed.withColumn("slot", F.pmod("pair", F.lit(slots)).cast("int")).repartitionById(slots, "slot")
    return spread.groupBy("slot", "pair")


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string(),
             "int": pa.int32(),
             **{f"array<{k}>": pa.list_(v) for k, v in (("double", pa.float64()), ("bigint", pa.int64()), ("string", pa.string()))}}
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    return pa.schema([pa.field(name, kinds[kind]) for name, kind in fields])


def block_self_join(df: DataFrame, scorer: Scorer, schema: str, rows: int | None = None,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Score every unordered pair of rows of *df* (id, text, vec) exactly once."""
    rows = df.count() if rows is None else rows
    wanted = math.ceil(math.sqrt(2 * parallelism(df.sparkSession)))
    b = _blocks(rows, wanted, block_rows)
    other = F.explode(F.sequence(F.lit(0), F.lit(b - 1)))
    keyed = _shape(df, 0, 0, b).withColumn("other", other)
    keyed = keyed.select(
        (F.least("blk", "other") * b + F.greatest("blk", "other")).alias("pair"),
        F.when(F.col("blk") <= F.col("other"), 0).otherwise(1).alias("side"), "id", "text", "grp", "vec")
    return _run(keyed, b * (b + 1) // 2, scorer, schema, lambda pair: pair // b == pair % b)


def parts_of_groups(df: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """*df* (id, grp, ...) with a ``part`` by id, so that a part of a group holds about *block_rows* rows, and the most parts
    of a group."""
    sizes = df.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("bigint").alias("_parts"))
    most = sizes.agg(F.max("_parts")).first()[0] or 1
    if most == 1:
        return df.withColumn("part", F.lit(0)), 1
    large = broadcast_if_small(sizes.where("_parts > 1"))
    part = F.coalesce(F.pmod(F.xxhash64("id", F.lit(3)), F.col("_parts")), F.lit(0))
    return df.join(large, "grp", "left").withColumn("part", part).drop("_parts"), most


def block_join(left: DataFrame, right: DataFrame, scorer: Scorer, schema: str,
               left_rows: int | None = None, right_rows: int | None = None,
               block_rows: int = BLOCK_ROWS, whole_groups: bool = False) -> DataFrame:
    """Score every (left, right) pair of rows of two (id, text, vec[, grp, part]) sides.

    With *whole_groups* the right side is blocked by ``grp`` and ``part`` so that all rows
    of a part of a group meet a left row in one place; :func:`parts_of_groups` bounds the parts. Vectors of double precision
    on either side are kept as they are.
    """
    left_rows = left.count() if left_rows is None else left_rows
    right_rows = right.count() if right_rows is None else right_rows
    cores = parallelism(left.sparkSession)
    nr = _blocks(right_rows, 1, block_rows)
    nl = _blocks(left_rows, math.ceil(2 * cores / nr), 2 * block_rows)
    double = T.ArrayType(T.DoubleType())
    kind = "array<double>" if any(df.schema["vec"].dataType == double for df in (left, right)) else "array<float>"
    lhs = _shape(left, 0, 1, nl, kind).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(nr - 1))))
    rhs = _shape(right, 1, 2, nr, kind)
    if whole_groups:
        rhs = rhs.withColumn("blk", F.pmod(F.xxhash64("grp", "part"), F.lit(nr)))
    rhs = rhs.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(nl - 1))))
    cols = ["side", "id", "text", "grp", "vec"]
    keyed = lhs.select((F.col("blk") * nr + F.col("other")).alias("pair"), *cols).unionByName(
        rhs.select((F.col("other") * nr + F.col("blk")).alias("pair"), *cols))
    return _run(keyed, nl * nr, scorer, schema, lambda pair: False)
