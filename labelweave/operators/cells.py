"""Similar pairs through cells of unit vectors: an exact metric index.

Pivots are drawn from the rows and spread out; every row lives in the cell of its nearest pivot, and a cell knows the
widest angle of its rows. Angles obey the triangle inequality, so a row can have a partner within *reach* in a cell only
if its angle to the pivot is at most the cell's radius plus the reach; other rows never travel there, and two cells meet
not at all when no row of one passes for the other. Nothing is approximate: how many pivots there are, and which, decides
the work and never the result.

A cell with many rows is split by id, and so are its visitors, so a group never holds more than two blocks of about
``block_rows`` rows, whatever the data looks like. Only pivots, radii and counts reach the driver: at most MAX_CELLS of
each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelweave.functions.similarity import cosine_pairs, squares, unit_rows
from labelweave.operators.blocks import (
    BLOCK_ROWS, CHUNK_CELLS, PAIR_SLICE, Scorer, _blocks, _run, dealt, stored_vectors, unit_vectors,
)
from labelweave.session import cut_lineage, parallelism

MAX_CELLS = 4096
SAMPLE_PER_CELL = 4   # rows drawn for each pivot wanted
SLACK = 1e-5          # of angles, against rounding
SLICE_ROWS = 20_000   # rows a task sends out at a time


_SPLIT, _SHIFT = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _dealt(ids: np.ndarray, salt: np.uint64) -> np.ndarray:
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    return (mixed * salt >> np.uint64(33)).astype(np.int64)


def angles_to(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    if len(unit) and unit.shape[1] != pivots.shape[1]:
        raise ValueError("vectors differ in length")
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def spread_pivots(sample: np.ndarray, cells: int) -> np.ndarray:
    """Rows of *sample*, each the farthest from those taken before it."""
    taken = [0]
    nearest = angles_to(sample, sample[:1])[:, 0]
    while len(taken) < min(cells, len(sample)):
        far = int(nearest.argmax())
        if nearest[far] <= SLACK:
            break  # only copies are left
        taken.append(far)
        nearest = np.minimum(nearest, angles_to(sample, sample[far:far + 1])[:, 0])
    return sample[taken]


@dataclass
class CellPlan:
    """Where rows live and travel. *foreign* counts the rows of earlier cells that visit a cell."""

    pivots: np.ndarray
    reach: float
    block_rows: int
    radii: np.ndarray
    home: np.ndarray
    foreign: np.ndarray | None = None

    def place(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        angles = angles_to(unit, self.pivots)
        return angles.argmin(axis=1), angles

    def visits(self, cell: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, later cell) for every cell in which a row can have a partner."""
        near = angles <= self.radii + self.reach + SLACK
        near &= np.arange(len(self.pivots)) > cell[:, None]
        near &= self.home > 0
        return np.nonzero(near)

    def split(self, ids: np.ndarray, cell: np.ndarray) -> np.ndarray:
        return _dealt(ids, _SPLIT) % self.splits[cell]

    @property
    def splits(self) -> np.ndarray:
        return np.ceil(self.home / self.block_rows).astype(np.int64)

    @property
    def shifts(self) -> np.ndarray:
        """Blocks of visitors: rows of earlier cells, and of earlier splits of the same cell."""
        visitors = self.foreign + np.where(self.splits > 1, self.home, 0)
        return np.ceil(visitors / self.block_rows).astype(np.int64)

    @property
    def first_group(self) -> np.ndarray:
        return np.r_[0, np.cumsum(self.splits * (1 + self.shifts))]

    def routes(self, ids: np.ndarray, cell: np.ndarray, angles: np.ndarray):
        """(row, group, side) of all copies of some rows. The first group of a split compares its rows with each other,
        the others compare them (side 1) with a block of visitors (side 0)."""
        splits, shifts, first = self.splits, self.shifts, self.first_group
        split, other = self.split(ids, cell), _dealt(ids, _SHIFT)
        rows = np.arange(len(ids))
        base = first[cell] + split * (1 + shifts[cell])
        yield rows, base, np.zeros(len(rows), dtype=np.int64)
        again, step = _expanded(shifts[cell])
        yield again, base[again] + 1 + step, np.ones(len(again), dtype=np.int64)
        later, step = _expanded(splits[cell] - 1 - split)
        home = cell[later]
        yield (later, first[home] + (split[later] + 1 + step) * (1 + shifts[home]) + 1 + other[later] % np.maximum(shifts[home], 1),
               np.zeros(len(later), dtype=np.int64))
        row, target = self.visits(cell, angles)
        copy, step = _expanded(splits[target])
        row, target = row[copy], target[copy]
        yield (row, first[target] + step * (1 + shifts[target]) + 1 + other[row] % np.maximum(shifts[target], 1),
               np.zeros(len(row), dtype=np.int64))

    def among_themselves(self, group: int) -> bool:
        first = self.first_group
        cell = int(np.searchsorted(first, group, side="right")) - 1
        return (group - first[cell]) % (1 + self.shifts[cell]) == 0

    def report(self) -> dict[str, int]:
        """Cells, pairs of cells, those that cannot hold a similar pair, and the rows that travel."""
        between = angles_to(self.pivots, self.pivots)
        later = np.triu(np.ones(between.shape, dtype=bool), 1)
        apart = between - self.radii[:, None] - self.radii[None, :] > self.reach + SLACK
        inside = (self.home * (1 + self.shifts)).sum() + (self.home * np.maximum(self.splits - 1, 0) // 2).sum()
        return {"cells": len(self.pivots), "cell_pairs": int(later.sum()), "skipped": int((apart & later).sum()),
                "rows": int(self.home.sum()), "travelling": int(inside + (self.foreign * self.splits).sum())}


def _expanded(times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each position as often as *times* says, and which of its times it is."""
    times = np.maximum(times, 0)
    at = np.repeat(np.arange(len(times)), times)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)


def _summed(rows: DataFrame, work, how) -> DataFrame:
    """Per cell, what *work* (unit vectors -> cell, value, count arrays) says of each batch."""
    kinds = pa.schema([("cell", pa.int64()), ("value", pa.float64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(work(unit_vectors(batch.column("vec"))), kinds.types)], schema=kinds)

    return rows.select("vec").mapInArrow(run, "cell bigint, value double, n bigint").groupBy("cell").agg(*how)


def plan_cells(rows: DataFrame, cos_min: float, block_rows: int = BLOCK_ROWS, cells: int | None = None) -> CellPlan:
    """Pivots, radii and counts for *rows* (id, text, vec)."""
    total = rows.count()
    wanted = math.ceil(math.sqrt(2 * parallelism(rows.sparkSession)))
    cells = min(MAX_CELLS, cells or _blocks(total, wanted, block_rows))
    drawn = rows.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PER_CELL * cells).toArrow()
    sample = unit_vectors(drawn.column("vec"))
    pivots = spread_pivots(sample, cells) if len(sample) else np.zeros((0, 1))
    k = len(pivots)
    plan = CellPlan(pivots, math.acos(max(-1.0, min(1.0, cos_min))), block_rows, np.zeros(k), np.zeros(k, dtype=np.int64))

    def widest(unit):
        cell, angles = plan.place(unit)
        far = np.zeros(k)
        np.maximum.at(far, cell, angles[np.arange(len(cell)), cell])
        n = np.bincount(cell, minlength=k)
        seen = np.flatnonzero(n)
        return seen, far[seen], n[seen]

    def foreign(unit):
        cell, angles = plan.place(unit)
        n = np.bincount(plan.visits(cell, angles)[1], minlength=k)
        seen = np.flatnonzero(n)
        return seen, np.zeros(len(seen)), n[seen]

    for cell, far, n in _summed(rows, widest, [F.max("value"), F.sum("n")]).collect():  # one row per cell
        plan.radii[cell], plan.home[cell] = far, n
    plan.foreign = np.zeros(k, dtype=np.int64)
    for cell, n in _summed(rows, foreign, [F.sum("n")]).collect():
        plan.foreign[cell] = n
    return plan


def cell_self_join(df: DataFrame, scorer: Scorer, schema: str, cos_min: float, block_rows: int = BLOCK_ROWS,
                   cells: int | None = None) -> DataFrame:
    """Score every unordered pair of rows of *df* (id, text, vec) that can reach *cos_min*, once."""
    rows = cut_lineage(df.where(F.col("text").isNotNull()).select(
        F.col("id").cast("bigint").alias("id"), "text", F.col("vec").cast("array<float>").alias("vec")))
    plan = plan_cells(rows, cos_min, block_rows, cells)
    keyed = "pair bigint, side int, id bigint, text string, grp string, vec array<float>"
    kinds = pa.schema([("pair", pa.int64()), ("side", pa.int32()), ("id", pa.int64()), ("text", pa.string()),
                       ("grp", pa.string()), ("vec", pa.list_(pa.float32()))])

    def send(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, angles = plan.place(unit_vectors(batch.column("vec")))
            for at, group, side in plan.routes(batch.column("id").to_numpy(), cell, angles):
                for start in range(0, len(at), SLICE_ROWS):
                    part = slice(start, start + SLICE_ROWS)
                    taken = batch.take(pa.array(at[part]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(group[part], pa.int64()), pa.array(side[part], pa.int32()), taken.column("id"),
                         taken.column("text"), pa.nulls(taken.num_rows, pa.string()), taken.column("vec").cast(kinds.field("vec").type)],
                        schema=kinds)

    groups = max(1, int(plan.first_group[-1]))
    return _run(rows.mapInArrow(send, keyed), groups, scorer, schema, plan.among_themselves)


# --- nearest rows -------------------------------------------------------------
#
# A row first meets the rows of its own cell. The similarity at which they fill its k places is a floor: what lies below
# can not come in any more. With the floor as its reach it then visits the cells that can hold better ones.

_NEAR_ROW = "pair bigint, side int, id bigint, weight bigint, floor double, vec array<float>"
_NEAR_KINDS = pa.schema([("pair", pa.int64()), ("side", pa.int32()), ("id", pa.int64()), ("weight", pa.int64()),
                         ("floor", pa.float64()), ("vec", pa.list_(pa.float32()))])
FLOOR_SLACK = 1e-9


def _sent(batch: pa.RecordBatch, at, pair, side, floor) -> pa.RecordBatch:
    taken = batch.take(pa.array(at))
    return pa.RecordBatch.from_arrays(
        [pa.array(pair, pa.int64()), pa.array(np.full(len(at), side), pa.int32()), taken.column("id"), taken.column("weight"),
         pa.array(floor[at], pa.float64()), taken.column("vec").cast(_NEAR_KINDS.field("vec").type)], schema=_NEAR_KINDS)


def _arrays(table: pa.Table):
    raw = stored_vectors(table.column("vec"))
    return table.column("id").to_numpy(), table.column("weight").to_numpy(), table.column("floor").to_numpy(), raw, unit_rows(raw)


def _floors(k: int, cos_min: float):
    """Per row of a group, the similarity at which the others of the group fill its *k* places."""
    def score(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        ids, weight, _, _, unit = _arrays(table)
        floor = np.full(len(ids), cos_min)
        step = max(1, CHUNK_CELLS // max(len(ids), 1))
        for start in range(0, len(ids), step):
            rows = np.arange(start, min(start + step, len(ids)))
            cos = unit[rows] @ unit.T
            cos[np.arange(len(rows)), rows] = -2.0  # not itself
            most = min(k, len(ids))
            best = np.argpartition(-cos, most - 1, axis=1)[:, :most]
            value = np.take_along_axis(cos, best, axis=1)
            order = np.argsort(-value, axis=1, kind="stable")
            value, best = np.take_along_axis(value, order, axis=1), np.take_along_axis(best, order, axis=1)
            filled = np.cumsum(np.where(value > -2.0, weight[best], 0), axis=1) >= k
            full = filled.any(axis=1)
            floor[rows[full]] = np.maximum(cos_min, value[full, filled[full].argmax(axis=1)])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(floor - FLOOR_SLACK)], names=["id", "floor"])
    return score


def _nearest(k: int, cos_min: float):
    """(row, other, cos) of the visitors' best rows in a group, until they weigh *k*; ties of the last are kept."""
    kinds = pa.schema([("row", pa.int64()), ("other", pa.int64()), ("cos", pa.float64())])

    def score(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        side = table.column("side").to_numpy()
        visitor = _arrays(table.filter(pa.array(side == 0)))
        ids, weight, _, raw, unit = _arrays(table.filter(pa.array(side == 1)))
        if len(ids) == 0 or len(visitor[0]) == 0:
            return
        square, square_of = squares(raw), squares(visitor[3])
        step = max(1, CHUNK_CELLS // len(ids))
        for start in range(0, len(visitor[0]), step):
            own, floor, mine = visitor[0][start:start + step], visitor[2][start:start + step], visitor[4][start:start + step]
            least = np.maximum(floor, cos_min)
            i, j = np.nonzero((mine @ unit.T >= least[:, None] - FLOOR_SLACK) & (own[:, None] != ids))
            cos = np.concatenate([np.zeros(0)] + [
                cosine_pairs(visitor[3][start + a], square_of[start + a], raw[b], square[b])
                for a, b in ((i[at:at + PAIR_SLICE], j[at:at + PAIR_SLICE]) for at in range(0, len(i), PAIR_SLICE))])
            near = cos >= least[i]
            i, j, cos = i[near], j[near], cos[near]
            value = np.round(cos, 12)
            order = np.lexsort((-value, i))
            i, j, cos, value = i[order], j[order], cos[order], value[order]
            if len(i) == 0:
                continue
            before = np.cumsum(weight[j]) - weight[j]
            first = np.r_[True, i[1:] != i[:-1]]
            level = first | np.r_[True, value[1:] != value[:-1]]
            before -= np.repeat(before[first], np.diff(np.r_[np.flatnonzero(first), len(i)]))
            better = np.repeat(before[level], np.diff(np.r_[np.flatnonzero(level), len(i)]))
            keep = better < k
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[i[keep]]), pa.array(ids[j[keep]]), pa.array(cos[keep])], schema=kinds)
    return score


def nearest_in_cells(df: DataFrame, k: int, cos_min: float, block_rows: int = BLOCK_ROWS,
                     cells: int | None = None) -> DataFrame:
    """(row, other, cos): for every row of *df* (id, vec, weight) at least those others at or above *cos_min* that come
    before *k* rows are reached, an other counting as many rows as its weight. Exact for any cells."""
    rows = cut_lineage(df.select(F.col("id").cast("bigint").alias("id"), F.col("weight").cast("bigint").alias("weight"),
                                 F.lit(cos_min).alias("floor"), F.col("vec").cast("array<float>").alias("vec")))
    plan = plan_cells(rows, cos_min, block_rows, cells)
    first = np.r_[0, np.cumsum(plan.splits)]

    def own(batches):
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("id").to_numpy()
                cell, _ = plan.place(unit_vectors(batch.column("vec")))
                yield _sent(batch, np.arange(len(ids)), first[cell] + plan.split(ids, cell), 0, batch.column("floor").to_numpy())

    groups = max(1, int(first[-1]))
    floors = dealt(rows.mapInArrow(own, _NEAR_ROW), groups).applyInArrow(_floors(k, cos_min), "id bigint, floor double")
    floored = cut_lineage(rows.drop("floor").join(floors, "id").select("id", "weight", "floor", "vec"))

    def visited(batch):
        """(row, cell) of the cells that can hold something better than the floor."""
        floor = batch.column("floor").to_numpy()
        cell, angles = plan.place(unit_vectors(batch.column("vec")))
        reach = np.arccos(np.clip(np.maximum(floor, cos_min), -1.0, 1.0))
        near = (angles <= plan.radii + reach[:, None] + SLACK) & (plan.home > 0)
        return cell, floor, *np.nonzero(near)

    def arrivals(batches):
        for batch in batches:
            if batch.num_rows:
                n = np.bincount(visited(batch)[3], minlength=len(plan.home))
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(n[seen], pa.int64())], names=["cell", "n"])

    coming = np.zeros(len(plan.home), dtype=np.int64)
    for at, n in floored.mapInArrow(arrivals, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n")).collect():
        coming[at] = n
    shifts = np.maximum(1, np.ceil(coming / block_rows).astype(np.int64))
    start = np.r_[0, np.cumsum(plan.splits * shifts)]

    def send(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            cell, floor, row, target = visited(batch)
            at, step = _expanded(shifts[cell])  # where it lives, once for each block of visitors
            pair = start[cell[at]] + plan.split(ids, cell)[at] * shifts[cell[at]] + step
            yield from (_sent(batch, at[s:s + SLICE_ROWS], pair[s:s + SLICE_ROWS], 1, floor) for s in range(0, len(at), SLICE_ROWS))
            copy, step = _expanded(plan.splits[target])
            row, target = row[copy], target[copy]
            pair = start[target] + step * shifts[target] + _dealt(ids, _SHIFT)[row] % shifts[target]
            yield from (_sent(batch, row[s:s + SLICE_ROWS], pair[s:s + SLICE_ROWS], 0, floor) for s in range(0, len(row), SLICE_ROWS))

    keyed = floored.mapInArrow(send, _NEAR_ROW)
    return dealt(keyed, max(1, int(start[-1]))).applyInArrow(_nearest(k, cos_min), "row bigint, other bigint, cos double")
