"""The cell index, nearest rows and class membership against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelweave.functions.similarity import jaro_winkler_arrays
from labelweave.operators import matching as m
from labelweave.operators import model as mo
from labelweave.operators.cells import cell_self_join, nearest_in_cells, plan_cells, spread_pivots

SCHEMA = "row_id bigint, label string, embedding array<float>"


def clusters(n, count=8, dim=6, spread=0.05, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(count, dim))
    return (centres[rng.integers(count, size=n)] + spread * rng.normal(size=(n, dim))).astype(np.float32)


def labelled(vectors, names=7):
    return [(i, f"label {i % names}{'x' * (i % 3)}", [float(x) for x in v]) for i, v in enumerate(vectors)]


def cosines(rows):
    raw = np.array([r[2] for r in rows], dtype=np.float32).astype(np.float64)
    unit = raw / np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-12)
    return unit @ unit.T


def all_pairs(rows, cos_min, jw_min):
    cos = cosines(rows)
    near = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if cos[i, j] >= cos_min]
    jw = jaro_winkler_arrays([rows[i][1] for i, _ in near], [rows[j][1] for _, j in near])
    return {(rows[j][0], rows[i][0]) for (i, j), x in zip(near, jw) if x >= jw_min}


def nearest_pairs(rows, k, cos_min, jw_min):
    cos, out = np.round(cosines(rows), 12), set()
    for i in range(len(rows)):
        order = sorted((j for j in range(len(rows)) if j != i and cos[i, j] >= cos_min), key=lambda j: (-cos[i, j], rows[j][0]))
        out |= {(rows[j][0], rows[i][0]) for j in order[:k - 1] if rows[j][0] > rows[i][0]
                and jaro_winkler_arrays([rows[i][1]], [rows[j][1]])[0] >= jw_min}
    return out


def ids(frame):
    found = [(r.source_id, r.target_id) for r in frame.collect()]
    assert len(found) == len(set(found))
    return set(found)


ROWS = labelled(np.r_[clusters(160), np.random.default_rng(1).normal(size=(30, 6)).astype(np.float32), np.zeros((3, 6), np.float32)])
COPIES = [(500 + i, *ROWS[i % 9][1:]) for i in range(40)] + [(600 + i, *ROWS[-1][1:]) for i in range(3)]


def joined(spark, rows, cos_min, jw_min, block_rows, cells):
    frame = spark.createDataFrame(rows, SCHEMA).select(F.col("row_id").alias("id"), F.col("label").alias("text"),
                                                       F.col("embedding").alias("vec"))
    return cell_self_join(frame, m._both_rules(cos_min, jw_min), m._PAIR_SCHEMA, cos_min, block_rows, cells)


@pytest.mark.parametrize("cos_min", [0.95, 0.3, -0.2])
@pytest.mark.parametrize("block_rows, cells", [(8192, 1), (8192, 12), (7, 5), (13, 40)])
def test_cells_equal_all_pairs(spark, cos_min, block_rows, cells):
    assert ids(joined(spark, ROWS, cos_min, 0.8, block_rows, cells)) == all_pairs(ROWS, cos_min, 0.8)


def test_one_hot_cell_is_split(spark):
    rows = labelled(clusters(150, count=1, spread=0.01))  # every row is near every other
    assert ids(joined(spark, rows, 0.9, 0.9, 20, 3)) == all_pairs(rows, 0.9, 0.9)


def test_clusters_stay_apart(spark):
    n, block = 4000, 100
    rows = labelled(clusters(n, count=40, dim=8, spread=0.01))
    frame = spark.createDataFrame(rows, SCHEMA).select(F.col("row_id").alias("id"), F.col("embedding").alias("vec"))
    told = plan_cells(frame, 0.95, block, 40).report()
    assert told["cells"] == 40 and told["skipped"] > 0.8 * told["cell_pairs"]
    assert told["travelling"] < n * (n // block) / 5  # blocks of that size that all meet would move rows x blocks


def test_pivots_are_far_apart_and_copies_end_the_draw():
    points = np.eye(4)[[0, 0, 1, 2, 0]]
    assert sorted(spread_pivots(points, 4).argmax(axis=1)) == [0, 1, 2]


def test_vectors_of_unequal_length_and_none(spark):
    bad = spark.createDataFrame([(0, "a", [1.0, 0.0]), (1, "b", [1.0])], SCHEMA)
    with pytest.raises(Exception, match="length"):
        m.similar_pairs(bad).collect()
    assert m.similar_pairs(spark.createDataFrame([], SCHEMA)).collect() == []
    assert m.similar_pairs_topk(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("k, cos_min, block_rows, cells", [(2, 0.3, 8192, 6), (5, 0.9, 9, 4), (64, -0.2, 8192, 3), (300, 0.5, 30, 9)])
def test_nearest_count_copies_as_rows(spark, k, cos_min, block_rows, cells):
    rows = ROWS + COPIES
    frame = spark.createDataFrame(rows, SCHEMA)
    found = ids(m.similar_pairs_topk(frame, k=k, cos_min=cos_min, jw_min=0.8, block_rows=block_rows, cells=cells))
    assert found == nearest_pairs(rows, k, cos_min, 0.8)


def test_the_floor_keeps_rows_at_home(spark):
    rows = labelled(clusters(600, count=12, spread=0.02))
    frame = spark.createDataFrame(rows, SCHEMA).select(
        F.col("row_id").alias("id"), F.col("embedding").alias("vec"), F.lit(1).alias("weight"))
    found = nearest_in_cells(frame, 3, 0.1, cells=12).count()
    assert 600 * 3 <= found < 600 * 12  # without a floor every cell would add its best three


def test_classes_hold_every_link(spark):
    rows = ROWS + COPIES
    frame = spark.createDataFrame(rows, SCHEMA)
    classes = {r.row_id: r for r in m.class_table(frame).collect()}
    assert classes[500].representative == 0 and classes[500].copies == 6 and classes[ROWS[-1][0]].zero
    pairs = ids(m.similar_classes(frame, cos_min=0.9, jw_min=0.8))
    linked = {tuple(sorted((classes[a].representative, classes[b].representative))) for a, b in pairs}
    told = set()
    for a in classes.values():
        for b in classes.values():
            same = a.representative == b.representative
            if a.row_id > b.row_id and ((same and not a.zero) or
                                        (not same and tuple(sorted((a.representative, b.representative))) in linked)):
                told.add((a.row_id, b.row_id))
    assert told == all_pairs(rows, 0.9, 0.8)


def test_class_table_with_a_hot_class(spark):
    rows = [(i, "same", [1.0, 2.0]) for i in range(50)] + [(60, "other", [1.0, 2.0]), (61, "same", [2.0, 1.0])]
    found = m.class_table(spark.createDataFrame(rows, SCHEMA), hot_rows=10).collect()
    assert {(r.representative, r.copies) for r in found if r.row_id < 50} == {(0, 50)}
    assert {(r.row_id, r.representative, r.copies) for r in found if r.row_id >= 50} == {(60, 60, 1), (61, 61, 1)}


def test_copies_of_merges_are_no_negatives(spark):
    rows = ROWS[:40] + COPIES
    frame = spark.createDataFrame(rows, SCHEMA)
    merges = all_pairs(rows, 0.9, 0.8)
    every = spark.createDataFrame([(a[0], b[0]) for a in rows for b in rows], "i bigint, j bigint")
    pairs, classes = m.similar_classes(frame, cos_min=0.9, jw_min=0.8), m.class_table(frame)
    left = {(r.j, r.i) for r in mo.negative_candidates(every, pairs, classes).collect()}
    assert left == {(a[0], b[0]) for a in rows for b in rows if a[0] > b[0]} - merges
    drawn = {(r.j, r.i) for r in mo.sample_negatives(frame, pairs, 10_000, classes=classes).collect()}
    assert drawn == left
