"""Exact selection, dense positions and sheet names on skewed inputs."""

import pytest
from pyspark.sql import functions as F

from labelweave.operators import model as mo
from labelweave.operators import themes as th
from labelweave.sources.readers import read_sheets
from labelweave.sources.writers import write_sheets


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.5, 1.0])
def test_split_is_the_same_however_far_it_is_refined(spark, fraction):
    rows = [(i, i + 1, None if i % 97 == 0 else int(i % 5 == 0)) for i in range(2000)] + [(9, 9, 7)] * 30
    frame = spark.createDataFrame(rows, "i long, j long, label int")
    wide = sorted(map(repr, mo.stratified_split(frame, fraction).collect()))
    fine = sorted(map(repr, mo.stratified_split(frame, fraction, small=3).collect()))
    sizes = {r["label"]: r for r in mo.stratified_split(frame, fraction, small=3).groupBy("label").agg(
        F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("tests")).collect()}
    assert wide == fine and len(wide) == 2030
    assert all(r["tests"] == int(r["n"] * fraction + 0.5) for r in sizes.values())
    assert mo.stratified_split(frame.where("false"), fraction).collect() == []


def test_positions_with_one_outlying_id(spark):
    ids = [7 * i for i in range(5000)] + [10 ** 15]
    frame = spark.createDataFrame([(i,) for i in ids], "row_id long")
    found = sorted((r.position, r.row_id) for r in mo._positions(frame).collect())
    assert found == list(enumerate(ids))


def test_names_with_one_key_are_different_sheets(spark, folder):
    long = "a very long name of a theme indeed"
    names = [long + " one", long + " two", long + " three", "short", "short!", "short?", "!!", "??", None]
    frame = spark.createDataFrame([(i, name) for i, name in enumerate(names) for _ in range(2)], "n int, theme string")
    write_sheets(frame, folder + "/out", "theme", [F.col("n")])
    rows = read_sheets(spark, folder + "/out").collect()
    assert len(rows) == 2 * len(names)
    keys = {r["theme"]: r["sheet_key"] for r in rows}
    assert len(set(keys.values())) == len(names) and all(len(key) <= 31 for key in keys.values())
    assert keys["short"] == "short"
    for name in names:
        assert {r["n"] for r in read_sheets(spark, folder + "/out", keys[name]).collect()} == {names.index(name)}


def test_a_row_without_a_vector_stops_the_clustering(spark):
    rows = [(i, f"l{i}", [float(i), 1.0] if i else None) for i in range(20)]
    with pytest.raises(Exception, match="aligned"):
        th.cluster_themes(spark.createDataFrame(rows, "row_id long, label string, embedding array<float>"), 3).collect()
