"""Quoted records read in splits: what the whole-file reader gives, whatever the splits."""

import random

import pytest

from labelweave.sources.quoted import quote_state
from labelweave.sources.readers import read_records


def field(rng):
    kind = rng.random()
    if kind < 0.35:
        return rng.choice(["a", "", "b c", "12", "été", "x" * rng.randint(1, 40)])
    inner = "".join(rng.choice(["a", ",", "\n", '""', " ", "é", "\n\n", "zz"]) for _ in range(rng.randint(0, 12)))
    return f'"{inner}"'


def content(seed, rows, end="\n"):
    rng = random.Random(seed)
    body = [",".join([f"r{i}"] + [field(rng) for _ in range(3)]) for i in range(rows)]
    return end.join(['id,"first\ncol",b,c', *body]) + end


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    for k, v in old.items():
        spark.conf.set(k, v)


def plain(spark, path, sep=","):
    rows = spark.read.csv(str(path), sep=sep, header=True, quote='"', escape='"', multiLine=True)
    return rows.columns, [tuple(r) for r in rows.collect()]


@pytest.mark.parametrize("size", [97, 400, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_in_order_for_any_split_size(spark, tmp_path, small_splits, size, end):
    path = tmp_path / "r.csv"
    path.write_text(content(size, 120))
    names, want = plain(spark, path)
    path.write_bytes(content(size, 120, end).encode())  # breaks within quotes stay line feeds
    small_splits(size)
    got = read_records(spark, str(path)).orderBy("row_id")
    rows = got.collect()
    assert got.columns == ["row_id", *names]
    assert [r[0] for r in rows] == list(range(len(want)))
    assert [tuple(r)[1:] for r in rows] == want


def test_one_record_over_many_splits_and_many_tasks(spark, tmp_path, small_splits):
    path = tmp_path / "long.csv"
    text = "\n".join(f"line {i}, with \"\"quotes\"\"" for i in range(400))
    path.write_text(f'id,t\n1,x\n2,"{text}"\n3,"end\nof"\n' + "".join(f"{i},y\n" for i in range(4, 300)))
    names, want = plain(spark, path)
    small_splits(256)
    got = read_records(spark, str(path))
    assert got.rdd.getNumPartitions() > 20
    assert [tuple(r)[1:] for r in got.orderBy("row_id").collect()] == want


def test_several_files_each_with_a_header(spark, tmp_path, small_splits):
    for i in range(4):
        (tmp_path / f"p{i}.csv").write_text(content(i, 15))
    small_splits(150)
    got = read_records(spark, str(tmp_path)).orderBy("row_id").collect()
    want = [row for i in range(4) for row in plain(spark, tmp_path / f"p{i}.csv")[1]]
    assert [r.row_id for r in got] == list(range(60)) and [tuple(r)[1:] for r in got] == want


@pytest.mark.parametrize("text", [
    "a,b\n", "a,b", 'a,b\n1,x"y\n2,"z\nw"\n', 'a,b\n"1"x,2\n"3" ,4\n', 'a,b\n\n1,2\n\n\n3,"\n"\n', 'a\tb\n1\t"x\ty\nz"\n',
    'a,b\n1\n1,2,3\n', 'a,b\n1,""\n2,\n', 'a.x,a`y\n1,2\n'])
def test_odd_files_read_as_by_the_whole_file_reader(spark, tmp_path, small_splits, text):
    path = tmp_path / "odd.csv"
    path.write_text(text)
    names, want = plain(spark, path, "\t" if "\t" in text else ",")
    small_splits(5)
    got = read_records(spark, str(path)).orderBy("row_id")
    assert got.columns[1:] == names and [tuple(r)[1:] for r in got.collect()] == want


def test_state_of_a_line():
    after = quote_state(",")
    assert not after("a,b", False) and after("a,b", True)
    assert after('a,"b', False) and not after('b",c', True) and after('b","c', True)
    assert not after('a"b', False) and not after('"a""b"', False) and after('"a""', False) and after('a""', True)
