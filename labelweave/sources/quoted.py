"""Delimited files with line breaks inside quotes, read in splits.

Where a record ends depends on every quote before it, so a split can not be parsed on its own. But a split is a map: entered
outside or inside quotes, it is left outside or inside. A first scan takes this map of every split (and how many records
start in it, for either entry); a window over one row per split composes the maps from the start of the file, and a second
scan cuts the lines into records from known states. A record that goes on over the end of a split is put together from its
pieces in a shuffle that carries those pieces only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelweave.session import cut_lineage

_CLOSING = re.compile(r'(?:[^"]|"")*+"')  # from inside quotes to the quote that ends them

WHOLE, HEAD, TAIL = 0, 1, 2  # records of one split; the first piece of a longer record; its further pieces


def quote_state(sep: str) -> Callable[[str, bool], bool]:
    """Whether a line that starts outside or inside quotes ends inside them. A quote opens a field only as its first
    character; two within quotes are one quote; what follows a closing quote up to the delimiter is plain."""
    def after(line: str, inside: bool) -> bool:
        if '"' not in line:
            return inside
        at = 0
        while True:
            if inside or line.startswith('"', at):
                closing = _CLOSING.match(line, at if inside else at + 1)
                if closing is None:
                    return True
                inside, at = False, closing.end()
            at = line.find(sep, at)
            if at < 0:
                return False
            at += len(sep)
    return after


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(first of its split, file, start, entry, line) in order; *entry* is None without an ``inside`` column."""
    last = None
    for batch in batches:
        files, starts = batch.column("_file").to_pylist(), batch.column("_start").to_pylist()
        entry = batch.column("inside").to_pylist() if "inside" in batch.schema.names else [None] * batch.num_rows
        for file, start, inside, line in zip(files, starts, entry, batch.column("value").to_pylist()):
            split = (file, start)
            yield split != last, file, start, inside, line[:-1] if line.endswith("\r") else line
            last = split


def _split_maps(sep: str):
    """One row per split: the state it leaves and the records that start in it, entered outside and inside."""
    after = quote_state(sep)
    kinds = pa.schema([("_file", pa.string()), ("_start", pa.int64()), ("out0", pa.bool_()), ("out1", pa.bool_()),
                       ("rows0", pa.int64()), ("rows1", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, rows = None, None, None
        for new, file, start, _, line in _lines(batches):
            if new:
                if key is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, *state, *rows)], schema=kinds)
                key, state, rows = (file, start), [False, True], [0, 0]
            for entered in (0, 1):
                rows[entered] += not state[entered] and line != ""
            left = after(line, state[0])
            state = [left, left if state[0] == state[1] else after(line, state[1])]
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, *state, *rows)], schema=kinds)
    return run


def _entries(maps: DataFrame) -> DataFrame:
    """Per split: whether it is entered inside quotes, the split whose open record it goes on with, and its first number.

    A map of two states is constant, the identity or a swap, so the state on entry is the last constant before, turned by
    the swaps since. Windows run over one row per split.
    """
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum(F.expr("CASE WHEN out0 AND NOT out1 THEN 1 ELSE 0 END")).over(
        Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, 0))
    counted = maps.withColumn("swaps", swaps)
    fixed = F.last(F.when(F.col("out0") == F.col("out1"), F.struct(F.col("out0").alias("to"), "swaps")), True).over(before)
    turned = (F.coalesce(F.lag("swaps").over(Window.partitionBy("_file").orderBy("_start")), F.lit(0))
              - F.coalesce(fixed["swaps"], F.lit(0))) % 2 == 1
    known = counted.withColumn("inside", F.coalesce(fixed["to"], F.lit(False)) != turned)
    known = known.withColumn("rows", F.when(F.col("inside"), F.col("rows1")).otherwise(F.col("rows0")))
    opens = F.when(F.when(F.col("inside"), F.col("out1")).otherwise(F.col("out0")) & (F.col("rows") > 0), F.col("_start"))
    order = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    return known.withColumn("opens", opens).select(
        "_file", "_start", "inside", F.last("opens", True).over(before).alias("owner"),
        F.coalesce(F.sum("rows").over(order), F.lit(0)).alias("offset"))


_PIECES = "_file string, _start bigint, kind int, pos bigint, record string"


def _pieces(sep: str, kinds_wanted: tuple[int, ...]):
    """(file, split, kind, position in the split, text) of the records and pieces of records in each split."""
    after = quote_state(sep)
    schema = pa.schema([("_file", pa.string()), ("_start", pa.int64()), ("kind", pa.int32()), ("pos", pa.int64()),
                        ("record", pa.string())])
    size = 2_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            key, state, pos, lines, kind = None, False, -1, [], WHOLE
            for new, file, start, entry, line in _lines(batches):
                if new:
                    if lines:  # the split before ended inside a record
                        yield (*key, TAIL if kind == TAIL else HEAD, pos, "\n".join(lines))
                    key, state, pos, lines = (file, start), entry, -1, []
                    kind = TAIL if entry else WHOLE
                elif not state:
                    kind = WHOLE
                if not state and line == "":
                    continue  # an empty line is no record
                if not state:
                    pos += 1
                lines.append(line)
                state = after(line, state)
                if not state:
                    yield (*key, kind, pos, "\n".join(lines))
                    lines = []
            if lines:
                yield (*key, TAIL if kind == TAIL else HEAD, pos, "\n".join(lines))

        held = []
        for row in records():
            if row[2] in kinds_wanted:
                held.append(row)
            if len(held) == size:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
    return run


def read_quoted(spark: SparkSession, path: str, sep: str, row_ids: bool = True) -> DataFrame:
    """(row_id, columns of the header): every column a string, in as many tasks as the input has splits.

    Lines end in a line feed, with or without a carriage return before it; empty lines are no records; the first record of
    every file is its header. Ids are dense by file and position.
    """
    options = {"sep": sep, "quote": '"', "escape": '"'}
    names = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, **options).columns
    names = [*names[:-1], names[-1].removesuffix("\r")] if names else names  # a break within the header hides the line ending
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
    maps = lines.mapInArrow(_split_maps(sep), "_file string, _start bigint, out0 boolean, out1 boolean, rows0 bigint, rows1 bigint")
    entries = cut_lineage(_entries(maps))
    # one row of a few numbers per split: 800,000 for 100 TB in splits of 128 MB; a broadcast keeps the lines in order
    known = lines.join(F.broadcast(entries.select("_file", "_start", "inside")), ["_file", "_start"])
    whole = known.mapInArrow(_pieces(sep, (WHOLE,)), _PIECES).select("_file", "_start", "pos", "record")
    if not entries.where("inside").isEmpty():
        whole = whole.unionByName(_joined(known.mapInArrow(_pieces(sep, (HEAD, TAIL)), _PIECES), entries))
    else:  # only a file that ends inside quotes has an open record
        heads = known.mapInArrow(_pieces(sep, (HEAD,)), _PIECES)
        whole = whole.unionByName(heads.select("_file", "_start", "pos", "record"))
    numbered = whole.join(F.broadcast(entries.select("_file", "_start", "offset")), ["_file", "_start"])
    begin = entries.groupBy("_file").agg(F.min("offset").alias("_begin"))
    rank = F.row_number().over(Window.orderBy("_begin")).cast("bigint")  # one row per file: as many headers are left out
    numbered = numbered.join(F.broadcast(begin.withColumn("_headers", rank)), "_file")
    at = F.col("offset") + F.col("pos")
    parsed = numbered.where(at > F.col("_begin")).select((at - F.col("_headers")).alias("_id"), _fields("record", names, options))
    cells = [F.col("_r")[f"_{i}"].alias(name) for i, name in enumerate(names)]
    return parsed.select(F.col("_id").alias("row_id"), *cells) if row_ids else parsed.select(*cells)


def _joined(pieces: DataFrame, entries: DataFrame) -> DataFrame:
    """Records that span splits: the pieces of each, gathered at the split in which it starts."""
    owned = pieces.join(F.broadcast(entries.select("_file", "_start", "owner")), ["_file", "_start"])
    home = F.when(F.col("kind") == HEAD, F.col("_start")).otherwise(F.col("owner"))
    parts = F.sort_array(F.collect_list(F.struct("_start", "record")))  # the pieces of one record
    return (owned.groupBy("_file", home.alias("_home"))
            .agg(F.max(F.when(F.col("kind") == HEAD, F.col("pos"))).alias("pos"), parts.alias("parts"))
            .select("_file", F.col("_home").alias("_start"), "pos", F.concat_ws("\n", "parts.record").alias("record")))


def _fields(record: str, names: list[str], options: dict) -> Column:
    return F.from_csv(record, ", ".join(f"_{i} string" for i in range(len(names))), options).alias("_r")
