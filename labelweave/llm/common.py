"""Helpers the operators share: texts in batches, words, held-out rows, lineage cuts, vocabulary files."""

from __future__ import annotations

import re
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from labelweave.session import _checkpoint_dir, cut_lineage

#: Rows per Arrow batch: long texts must not add up to more than a worker can hold.
BATCH_ROWS = 512

#: Fixed by the contracts: a word is a run without ASCII white space.
WORD = re.compile("[^\x20\x09-\x0D]+")
WORD_GAP = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Batch = dict[str, list]


def map_batches(df: DataFrame, work: Callable[[Iterator[Batch]], Iterator[Batch]], schema: str) -> DataFrame:
    """Run *work* over the batches of each partition; columns come and go as Python lists."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        lists = ({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches if b.num_rows)
        for out in work(lists):
            yield pa.RecordBatch.from_pydict(out, schema=target)

    return df.mapInArrow(run, schema)


def kept_in_worker(key, build):
    """*build()* once per Python worker; workers outlive tasks, pickled globals do not.

    A worker keeps one thing: what another operator has left there goes first.
    """
    home = sys.modules.setdefault("_labelweave_kept", types.ModuleType("_labelweave_kept"))
    if home.__dict__.get("key") != key:
        home.key, home.thing = None, None
        home.thing = build()
        home.key = key
    return home.thing


def vocabulary_bytes(path_or_name: str) -> bytes:
    """The bytes of a vocabulary file (1 to 2 MB), read on the driver and sent along with the tasks."""
    path = path_or_name if "/" in path_or_name else public_tokenizers.path(path_or_name)
    with open(path, "rb") as f:
        return f.read()


def ascii_lower(text: str) -> str:
    """Lower-case A-Z and nothing else."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def ascii_lower_column(text: Column) -> Column:
    """As ascii_lower. A text of ASCII only takes Spark's fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves *remainder*; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/documents.parquet")


def stored(df: DataFrame) -> DataFrame:
    """*df* written once to the shared checkpoint folder, so that a lost executor costs no recomputation."""
    return cut_lineage(df)


def written(df: DataFrame) -> DataFrame:
    """As stored(), but as a compressed Parquet table in that folder: for wide rows that are read several times."""
    folder = f"{_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def sized(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """*df* (stored, short rows) hinted for broadcast if it has at most *rows* rows; else Spark's own choice."""
    return F.broadcast(df) if df.count() <= rows else df


def with_row(docs: DataFrame) -> DataFrame:
    """(row, all), stored: the rows of *docs* as structs, each under a number of its own, which stays the same when read again."""
    return written(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("all")))


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, text), stored: ids may be null or shared, the number of a row is not."""
    return written(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                               F.col(text_col).alias("text")))


def looked_up_by(rows: DataFrame, table: DataFrame, key: str, hot: int = 500) -> DataFrame:
    """*rows* with the other columns of *table* (key, times, ...), which has one row for every key and is stored.

    Keys of *hot* rows and more, by *times*, are at most rows / hot many; they are matched apart, by a broadcast up to
    the size that sized() allows, so that no task has to hold the rows of one key.
    """
    frequent = sized(stored(table.filter(F.col("times") >= hot).drop("times")))
    rest = rows.join(frequent.select(key), key, "left_anti")
    return (rows.join(frequent, key)
            .unionByName(rest.join(table.filter(F.col("times") < hot).drop("times"), key)))
