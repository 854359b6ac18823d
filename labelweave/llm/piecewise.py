"""Context-triggered piecewise hashing: fingerprints that stay alike where texts do.

A rolling hash over the last seven characters decides where a chunk ends, so an edit moves the chunks beside it only.
Every chunk is hashed to two letters; the letters of all chunks are the signature. The block size, how many characters
a chunk has on average, follows from the length of the text; a fingerprint holds the signatures at that size and at its
double, so that texts whose lengths differ by less than a factor of two can be compared. Likeness is one less the edit
distance of two signatures (chunks put in or taken out) over the chunks of both.

Whole texts are read; nothing is cut to a length. A null text counts as empty; the fingerprint of an empty text has no
chunks, is like itself and unlike all others.

`edited_fingerprints` lets every row meet the next one by descending id (null ids last, ties by the text's hash): rows
are range-partitioned and sorted once, each task reads its rows in order, and only the first and last rows of the tasks
are put together afterwards. Rows with the same id and text are interchangeable. One row is its own next row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Batch, map_batches, stored

WINDOW = 7          # characters the rolling hash sees
SMALLEST_BLOCK = 3
CHUNKS = 64         # chunks a signature has at most on average
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
REPEATS = 3         # further equal chunks in a row say nothing more

_FACTOR = np.uint64(0x9E3779B97F4A7C15)          # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_PIECES = np.array([a + b for a in LETTERS for b in LETTERS], dtype=object)


def block_size(length: int) -> int:
    size = SMALLEST_BLOCK
    while size * CHUNKS < length:
        size *= 2
    return size


def rolling(codes: np.ndarray) -> np.ndarray:
    """At each character, the hash of it and the six before: their sum, their weighted sum and a shifted xor of them."""
    total = np.zeros(len(codes), dtype=np.uint32)
    weighted, mixed = total.copy(), total.copy()
    for back in range(min(WINDOW, len(codes))):
        seen = codes[:len(codes) - back]
        total[back:] += seen
        weighted[back:] += seen * np.uint32(WINDOW - back)
        mixed[back:] ^= seen << np.uint32(5 * back)
    return total + weighted + mixed


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def signature(hashes: np.ndarray, sums: np.ndarray, back: np.ndarray, size: int) -> str:
    """Two letters per chunk; chunks end where the rolling hash leaves size - 1, and at the end of the text."""
    n = len(hashes)
    if n == 0:
        return ""
    ends = np.flatnonzero(hashes % np.uint32(size) == size - 1) + 1
    if len(ends) == 0 or ends[-1] != n:
        ends = np.append(ends, n)
    starts = np.r_[0, ends[:-1]]
    chunk = (sums[ends] - sums[starts]) * back[starts]  # a polynomial of the chunk's characters, wherever it stands
    chunk = (chunk ^ (chunk >> np.uint64(29))) * _MIX >> np.uint64(52)
    if len(chunk) > REPEATS:
        same = np.ones(len(chunk), dtype=bool)
        same[:REPEATS] = False
        for step in range(1, REPEATS + 1):
            same[step:] &= chunk[step:] == chunk[:-step]
        chunk = chunk[~same]
    return "".join(_PIECES[chunk.astype(np.int64)])


def fingerprint(text: str) -> str:
    """`block size:signature:signature at twice the block size`."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = block_size(len(codes))
    hashes = rolling(codes)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(_FACTOR, len(codes)), out=sums[1:])
    back = powers(_INVERSE, len(codes))
    return f"{size}:{signature(hashes, sums, back, size)}:{signature(hashes, sums, back, 2 * size)}"


def common_chunks(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, all places of *a* at a time in the bits of one number."""
    where: dict[str, int] = {}
    for at, chunk in enumerate(a):
        where[chunk] = where.get(chunk, 0) | 1 << at
    full = (1 << len(a)) - 1
    row = full
    for chunk in b:
        met = where.get(chunk)
        if met:
            hit = row & met
            row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    first, second = ([x[at:at + 2] for at in range(0, len(x), 2)] for x in (a, b))
    distance = len(first) + len(second) - 2 * common_chunks(first, second)
    return 1.0 - distance / (len(first) + len(second))


def likeness(a: str, b: str) -> float:
    """0 to 1: equal fingerprints 1, those without a common block size 0."""
    if a == b:
        return 1.0
    size_a, *signs_a = a.split(":")
    size_b, *signs_b = b.split(":")
    at_a = {int(size_a) * 2 ** at: sign for at, sign in enumerate(signs_a)}
    at_b = {int(size_b) * 2 ** at: sign for at, sign in enumerate(signs_b)}
    return max((_alike(at_a[size], at_b[size]) for size in at_a.keys() & at_b.keys()), default=0.0)


def edited_text(text: str, following: str) -> str:
    """*text* with its last third replaced by as many first characters of *following*, or all it has."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def compared(text: str, mark: str, following: str, following_mark: str) -> dict:
    edited = edited_text(text, following)
    edited_mark = fingerprint(edited)
    return {"edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "edited_fingerprint": edited_mark, "near_edited": likeness(mark, edited_mark),
            "near_next": likeness(mark, following_mark)}


_ROW = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _in_order(batches: Iterator[Batch]) -> Iterator[Batch]:
    """Rows of a task in order, each compared with the one after it. The first row's text and the last row, which still
    lacks its next one, are handed on: at most two texts a task."""
    names = [field.split(" ")[0] for field in _ROW.split(", ")] + ["first", "open", "part", "text"]
    empty = dict.fromkeys(names)
    held = None
    for batch in batches:
        out = {name: [] for name in names}
        for doc_id, part, text in zip(batch["doc_id"], batch["part"], batch["text"]):
            text = text or ""
            mark = fingerprint(text)
            if held is None:
                rows = [empty | {"first": True, "open": False, "part": part, "text": text, "fingerprint": mark}]
            else:
                before_id, before, before_mark = held
                rows = [empty | {"doc_id": before_id, "n_chars": len(before), "fingerprint": before_mark, "first": False,
                                 "open": False, "part": part} | compared(before, before_mark, text, mark)]
            held = doc_id, text, mark
            for row in rows:
                for name in names:
                    out[name].append(row[name])
        last_part = batch["part"][-1]
        yield out
    if held is not None:
        doc_id, text, mark = held
        row = empty | {"doc_id": doc_id, "n_chars": len(text), "fingerprint": mark, "first": False, "open": True,
                       "part": last_part, "text": text}
        yield {name: [row[name]] for name in names}


def _closed(batches: Iterator[Batch]) -> Iterator[Batch]:
    names = [field.split(" ")[0] for field in _ROW.split(", ")]
    for batch in batches:
        out = {name: [] for name in names}
        for doc_id, text, mark, following, following_mark in zip(*(batch[name] for name in (
                "doc_id", "text", "fingerprint", "following", "following_mark"))):
            row = {"doc_id": doc_id, "n_chars": len(text), "fingerprint": mark} | compared(
                text, mark, following, following_mark)
            for name in names:
                out[name].append(row[name])
        yield out


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row its fingerprint, that of its edited text, and its likeness to this and to the next row's."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash"), F.col("tie")]
    laid = (rows.withColumn("hash", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .select("doc_id", "text", F.spark_partition_id().alias("part")))
    done = stored(map_batches(laid, _in_order, _ROW + ", first boolean, open boolean, part int, text string"))
    firsts = done.where("first").select("part", F.col("text").alias("following"), F.col("fingerprint").alias("following_mark"))
    # two rows per task, by number; the texts follow when it is known which belong together
    parts = firsts.select("part")
    ring = Window.orderBy("part")
    after = parts.select("part", F.coalesce(F.lead("part").over(ring), F.first("part").over(ring)).alias("next_part"))
    ends = done.where("open").select("doc_id", "text", "fingerprint", "part").join(after, "part").join(
        firsts.withColumnRenamed("part", "next_part"), "next_part")
    columns = [field.split(" ")[0] for field in _ROW.split(", ")]
    return done.where("NOT first AND NOT open").select(*columns).unionByName(
        map_batches(ends.select("doc_id", "text", "fingerprint", "following", "following_mark"), _closed, _ROW))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    def work(batches):
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "fingerprint": [fingerprint(text or "") for text in batch["text"]]}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work,
                       "doc_id long, fingerprint string")
