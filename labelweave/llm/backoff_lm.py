"""Language-model scores by weighted backoff: a stored table of what each n-gram adds to a text, its frequent part broadcast."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCH_ROWS, WORD, ascii_lower, held_out, written

#: Additive smoothing of the base distribution (fixed by the contract).
ADD = 0.1
#: An n-gram is part of the model from this count up, whatever the size of the corpus.
LEAST = 2
#: Words and n-grams of at least this share of all training tokens go with the tasks, so that no join has a hot key.
#: Shares add up to 1, so there are at most 1 / share of them for each order. They do not bound the model.
WORD_SHARE, GRAM_SHARE = 1e-6, 1e-6
#: Absolute discount of the counts of n-grams.
DISCOUNT = 0.5
END = ""  # no word is empty, so the end of a text can stand as the empty string
#: Occurrences that a task adds up before it hands them on, and entries of a bucket.
HELD = 2_000_000
#: Bytes of text that are cut into words at a time (one text at least).
CHUNK_BYTES = 4_000_000
#: 2-grams are counted, and 3-grams counted and open n-grams looked up, in so many rounds over the texts, by hashes: what
#: a round shuffles is gone before the next one starts. The numbers do not change any result.
PAIR_ROUNDS, ROUNDS = 2, 4


def tokens(text: str | None) -> list[str]:
    """Lower-cased words and one end."""
    found = WORD.findall(ascii_lower(text or ""))
    found.append(END)
    return found


# --- words and n-grams as numbers --------------------------------------------
#
# The number of a word mixes its length and its bytes, eight at a time; that of an n-gram mixes those of the two shorter
# ones in it.

_STEP, _MIX1, _MIX2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_END_HASH = np.uint64(0x2545F4914F6CDD1D)
#: A-Z as a-z, white space as blanks.
_PLAIN = bytes(0x20 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
LONG_WORD = 256  # bytes from which a word is hashed by itself


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(33))) * _MIX2
    return x ^ (x >> np.uint64(33))


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The number of each 2-gram of two words, or of each 3-gram of the two 2-grams in it."""
    return _mixed(first * _STEP + second)


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, text) of every token of some texts, their ends among them; text i is data[offsets[i]:offsets[i + 1]]."""
    n = len(offsets) - 1
    plain = data.tobytes().translate(_PLAIN)
    inside = np.frombuffer(plain, dtype=np.uint8) != 0x20
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    first[heads], last[tails] = inside[heads], inside[tails]  # a word does not reach into the next text
    start = np.flatnonzero(first)
    left = np.flatnonzero(last) + 1 - start
    text = np.searchsorted(start, offsets)  # words before each text
    sizes = np.diff(text)
    words = left.astype(np.uint64)
    eights = np.ndarray((len(plain) + 1,), dtype="<u8", buffer=plain + bytes(8), strides=(1,))
    long = np.flatnonzero(left > LONG_WORD)
    for i in long:
        words[i] = xxhash.xxh64_intdigest(plain[start[i]:start[i] + left[i]])
    at = np.flatnonzero(left <= LONG_WORD) if len(long) else slice(None)
    start, left = start[at], left[at]
    while len(start):
        words[at] = _mixed(words[at] * _STEP + (eights[start] & _FIRST_BYTES[np.minimum(left, 8)]))
        more = np.flatnonzero(left > 8)
        at = more if isinstance(at, slice) else at[more]
        start, left = start[more] + 8, left[more] - 8
    of_word, of_text = np.repeat(np.arange(n), sizes), np.arange(n)
    out = np.full(len(words) + n, _END_HASH)
    out[np.arange(len(words)) + of_word] = words
    return out, np.repeat(of_text, sizes + 1)


def texts_in_chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of the column *text* in chunks of bounded size; null is empty."""
    column = batch.column("text").fill_null("").cast(pa.large_string())
    _, places, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(places, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def _columns(schema: str, **values: np.ndarray) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "double": pa.float64()}
    fields = [pair.split() for pair in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(values[name].view(np.int64) if values[name].dtype == np.uint64 else values[name], kinds[kind])
         for name, kind in fields], names=[name for name, _ in fields])


def _in_arrow(df: DataFrame, work, schema: str) -> DataFrame:
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(work, schema)


# --- counts -------------------------------------------------------------------
#
# Rows of single n-grams would cost more than the work on them. Tasks send blocks instead: the n-grams of many texts that
# fall into one bucket, as arrays. Buckets are ranges of hashes, as many as keep what one holds bounded.

_BLOCK = "bucket int, kind int, block binary"


def bucket_count(spark: SparkSession, entries: float) -> int:
    return max(2 * spark.sparkContext.defaultParallelism, math.ceil(entries / HELD))


def blocks(keys: np.ndarray, buckets: int, kind: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per bucket of *keys* with what the columns have there, one after the other; the order in a bucket is kept."""
    bucket = ((keys.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16 if buckets <= 65536 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    columns = [c[order] for c in columns]
    seen = [(i, start, end) for i, (start, end) in enumerate(zip([0, *ends[:-1]], ends)) if start < end]
    for i in range(0, len(seen), 64):
        part = seen[i:i + 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in part], pa.int32()), pa.array([kind] * len(part), pa.int32()),
             pa.array([b"".join(c[start:end].tobytes() for c in columns) for _, start, end in part], pa.binary())],
            names=["bucket", "kind", "block"])


def columns_of(block: pa.Scalar, *kinds: str) -> list[np.ndarray]:
    data = block.as_buffer()
    n = data.size // sum(np.dtype(k).itemsize for k in kinds)
    found, at = [], 0
    for k in kinds:
        found.append(np.frombuffer(data, dtype=k, count=n, offset=at))
        at += n * np.dtype(k).itemsize
    return found


def by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.repartitionById(buckets, F.col("bucket"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, n) of all tokens of *docs* (text), pre-aggregated in each task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(batches, lambda w, text: (w,)):
            h, n = np.unique(held[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    return _in_arrow(docs.select("text"), work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _held(batches: Iterator[pa.RecordBatch], parts) -> Iterator[list[np.ndarray]]:
    """What *parts* finds in tokens and texts, HELD entries or a little more at a time."""
    held: list[tuple] = []
    for batch in batches:
        for _, _, data, offsets in texts_in_chunks(batch):
            held.append(parts(*token_hashes(data, offsets)))
            if sum(len(h[0]) for h in held) >= HELD:
                yield [np.concatenate(x) for x in zip(*held)]
                held.clear()
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _sums(a: np.ndarray, b: np.ndarray, n: np.ndarray | None):
    """(key, a, b, n) of distinct n-grams, by key."""
    key = pair_keys(a, b)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[len(key) > 0, key[1:] != key[:-1]][:len(key)])
    total = np.diff(np.r_[first, len(key)]) if n is None else np.add.reduceat(n[order], first) if len(first) else n
    return key[first], a[order[first]], b[order[first]], total


def gram_counts(docs: DataFrame, size: int, part: int, rounds: int, buckets: int, least: float) -> DataFrame:
    """(a, b, k, n) of the n-grams that occur *least* times and whose a falls into round *part* of *rounds*: a, b are the
    words of a 2-gram, the 2-grams of a 3-gram."""
    def parts(w, text):
        if size == 3:
            w = pair_keys(w[:-1], w[1:])
        # n-grams do not reach into the next text
        taken = (text[size - 1:] == text[:len(text) - size + 1]) & (w[:-1].view(np.int64) % np.int64(rounds) == part)
        return w[:-1][taken], w[1:][taken]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(batches, parts):
            key, a, b, n = _sums(*held, None)
            yield from blocks(key, buckets, 0, a, b, n.astype(np.int64))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [columns_of(block, "u8", "u8", "i8") for batch in batches for block in batch.column("block")]
        if held:
            key, a, b, n = _sums(*(np.concatenate(x) for x in zip(*held)))
            kept = n >= least
            yield _columns("a long, b long, k long, n long", a=a[kept], b=b[kept], k=key[kept], n=n[kept])

    sent = _in_arrow(docs.select("text"), send, _BLOCK)
    return by_bucket(sent, buckets).mapInArrow(add, "a long, b long, k long, n long")


def looked_up(rows: DataFrame, needed: Column, table: DataFrame, keys: str, value: str) -> DataFrame:
    """*rows* with *value* of *table* (keys, value), null where it has no such row or nothing is *needed*.

    Rows that need nothing are spread over the shuffle by a hash of all they hold.
    """
    side = table.select(*(F.col(k).alias(f"_{k}") for k in keys), F.lit(True).alias("_found"), value)
    spread = F.when(needed, F.col(keys[0])).otherwise(F.xxhash64(*rows.columns))
    asking = rows.withColumn("_asked", F.coalesce(needed, F.lit(False))).withColumn("_first", spread)
    match = (F.col("_first") == F.col(f"_{keys[0]}")) & (F.col("_asked") == F.col("_found"))
    for k in keys[1:]:
        match &= F.col(k) == F.col(f"_{k}")
    return asking.join(side, match, "left").select(*rows.columns, value)


def of_word(grams: DataFrame, words: DataFrame, often: Column, name: str, value: str, out: str) -> DataFrame:
    """*grams* with *value* of the word in column *name*: of frequent words by broadcast, of others by join."""
    few = words.filter(often).select(F.col("h").alias(name), F.col(value).alias("_few"))  # <= 1 / WORD_SHARE
    some = words.filter(~often).select(F.col("h").alias(name), F.col(value).alias("_some"))
    known = grams.join(F.broadcast(few), name, "left")
    both = looked_up(known, F.col("_few").isNull(), some, name, "_some")
    return both.withColumn(out, F.coalesce("_few", "_some")).drop("_few", "_some")


def backoff(kept: Column, lower: Column) -> Column:
    """log10 of the weight of what a history's own n-grams leave over."""
    return F.log10(F.greatest(1 - kept, F.lit(1e-12)) / F.greatest(1 - lower, F.lit(1e-12)))


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What a job shuffles is deleted when it has ended; for jobs whose results are written and read from there."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Model:
    """Stored tables *words*, *twos*, *threes* of the n-grams of the model; *terms* reads them as (k, often, base, add).

    p(w | u, v) is that of the 3-gram if the model has it, else the weight of (u, v), 1 if nothing follows it, times
    p(w | v), which is found alike; the last resort is the base distribution. In log10, a text is therefore the sum over its
    n-grams of what each *adds* to what the shorter ones say: a word its base probability and, as a token follows it, its
    weight as a history; a 2-gram of the model its probability less those two, and its own weight; a 3-gram of the model its
    probability less the weight and the probability of the two 2-grams in it. Others add nothing. *base* is null but for
    words; *base* and *add* of a word are less ``unknown``, what an unknown word has.
    """

    def __init__(self, docs: DataFrame, word_share: float, gram_share: float):
        counts = written(word_counts(docs))
        totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
        self.n_all, self.n_distinct = totals["n"], totals["v"]
        self.unit = self.n_all + ADD * (self.n_distinct + 1)
        self.unknown = math.log10(ADD / self.unit)
        often, often_gram = F.col("n") >= WORD_SHARE * self.n_all, F.col("n") >= GRAM_SHARE * self.n_all
        least, least_word = max(gram_share * self.n_all, LEAST), max(word_share, gram_share) * self.n_all
        two = _all(written(self._twos(docs, counts, often, least, least_word, part)) for part in range(PAIR_ROUNDS))
        p, p1 = (F.col("n") - DISCOUNT) / F.col("nv"), (F.col("nw") + ADD) / self.unit
        two = two.select("v", "k", "n", p.alias("p"), p1.alias("p1"))
        after_one = (two.groupBy(F.col("v").alias("h")).agg(F.sum("p").alias("kept"), F.sum("p1").alias("lower"))
                     .select("h", backoff(F.col("kept"), F.col("lower")).alias("b2")))
        words = written(counts.join(after_one, "h", "left").select("h", "n", F.coalesce("b2", F.lit(0.0)).alias("b2")))
        three = _all(written(self._threes(docs, two, least, part)) for part in range(ROUNDS))
        base = F.log10((F.col("n") + ADD) / F.lit(ADD))
        none = F.lit(None).cast("double")
        after_two = three.groupBy(F.col("a").alias("k")).agg(F.first("b3").alias("b3"))
        twos = written(of_word(two, words, often, "v", "b2", "b2").join(after_two, "k", "left").select("k", "n", (
            F.log10("p") - F.col("b2") - F.log10("p1") + F.coalesce("b3", F.lit(0.0))).alias("add")))
        self.terms = (
            words.select(F.col("h").alias("k"), often.alias("often"), base.alias("base"), (base + F.col("b2")).alias("add"))
            .unionByName(twos.unionByName(three.select("k", "n", "add")).select(
                "k", often_gram.alias("often"), none.alias("base"), "add")))

    def _twos(self, docs: DataFrame, counts: DataFrame, often: Column, least: float, least_word: float, part: int) -> DataFrame:
        """(v, k, n, nv, nw) of the 2-grams k = (v, w) of a round."""
        pairs = gram_counts(docs, 2, part, PAIR_ROUNDS, bucket_count(docs.sparkSession, self.n_all / PAIR_ROUNDS), least)
        pairs = pairs.withColumnsRenamed({"a": "v", "b": "w"})
        for name in "vw":
            pairs = of_word(pairs, counts, often, name, "n", f"n{name}")
        return pairs.filter((F.col("nv") >= least_word) & (F.col("nw") >= least_word)).select("v", "k", "n", "nv", "nw")

    def _threes(self, docs: DataFrame, two: DataFrame, least: float, part: int) -> DataFrame:
        """(a, k, n, b3, add) of the 3-grams k = (a, b) of a round."""
        triples = gram_counts(docs, 3, part, ROUNDS, bucket_count(docs.sparkSession, self.n_all / ROUNDS), least)
        last = two.select(F.col("k").alias("b"), F.col("p").alias("lower"))
        first = two.filter(F.pmod("k", F.lit(ROUNDS)) == part).select(F.col("k").alias("a"), F.col("n").alias("times"))
        q = (F.col("n") - DISCOUNT) / F.col("times")
        found = triples.join(last, "b").join(first, "a").select("a", "k", "n", q.alias("q"), "lower")
        after = found.groupBy("a").agg(F.sum("q").alias("_kept"), F.sum("lower").alias("_lower")).select(
            "a", backoff(F.col("_kept"), F.col("_lower")).alias("b3"))
        return found.join(after, "a").select("a", "k", "n", "b3", (F.log10("q") - F.col("b3") - F.log10("lower")).alias("add"))

    def frequent(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(k, known, base, add) of frequent words and n-grams by k; bounded by the shares."""
        table = self.terms.filter("often").select("k", "base", "add").toArrow()
        k, add = table.column("k").to_numpy(), table.column("add").to_numpy()
        known = ~table.column("base").is_null().to_numpy()
        base = table.column("base").fill_null(0.0).to_numpy()
        order = np.argsort(k)
        return k[order], known[order].astype(np.int64), base[order], add[order]


def _all(tables: Iterator[DataFrame]) -> DataFrame:
    tables = list(tables)
    found = tables[0]
    for more in tables[1:]:
        found = found.unionByName(more)
    return found


class Places:
    """Where hashes stand in an array of distinct ones: open addressing, as a search by halves misses the cache at each step."""

    def __init__(self, keys: np.ndarray):
        self.keys, size = keys, 1 << max(4, (4 * len(keys)).bit_length())
        self.mask, self.slots = np.int64(size - 1), np.full(size, -1, dtype=np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            lost = self.slots[slot] != left
            left, slot = left[lost], slot[lost] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.int64(20) & self.mask

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in *keys*, places) of those that are there."""
        slot = self._slot(keys)
        place = self.slots[slot]
        if len(self.keys):
            other = np.flatnonzero((place >= 0) & (self.keys[place] != keys))  # -1 reads the last one, to no effect
            place[other] = -1
            slot = slot[other] + 1 & self.mask
            while len(other):
                at = self.slots[slot]
                same = (at >= 0) & (self.keys[at] == keys[other])
                place[other[same]] = at[same]
                on = (at >= 0) & ~same
                other, slot = other[on], slot[on] + 1 & self.mask
        found = np.flatnonzero(place >= 0)
        return found, place[found]


def _of_round(keys: np.ndarray, part: int) -> np.ndarray:
    return keys % np.int64(ROUNDS) == part


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number, text) of all words, of all 2-grams and of all 3-grams of some texts."""
    w, text = token_hashes(data, offsets)
    pairs = pair_keys(w[:-1], w[1:])
    triples = pair_keys(pairs[:-1], pairs[1:])
    yield w.view(np.int64), text
    for n, keys in ((1, pairs), (2, triples)):
        whole = text[n:] == text[:len(text) - n]
        yield keys[whole].view(np.int64), text[n:][whole]


def score(docs: DataFrame, learn: DataFrame, id_col: str = "doc_id", text_col: str = "text", word_share: float = 0.0,
          gram_share: float = 0.0) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score): log10 probabilities of whole texts.

    The model has every n-gram that occurs LEAST times; *word_share*, *gram_share* (shares of all tokens) can ask for a
    coarser one. Its frequent part goes with the tasks and scores what it can. Every other n-gram of a text goes,
    in blocks and in rounds, to the bucket that has its part of the stored tables, where no key of the model is frequent.

    A null text counts as empty: one end. Rows that share an id and nothing else are scored apart. With no
    training text, all tokens are unknown and the probability of each is 1. Other columns are ignored.
    """
    spark = docs.sparkSession
    with shuffles_dropped(spark):
        model = Model(learn.select(F.col(text_col).alias("text")), word_share, gram_share)
        frequent = spark.sparkContext.broadcast(model.frequent())
        unknown = model.unknown
        # a text stands by its hash: copies have one number, and what the joins add up for them is shared out again
        texts = docs.select(F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                            F.col(text_col).alias("text"))
        scores = "row long, doc_id long, n_tokens long, n_known long, base double, score double"

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, of_words, base, add = frequent.value
            table = Places(keys)
            for batch in batches:
                sums = [np.zeros(batch.num_rows) for _ in range(4)]
                for i, j, data, offsets in texts_in_chunks(batch):
                    for order, (keys, text) in enumerate(_grams(data, offsets)):
                        there, at = table.find(keys)
                        known = text[there]
                        if order == 0:
                            sums[0][i:j] = np.bincount(text, minlength=j - i)
                        for total, values in zip(sums[1:], (of_words, base, add)):
                            total[i:j] += np.bincount(known, weights=values[at], minlength=j - i)
                n, known, p, q = sums
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)),
                     pa.array(p + n * unknown), pa.array(q + n * unknown)], names=[x.split()[0] for x in scores.split(", ")])

        first = written(_in_arrow(texts, scored, scores))
        entries = first.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
        # what a bucket holds is its part of the model; the n-grams of the texts only pass by
        buckets = bucket_count(spark, (entries + model.n_all) / (2 * ROUNDS))
        rare = model.terms.filter("NOT often").select("k", "base", "add")
        sums = "row long, known long, base double, add double"

        def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple] = []

            def sent() -> Iterator[pa.RecordBatch]:
                k, base, add = (np.concatenate(x) for x in zip(*held))
                held.clear()
                yield from blocks(k, buckets, 0, k, base, add)

            for batch in batches:
                held.append(tuple(batch.column(name).to_numpy(zero_copy_only=False) for name in ("k", "base", "add")))
                if len(held) * BATCH_ROWS >= HELD:
                    yield from sent()
            if held:
                yield from sent()

        def open_grams(part: int):
            def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                table, held = Places(frequent.value[0]), []
                for batch in batches:
                    row = batch.column("row").to_numpy()
                    for i, j, data, offsets in texts_in_chunks(batch):
                        for keys, text in _grams(data, offsets):
                            taken = _of_round(keys, part)
                            keys, text = keys[taken], text[taken]
                            rest = np.ones(len(keys), dtype=bool)
                            rest[table.find(keys)[0]] = False
                            held.append((keys[rest], row[i:j][text[rest]]))
                    if sum(len(k) for k, _ in held) >= HELD // 2:
                        k, rows = (np.concatenate(x) for x in zip(*held))
                        held.clear()
                        yield from blocks(k, buckets, 1, k, rows)
                if held:
                    k, rows = (np.concatenate(x) for x in zip(*held))
                    yield from blocks(k, buckets, 1, k, rows)
            return work

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, table = [], None
            for batch in batches:
                for kind, block in zip(batch.column("kind").to_pylist(), batch.column("block")):
                    if kind == 0:
                        held.append(columns_of(block, "i8", "f8", "f8"))
                        continue
                    if table is None:  # the model's blocks come first
                        if not held:
                            continue
                        table = [np.concatenate(x) for x in zip(*held)]
                        places = Places(table[0])
                    keys, rows = columns_of(block, "i8", "i8")
                    there, at = places.find(keys)
                    rows = rows[there]
                    if len(rows):
                        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                        base = table[1][at]
                        known = ~np.isnan(base)
                        yield _columns(sums, row=rows[starts], known=np.add.reduceat(known.astype(np.int64), starts),
                                       base=np.add.reduceat(np.where(known, base, 0.0), starts), add=np.add.reduceat(table[2][at], starts))

        found = []
        for part in range(ROUNDS):
            sent = _in_arrow(texts.select("row", "text"), open_grams(part), _BLOCK).unionByName(
                rare.filter(F.pmod("k", F.lit(ROUNDS)) == part).mapInArrow(terms, _BLOCK))
            met = by_bucket(sent, buckets).sortWithinPartitions("kind").mapInArrow(meet, sums)
            found.append(written(met.groupBy("row").agg(*(F.sum(x).alias(x) for x in ("known", "base", "add")))))
    more = _all(iter(found)).groupBy("row").agg(F.sum("known").alias("_known"), F.sum("base").alias("_base"), F.sum("add").alias("_add"))
    copies = first.groupBy("row").agg(F.count("*").alias("_copies"))
    zero, shared = F.lit(0.0), more.join(copies, "row")
    return first.join(shared, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce((F.col("_known") / F.col("_copies")).cast("long"), F.lit(0))).alias("n_known"),
        F.lit(model.n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce(F.col("_base") / F.col("_copies"), zero)).alias("base_score"),
        (F.col("score") + F.coalesce(F.col("_add") / F.col("_copies"), zero)).alias("score"))


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """score() with training on the documents whose id is not held out (1 of 10)."""
    held = held_out(F.col(id_col), 10, 0)
    return (score(docs, docs.filter(~held), id_col, text_col)
            .withColumn("held_out", held_out(F.col("doc_id"), 10, 0)))
