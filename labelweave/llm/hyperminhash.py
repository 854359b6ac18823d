"""Near-duplicates by HyperMinHash: compressed registers, bands of them, corrected estimates, exact checks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (WORD, Batch, ascii_lower, kept_in_worker, looked_up_by, map_batches, numbered, sized, stored,
                     with_row, written)
from .components import connected_components

SHINGLE = 5
#: Link: 100 * intersection >= threshold * union; this is the one that the query's contract fixes.
THRESHOLD = 85
#: 640 registers in bands: 64 of 10 if the threshold is 85 or more, where two sets of similarity 0.85 miss every band with
#: probability 8e-7, while sets that only share a passage seldom meet (0.3: 4e-4).
REGISTERS = 640
BAND_ROWS = (10, 8, 5, 4, 2, 1)
#: The chance to miss every band that a pair right at the threshold may have.
MISSED = 1e-6
#: Registers that travel with a node for the estimate.
ESTIMATED = 256
MANTISSA_BITS = 10
#: A pair is checked exactly unless its estimate lies this many standard errors below the threshold.
SIGMAS = 6
#: Factor of the expected share of accidental register matches (Yu and Weber, "HyperMinHash", 2017).
COLLISIONS = 0.169919487159739
#: Cross pairs a bucket member may cost before hubs are tried again, and how often.
PAIRS_PER_MEMBER, HUB_ROUNDS = 50, 3
KEPT_WORDS = 500_000
#: A bucket is compared in blocks of about this many bytes of parity bits.
BLOCK_BYTES = 4_000_000

_M1, _M2, _STEP = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_33 = np.uint64(33)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (MurmurHash3)."""
    x = (x ^ (x >> _33)) * _M1
    x = (x ^ (x >> _33)) * _M2
    return x ^ (x >> _33)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def shingles(text: str | None, hashes: dict[str, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; with fewer words, of the whole sequence."""
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    acc = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        acc = mixed(acc * _STEP + w[k:k + n])
    return np.unique(acc)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of REGISTERS numbers per non-empty set: leading zeros and mantissa of each bucket's least hash.

    Hashes fall into buckets by their remainder. An empty bucket takes the register of another, found by a fixed
    pseudo-random walk, so that two sets agree in a register with the probability of their similarity
    however small they are.
    """
    rows = len(sets)
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    bucket = (values % np.uint64(REGISTERS)).astype(np.int64) + np.repeat(np.arange(rows), sizes) * REGISTERS
    least = np.full(rows * REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, bucket, mixed(values ^ _STEP) >> np.uint64(8))
    filled = np.zeros(rows * REGISTERS, dtype=bool)
    filled[bucket] = True
    donor = np.arange(rows * REGISTERS)
    empty = np.flatnonzero(~filled)
    base, place, tries = empty // REGISTERS * REGISTERS, (empty % REGISTERS).astype(np.uint64), 0
    while len(empty):
        tries += 1
        to = base + (mixed(place * _STEP + np.uint64(tries)) % np.uint64(REGISTERS)).astype(np.int64)
        donor[empty] = to
        open_ = ~filled[to]
        empty, base, place = empty[open_], base[open_], place[open_]
    v = least[donor]
    low = v < np.uint64(16)
    bits = np.where(low, np.frexp(v.astype(np.float64))[1], np.frexp((v >> np.uint64(4)).astype(np.float64))[1] + 4)
    zeros = np.minimum(56 - bits, 56 - MANTISSA_BITS - 1).astype(np.uint64)
    mantissa = (v << (zeros + np.uint64(9))) >> np.uint64(64 - MANTISSA_BITS)  # the bits after the leading one
    return ((zeros << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16).reshape(rows, REGISTERS)


def rows_per_band(threshold: int) -> int:
    """The most registers a band can have so that pairs at *threshold* miss every band with at most MISSED."""
    missed = lambda rows: (1 - (threshold / 100) ** rows) ** (REGISTERS // rows)
    return next((rows for rows in BAND_ROWS if missed(rows) <= MISSED), 1)


def band_keys(regs: np.ndarray, rows: int = BAND_ROWS[0]) -> np.ndarray:
    """A 64-bit key per set and band of *rows* registers."""
    bands = REGISTERS // rows
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(regs), bands))
    for k in range(rows):
        acc = mixed(acc * _STEP + regs[:, k::rows].astype(np.uint64))
    return acc.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of rows of registers, less the matches that differing hashes make by accident."""
    share = (a == b).mean(axis=1)
    ratio = n_a / np.maximum(n_b, 1)
    accident = COLLISIONS * 4 * ratio / (1 + ratio) ** 2 / 2 ** MANTISSA_BITS
    return (share - accident) / (1 - accident)


def sketches(rows: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(row, doc_id, n_shingles, digest, band keys of the registers) of *rows* (row, doc_id, text).

    The digest is that of the set. A text without words has no keys, and the digest of its id and text.
    """
    rows_in_band = rows_per_band(threshold)

    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        hashes = kept_in_worker("word hashes", WordHashes)
        for batch in batches:
            if len(hashes) > KEPT_WORDS:
                hashes.clear()
            sets = [shingles(t, hashes) for t in batch["text"]]
            full = [s for s in sets if len(s)]
            regs = registers(full) if full else np.empty((0, REGISTERS), dtype=np.uint16)
            keys = iter(band_keys(regs, rows_in_band).tolist())
            seen = [s.tobytes() if len(s) else f"no words {i} {t!r}".encode()
                    for s, i, t in zip(sets, batch["doc_id"], batch["text"])]
            yield {"row": batch["row"], "doc_id": batch["doc_id"], "n_shingles": [len(s) for s in sets],
                   "digest": [hashlib.blake2b(x, digest_size=16).digest() for x in seen],
                   "keys": [next(keys) if len(s) else None for s in sets]}

    return map_batches(rows.select("row", "doc_id", "text"), work,
                       "row long, doc_id long, n_shingles long, digest binary, keys array<long>")


def shingle_sets(rows: DataFrame) -> DataFrame:
    """(node, n_shingles, registers, hashes) of *rows* (row, text): sets in full, as sorted 64-bit numbers, and sketches."""
    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        hashes = kept_in_worker("word hashes", WordHashes)
        for batch in batches:
            if len(hashes) > KEPT_WORDS:
                hashes.clear()
            sets = [shingles(t, hashes) for t in batch["text"]]
            full = [(i, s) for i, s in zip(batch["row"], sets) if len(s)]
            regs = registers([s for _, s in full])[:, :ESTIMATED] if full else []
            yield {"node": [i for i, _ in full], "n_shingles": [len(s) for _, s in full],
                   "registers": [r.tobytes() for r in regs], "hashes": [s.tobytes() for _, s in full]}

    return map_batches(rows.select("row", "text"), work, "node long, n_shingles long, registers binary, hashes binary")


def unshared(sets: DataFrame) -> DataFrame:
    """(node, unshared): how many of a node's shingles no other of the *sets* has; nodes without any have no row."""
    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        for batch in batches:
            for node, data in zip(batch["node"], batch["hashes"]):
                found = np.frombuffer(data, dtype=np.int64).tolist()
                yield {"node": [node] * len(found), "hash": found}

    single = (map_batches(sets, work, "node long, hash long").groupBy("hash")
              .agg(F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other"))
    return single.groupBy("node").agg(F.count("*").alias("unshared"))


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (a, b) that meet *threshold*: sizes and registers rule most others out, full sets decide."""
    goal = threshold / 100

    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch[c]), dtype=np.uint16).reshape(-1, ESTIMATED) for c in ("ra", "rb"))
            n_a, n_b = (np.array(batch[c], dtype=np.float64) for c in ("na", "nb"))
            least, most = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
            error = np.sqrt(goal * (1 - goal) / np.minimum(ESTIMATED, least))
            open_ = (least * 100 >= threshold * most) & (estimate(x, y, n_a, n_b) >= goal - SIGMAS * error)
            out: Batch = {"a": [], "b": []}
            for at in np.flatnonzero(open_).tolist():
                one, two = (np.frombuffer(batch[c][at], dtype=np.uint64) for c in ("ha", "hb"))
                shared = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * shared >= threshold * (len(one) + len(two) - shared):
                    out["a"].append(batch["a"][at])
                    out["b"].append(batch["b"][at])
            yield out

    side = lambda s: sets.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n{s}"),
                                 F.col("registers").alias(f"r{s}"), F.col("hashes").alias(f"h{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return map_batches(both.select("a", "b", "na", "nb", "ra", "rb", "ha", "hb"), work, "a long, b long")


def parity(hashes: np.ndarray) -> bytes:
    """A bit per remainder of the hashes: whether an odd number of them has it. There are four times as many bits as
    hashes, rounded up to a power of two.

    Where two sets have the same shingles, so have their parities: bits that differ are at most the shingles that differ.
    """
    width = max(512, 1 << (4 * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def parities(sets: DataFrame) -> DataFrame:
    """(node, parity) of *sets* (node, hashes)."""
    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        for batch in batches:
            yield {"node": batch["node"], "parity": [parity(np.frombuffer(h, dtype=np.uint64)) for h in batch["hashes"]]}

    return map_batches(sets.select("node", "hashes"), work, "node long, parity binary")


def near_by_parity(group: dict[str, list], threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes of one group (node, label, size, block, parity) that can reach *threshold*, as two arrays.

    Of a group of two blocks only pairs across them count. 100 |x and y| >= threshold |x or y| holds just if
    (100 + threshold) * differing shingles <= (100 - threshold) * (|x| + |y|). Wider parities are folded to the
    narrower ones they meet.
    """
    node, label, size, block = (np.array(group[c], dtype=np.int64) for c in ("node", "label", "size", "block"))
    width = np.array([len(x) for x in group["parity"]])
    across = block.min() != block.max()
    widths = np.unique(width).tolist()
    for w in widths:
        narrow = np.flatnonzero(width == w)
        bits = np.frombuffer(b"".join(group["parity"][k] for k in narrow), dtype=np.uint64).reshape(len(narrow), -1)
        for wide in (v for v in widths if v >= w):
            at = np.flatnonzero(width == wide)
            if not size[narrow].max() * 100 >= threshold * size[at].min():
                continue
            other = np.frombuffer(b"".join(group["parity"][k] for k in at), dtype=np.uint64).reshape(len(at), -1)
            while other.shape[1] > bits.shape[1]:
                half = other.shape[1] // 2
                other = other[:, :half] ^ other[:, half:]
            for k, x in enumerate(narrow.tolist()):
                both = size[at] + size[x]
                open_ = (label[at] != label[x]) & (100 * np.minimum(size[at], size[x]) >= threshold * np.maximum(size[at], size[x]))
                if across:
                    open_ &= block[at] != block[x]
                if wide == w:
                    open_ &= at > x
                rest = np.flatnonzero(open_)
                if len(rest):
                    differ = np.bitwise_count(other[rest] ^ bits[k]).sum(axis=1, dtype=np.int64)
                    rest = rest[differ * (100 + threshold) <= (100 - threshold) * both[rest]]
                    yield np.full(len(rest), node[x]), node[at[rest]]


def pairs_in_buckets(left: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(a, b): pairs of different labels within a bucket of *left* (key, node, label, size) that parities do not rule out.

    All pairs of a bucket are looked at inside of a task and only those that may be links become rows. A large
    bucket is split into blocks, and each pair of its blocks is a group.
    """
    bits = stored(parities(sets.join(left.select("node").distinct(), "node", "left_semi")))
    rows = left.select("key", "node", "label", "size").join(bits, "node")
    blocks = left.join(bits.select("node", F.length("parity").alias("bytes")), "node").groupBy("key").agg(
        F.ceil((F.sum("bytes") + 32 * F.count("*")) / BLOCK_BYTES).cast("long").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    met = (rows.join(blocks, "key").withColumn("block", block)
           .withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
           .withColumn("i", F.least("block", "met")).withColumn("j", F.greatest("block", "met"))
           .select("key", "i", "j", "node", "label", "size", "block", "parity"))

    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        def found(group: dict[str, list]) -> Iterator[Batch]:
            if len(group["node"]) > 1:
                for a, b in near_by_parity(group, threshold):
                    yield {"a": np.minimum(a, b), "b": np.maximum(a, b)}

        now, held = None, {}
        for batch in batches:
            groups = list(zip(batch["key"], batch["i"], batch["j"]))
            start = 0
            for k in range(1, len(groups) + 1):
                if k == len(groups) or groups[k] != groups[start]:
                    if groups[start] != now:
                        if now is not None:
                            yield from found(held)
                        now, held = groups[start], {c: [] for c in ("node", "label", "size", "block", "parity")}
                    for c, values in held.items():
                        values.extend(batch[c][start:k])
                    start = k
        if now is not None:
            yield from found(held)

    grouped = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return map_batches(grouped, work, "a long, b long").distinct()


def similar_components(sketch: DataFrame, classes: DataFrame, rows: DataFrame, threshold: int) -> DataFrame:
    """(node, label): the components of the *classes* (node) of equal sets, of nodes with a link only."""
    nodes = sketch.join(classes.select(F.col("node").alias("row")), "row", "left_semi").filter("keys IS NOT NULL")
    banded = nodes.select(F.col("row").alias("node"), F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y")).filter("x < y").select("key")
    members = written(banded.join(shared, "key").select("key", "node"))
    wanted = sized(stored(members.select(F.col("node").alias("row")).distinct()))
    sets = stored(shingle_sets(rows.join(wanted, "row", "left_semi")))

    def linked(pairs: DataFrame) -> DataFrame:
        return stored(confirmed(pairs.distinct(), sets, threshold))

    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    hubs = members.groupBy("key").agg(F.min("node").alias("hub"))
    links = linked(members.join(hubs, "key").filter("node > hub").select(*ordered("hub", "node")))
    labels = connected_components(links)
    own = stored(sets.select("node", F.col("n_shingles").alias("size")).join(unshared(sets), "node", "left")
                 .select("node", "size", F.coalesce("unshared", F.lit(0)).alias("own")))
    # |x and y| <= |x| - own(x) and |x or y| >= |y| + own(x)
    reaches = F.col("size") * 100 - F.col("own") * 100 >= threshold * (F.col("least") + F.col("own"))
    for round_ in range(1, HUB_ROUNDS + 2):
        known = own.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        labelled = members.join(known, "node")
        smallest = labelled.groupBy("key").agg(F.min("size").alias("least"), F.min("label").alias("x"),
                                               F.max("label").alias("y")).filter("x < y").select("key", "least")
        left = stored(labelled.join(smallest, "key").filter(reaches).select("key", "node", "label", "size"))
        parts = left.groupBy("key", "label").agg(F.count("*").alias("n"))
        open_ = (parts.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
                 .filter("n * n > squares"))
        cost = open_.agg(F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2).alias("pairs"),
                         F.sum("n").alias("n")).first()
        if not cost["n"]:
            break
        if cost["pairs"] <= PAIRS_PER_MEMBER * cost["n"] or round_ > HUB_ROUNDS:
            left = left.join(open_.select("key"), "key", "left_semi")
            return connected_components(linked(pairs_in_buckets(left, sets, threshold)), labels)
        draw = F.struct(F.xxhash64("node", F.lit(round_)).alias("draw"), "node", "label")
        hub = left.groupBy("key").agg(F.min(draw).alias("hub")).select(
            "key", F.col("hub.node").alias("hub"), F.col("hub.label").alias("hub_label"))
        pairs = left.join(hub, "key").filter("label <> hub_label").select(*ordered("hub", "node"))
        labels = connected_components(linked(pairs), labels)
    return labels


def duplicate_rows(rows: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, kept, stays) of stored *rows* (row, doc_id, text); row is unique.

    1. Every text becomes a sketch; rows of equal sets are one class, a *node*.
    2. Nodes meet in buckets of equal bands. In each bucket one hub is compared with all others: estimate
       from the registers, then the exact check on the full sets. Links join into components.
    3. Only pairs of different components in one bucket are still open. A node leaves a bucket if the shingles
       that no other bucketed node has keep it from the threshold with any size that the bucket holds. While many
       pairs are open, further hubs are tried. What remains is looked at by parities of the sets (pairs_in_buckets),
       so that no pair of a crowd just below the threshold becomes a row, and what these leave is checked in full.

    component_id is the least id of the component, null if none of its rows has one. *stays* is true for one row of
    each component, the first of the least id. Rows are told apart by their number alone, whatever their ids.
    """
    sketch = written(sketches(rows, threshold))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    classes = stored(sketch.groupBy("digest").agg(first, F.count("*").alias("times")).select(
        "digest", F.col("first.row").alias("node"), F.col("first.doc_id").alias("least"), "times"))
    labels = stored(similar_components(sketch, classes, rows, threshold))
    linked = stored(classes.join(labels, "node").select("digest", "node", "least", "times", "label"))
    best = F.min(F.struct(F.col("least").isNull().alias("no_id"), "least", "node")).alias("best")
    components = linked.groupBy("label").agg(best, F.count("*").alias("times")).select(
        "label", F.col("best.least").alias("component_id"), F.col("best.node").alias("stays"), "times")
    several = looked_up_by(linked, stored(components), "label").select("digest", "times", "component_id", "stays")
    alone = classes.join(labels, "node", "left_anti").select(
        "digest", "times", F.col("least").alias("component_id"), F.col("node").alias("stays"))
    verdicts = stored(several.unionByName(alone))
    stays = F.col("row") == F.col("stays")
    kept = F.when(F.col("component_id").isNull(), stays).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return (looked_up_by(sketch.select("row", "doc_id", "n_shingles", "digest"), verdicts, "digest")
            .select("row", "doc_id", "n_shingles", "component_id", kept.alias("kept"), stays.alias("stays")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row; links need *threshold* per cent in common.

    By duplicate_rows(), on rows numbered as they are stored. Empty and null texts have an empty set and link with
    nothing. A row without an id is linked like any other and not kept if its component has an id; a component
    without any id has a null component_id and keeps one row. Rows that share an id are judged by their own texts;
    equal rows give equal results. Other columns are ignored.
    """
    return (duplicate_rows(numbered(docs, id_col, text_col), threshold)
            .select("doc_id", "n_shingles", "component_id", "kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The rows of *docs*, with all their columns, but of each group of near-duplicates one: that of the least id, or any
    if none has an id. Texts without words resemble nothing; of those that repeat an id and a text one stays.
    """
    rows = with_row(docs)
    texts = rows.select("row", F.col("all")[id_col].cast("long").alias("doc_id"), F.col("all")[text_col].alias("text"))
    gone = stored(duplicate_rows(texts, threshold).filter(~F.col("stays")).select("row"))
    return rows.join(sized(gone), "row", "left_anti").select("all.*")
