"""Lexical and vector similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from labelweave.functions.text import let

# Jaro-Winkler prefix length, prefix weight and boost floor.
PREFIX_CHARS = 4
PREFIX_WEIGHT = 0.1
BOOST_ABOVE = 0.7
NORM_FLOOR = 1e-12

_CHUNK = 16_384      # pairs compared per numpy step
_LONG = 128          # longer strings are matched on words of 64 places
_HUGE = 1024         # still longer ones fill a numpy step alone: one integer of any width is faster
_TABLE_CELLS = 32_768  # cosines added up at a time, so that they stay in the cache
LONG_CELLS = 1_000_000  # characters of long strings compared per numpy step


def _codes_by_position(strings: list[str], width: int) -> np.ndarray:
    """Character codes, one row per position; one byte each when they fit."""
    flat = np.array(strings, dtype=f"<U{max(width, 1)}").view(np.uint32)
    by_position = flat.reshape(len(strings), -1).T
    small = np.uint8 if flat.size == 0 or flat.max() < 256 else np.uint32
    return np.ascontiguousarray(by_position, dtype=small)


def _in_order(codes: np.ndarray, hit: np.ndarray, depth: int) -> np.ndarray:
    """The matched characters of every string, packed to the front."""
    out = np.zeros((depth, codes.shape[1]), dtype=codes.dtype)
    at = np.zeros(codes.shape[1], dtype=np.int64)
    for position in range(len(codes)):
        rows = np.flatnonzero(hit[position])
        out[at[rows], rows] = codes[position, rows]
        at[rows] += 1
    return out


def _jaro_winkler_chunk(a: list[str], b: list[str], la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Pairs side by side: every step handles one position pair of all strings."""
    n, wa, wb = len(a), int(la.max()), int(lb.max())
    out = np.zeros(n)
    if wa == 0 or wb == 0:
        out[(la == 0) & (lb == 0)] = 1.0
        return out
    A, B = _codes_by_position(a, wa), _codes_by_position(b, wb)
    if A.dtype != B.dtype:
        A, B = A.astype(np.uint32), B.astype(np.uint32)
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    widest = int(reach.max())
    within = [reach >= distance for distance in range(widest + 1)]
    free = np.arange(wa)[:, None] < la[None, :]
    hit_a = np.zeros((wa, n), dtype=bool)
    hit_b = np.zeros((wb, n), dtype=bool)
    for j in range(wb):
        open_ = j < lb
        for i in range(max(0, j - widest), min(wa, j + widest + 1)):
            ok = A[i] == B[j]
            ok &= free[i]
            ok &= open_
            ok &= within[abs(i - j)]
            free[i] ^= ok
            open_ ^= ok
            hit_a[i] |= ok
            hit_b[j] |= ok
    return _scored(A, B, hit_a, hit_b, la, lb)


def _scored(A: np.ndarray, B: np.ndarray, hit_a: np.ndarray, hit_b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Jaro-Winkler from the matched characters of pairs side by side."""
    n, wa, wb = len(la), len(A), len(B)
    out = np.zeros(n)
    m = hit_a.sum(axis=0)
    depth = int(m.max())
    if depth:
        other = _in_order(A, hit_a, depth) != _in_order(B, hit_b, depth)
        swapped = other.sum(axis=0) // 2
        has = m > 0
        mm, l1, l2 = m[has].astype(float), la[has], lb[has]
        out[has] = (mm / l1 + mm / l2 + (mm - swapped[has]) / mm) / 3.0
    prefix, same = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for position in range(min(PREFIX_CHARS, wa, wb)):
        same &= (A[position] == B[position]) & (position < la) & (position < lb)
        prefix += same
    boost = out > BOOST_ABOVE
    out[boost] += PREFIX_WEIGHT * prefix[boost] * (1.0 - out[boost])
    out[(la == 0) & (lb == 0)] = 1.0
    return out


def _letter_masks(A: np.ndarray, B: np.ndarray, la: np.ndarray, lb: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(masks, which): per pair and distinct character of its left string, the bit set of its places; and the mask that each
    character of the right string asks for, the last one (empty) if the left string has none of it."""
    n, wa, wb = len(la), len(A), len(B)
    pair = np.repeat(np.arange(n), wa).reshape(n, wa)
    inside = np.arange(wa) < la[:, None]
    key = (pair.astype(np.int64) << 32 | A.T.astype(np.int64))[inside]
    known, of = np.unique(key, return_inverse=True)
    start = np.searchsorted(known, np.arange(n, dtype=np.int64) << 32)
    rank = of - start[pair[inside]]
    most = int(np.diff(np.r_[start, len(known)]).max()) if n else 0
    masks = np.zeros((n, most + 1, words), dtype=np.uint64)
    place = np.broadcast_to(np.arange(wa), (n, wa))[inside]
    np.bitwise_or.at(masks, (pair[inside], rank, place // 64), np.uint64(1) << (place % 64).astype(np.uint64))
    asked = np.arange(n, dtype=np.int64)[:, None] << 32 | B.T.astype(np.int64)
    at = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
    there = (known[at] == asked) & (np.arange(wb) < lb[:, None]) if len(known) else np.zeros((n, wb), dtype=bool)
    return masks, np.where(there, at - start[:, None], most)


def _jaro_winkler_words(a: list[str], b: list[str], la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """As the chunk above for long strings: the places of a character are bits of 64-bit words, so that a step matches one
    character of every right string with all places of its left string."""
    n, wa, wb = len(a), int(la.max()), int(lb.max())
    if wa == 0 or wb == 0:
        return np.where((la == 0) & (lb == 0), 1.0, 0.0)
    A, B = (_codes_by_position(x, w).astype(np.uint32) for x, w in ((a, wa), (b, wb)))
    words = -(-wa // 64)
    masks, which = _letter_masks(A, B, la, lb, words)
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
    full, one, base = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(1), np.arange(words) * 64
    free = np.full((n, words), full)
    hit_a, hit_b = np.zeros((wa, n), dtype=bool), np.zeros((wb, n), dtype=bool)
    rows = np.arange(n)
    for j in range(wb):
        low, high = np.clip(j - reach - base, 0, 64), np.clip(j + reach + 1 - base, 0, 64)
        above = np.where(low < 64, full << np.minimum(low, 63).astype(np.uint64), np.uint64(0))
        below = np.where(high > 0, full >> np.minimum(64 - high, 63).astype(np.uint64), np.uint64(0))
        near = masks[rows, which[:, j]] & free & above & below
        word = (near != 0).argmax(axis=1)
        bits = near[rows, word]
        found = np.flatnonzero(bits)
        if len(found) == 0:
            continue
        first = bits[found] & (~bits[found] + one)
        free[found, word[found]] ^= first
        hit_a[word[found] * 64 + np.log2(first.astype(np.float64)).astype(np.int64), found] = True
        hit_b[j, found] = True
    return _scored(A, B, hit_a, hit_b, la, lb)


def _jaro_winkler_long(a: str, b: str) -> float:
    """One pair of long strings; positions of a character form one integer bit set."""
    if not a or not b:
        return 1.0 if a == b else 0.0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    window = (1 << (reach + 1)) - 1
    free = (1 << len(a)) - 1
    taken, given = [], []
    for j, c in enumerate(b):
        near = where.get(c, 0) & window & free
        if near:
            first = near & -near
            free ^= first
            taken.append(first.bit_length() - 1)
            given.append(c)
        window = (window << 1) | 1 if j < reach else window << 1
    m = len(given)
    if m == 0:
        return 0.0
    swapped = sum(a[i] != c for i, c in zip(sorted(taken), given)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3.0
    if jaro <= BOOST_ABOVE:
        return jaro
    prefix = 0
    for x, y in zip(a[:PREFIX_CHARS], b[:PREFIX_CHARS]):
        if x != y:
            break
        prefix += 1
    return jaro + PREFIX_WEIGHT * prefix * (1.0 - jaro)


def _coded(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of distinct strings. (A hash table of C strings would stop at a null character.)"""
    seen: dict[str, int] = {}
    codes = np.fromiter((seen.setdefault(s, len(seen)) for s in strings), dtype=np.int64, count=len(strings))
    distinct = np.empty(len(seen), dtype=object)
    distinct[:] = list(seen)
    return codes, distinct


def _by_cells(order: np.ndarray, size: np.ndarray):
    """Runs of *order* whose strings, padded to the longest, stay within LONG_CELLS characters (one pair at least)."""
    start, widest = 0, 0
    for at, row in enumerate(order):
        widest = max(widest, int(size[row]))
        if at > start and widest * (at + 1 - start) > LONG_CELLS:
            yield order[start:at]
            start, widest = at, int(size[row])
    if start < len(order):
        yield order[start:]


def jaro_winkler_arrays(a, b) -> np.ndarray:
    """Jaro-Winkler of aligned string sequences, vectorised over pairs.

    Equal pairs are scored once; pairs are processed in length order so that
    padding stays small.
    """
    a, b = np.asarray(a, dtype=object), np.asarray(b, dtype=object)
    if len(a) == 0:
        return np.zeros(0)
    (code_a, uniq_a), (code_b, uniq_b) = _coded(a), _coded(b)
    pair, inverse = np.unique(code_a * len(uniq_b) + code_b, return_inverse=True)
    sa, sb = uniq_a[pair // len(uniq_b)], uniq_b[pair % len(uniq_b)]
    la = np.fromiter((len(s) for s in sa), dtype=np.int64, count=len(sa))
    lb = np.fromiter((len(s) for s in sb), dtype=np.int64, count=len(sb))
    scores = np.empty(len(pair))
    long = np.maximum(la, lb) > _LONG
    huge = np.maximum(la, lb) > _HUGE
    for at in np.flatnonzero(huge):
        scores[at] = _jaro_winkler_long(sa[at], sb[at])
    order = np.flatnonzero(long & ~huge)
    order = order[np.lexsort((la[order], lb[order]))]
    for part in _by_cells(order, np.maximum(la, lb)):
        scores[part] = _jaro_winkler_words(list(sa[part]), list(sb[part]), la[part], lb[part])
    order = np.flatnonzero(~long)
    order = order[np.lexsort((la[order], lb[order]))]
    for start in range(0, len(order), _CHUNK):
        part = order[start:start + _CHUNK]
        scores[part] = _jaro_winkler_chunk(list(sa[part]), list(sb[part]), la[part], lb[part])
    return scores[inverse]


def one_to_many(name: str, texts) -> np.ndarray:
    """Jaro-Winkler of each text to one *name*: the texts are a matrix of code points, and each character of
    the name takes its first free match in all of them at once."""
    n, wide = len(texts), max((len(t) for t in texts), default=0)
    if n == 0 or wide > 4096:  # a matrix of huge texts would be mostly padding
        return np.array([_jaro_winkler_long(t, name) for t in texts])
    size = np.fromiter(map(len, texts), dtype=np.int64, count=n)
    if not name or wide == 0:
        return np.where((size == 0) & (len(name) == 0), 1.0, 0.0)
    cells = np.zeros((n, wide), dtype=np.uint32)
    for row, text in enumerate(texts):
        cells[row, :len(text)] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = np.arange(wide) < size[:, None]
    reach = np.maximum(np.maximum(size, len(name)) // 2 - 1, 0)[:, None]
    place, free, rows = np.arange(wide), inside.copy(), np.arange(n)
    letters = np.frombuffer(name.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    taken = np.full((n, len(name)), wide, dtype=np.int64)
    for j, letter in enumerate(letters):
        low, high = max(0, j - int(reach.max())), j + int(reach.max()) + 1
        near = free[:, low:high] & (cells[:, low:high] == letter) & (np.abs(place[low:high] - j) <= reach)
        if near.shape[1]:
            at = near.argmax(axis=1)
            hit = near[rows, at]
            taken[hit, j] = at[hit] + low
            free[rows[hit], at[hit] + low] = False
    m = (taken < wide).sum(axis=1)
    in_text = np.sort(taken, axis=1)
    in_name = np.argsort(taken == wide, axis=1, kind="stable")
    match = np.arange(len(name)) < m[:, None]
    said = np.take_along_axis(cells, np.minimum(in_text, wide - 1), axis=1)
    swapped = ((said != letters[in_name]) & match).sum(axis=1) // 2
    out = np.zeros(n)
    has = m > 0
    mm = m[has].astype(np.float64)
    out[has] = (mm / size[has] + mm / len(name) + (mm - swapped[has]) / mm) / 3.0
    head = min(PREFIX_CHARS, len(name), wide)
    prefix = np.logical_and.accumulate((cells[:, :head] == letters[:head]) & inside[:, :head], axis=1).sum(axis=1)
    boost = out > BOOST_ABOVE
    out[boost] += PREFIX_WEIGHT * prefix[boost] * (1.0 - out[boost])
    return out


def jaro_winkler(a: Column | str, b: Column | str) -> Column:
    """Jaro-Winkler similarity as an Arrow-batched column; null in, null out."""
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        known = (x.notna() & y.notna()).to_numpy()
        out = np.full(len(x), np.nan)
        out[known] = jaro_winkler_arrays(x[known].to_numpy(), y[known].to_numpy())
        return pd.Series(out).astype("Float64").mask(~known)
    return F.pandas_udf(score, "double")(a, b)


def lexical_bound(la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Largest Jaro-Winkler two strings of these lengths can reach."""
    m = np.minimum(la, lb)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + 1.0) / 3.0, 0.0)
    top = np.where(jaro > BOOST_ABOVE, jaro + PREFIX_CHARS * PREFIX_WEIGHT * (1.0 - jaro), jaro)
    return np.where((la == 0) & (lb == 0), 1.0, top)


class Lexicon:
    """What bounds the lexical score of a block of strings: lengths, character
    counts (hashed into classes) and first characters."""

    CLASSES = 32

    def __init__(self, strings):
        n = len(strings)
        self.length = np.fromiter((len(s) for s in strings), dtype=np.float32, count=n)
        self.counts = np.zeros((n, self.CLASSES), dtype=np.uint32)
        self.head = np.zeros((n, PREFIX_CHARS), dtype=np.uint32)
        for i, s in enumerate(strings):
            codes = np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32)
            self.counts[i] = np.bincount(codes % self.CLASSES, minlength=self.CLASSES)
            self.head[i, :len(codes[:PREFIX_CHARS])] = codes[:PREFIX_CHARS]
        if n == 0 or self.counts.max() < 256:
            self.counts = self.counts.astype(np.uint8)

    def ceiling(self, rows: slice, other: "Lexicon") -> np.ndarray:
        """Upper bound of the Jaro-Winkler of every (row, other) pair.

        Strings share at most the class-wise minimum of their counts, and the
        prefix bonus follows from the first characters.
        """
        shared = np.zeros((rows.stop - rows.start, len(other.length)), dtype=np.float32)
        for a, b in zip(self.counts[rows].T, other.counts.T):
            if a.any() and b.any():
                shared += np.minimum(a[:, None], b[None, :])
        la, lb = self.length[rows][:, None], other.length[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            bound = np.where(shared > 0, (shared / la + shared / lb + 1) / 3, np.float32(0))
        prefix = np.zeros(shared.shape, dtype=np.float32)
        same = np.ones(shared.shape, dtype=bool)
        for a, b in zip(self.head[rows].T, other.head.T):
            same &= a[:, None] == b[None, :]
            prefix += same
        bound += np.where(bound > BOOST_ABOVE - 1e-4, PREFIX_WEIGHT * prefix * (1 - bound), 0)
        bound[(la == 0) & (lb == 0)] = 1.0
        return bound + np.float32(1e-5)


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def _norm(a: Column) -> Column:
    return F.greatest(F.sqrt(_dot(a, a)), F.lit(NORM_FLOOR))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two vector columns; a zero vector scores 0."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return _dot(a, b) / F.greatest(F.sqrt(_dot(a, a) * _dot(b, b)), F.lit(NORM_FLOOR ** 2))


def _in_order_sum(rows: np.ndarray) -> np.ndarray:
    return np.cumsum(rows, axis=1)[:, -1] if rows.shape[1] else np.zeros(len(rows))


def squares(raw: np.ndarray) -> np.ndarray:
    """Squared length of each vector, added up from the first number to the last."""
    raw = raw.astype(np.float64)
    return _in_order_sum(raw * raw)


def _divided(dot: np.ndarray, square: np.ndarray) -> np.ndarray:
    return np.divide(dot, np.sqrt(square), out=np.zeros_like(dot), where=square > 0)


def cosine_pairs(a: np.ndarray, square_a: np.ndarray, b: np.ndarray, square_b: np.ndarray) -> np.ndarray:
    """Cosine of aligned rows as it is defined, by vectors as they are stored: products of single-precision numbers are
    exact in double precision, and one root and one division round the result. A level cosine comes out level, which
    products of vectors brought to length one before do not keep. *square_a* and *square_b* are their squares."""
    return _divided(_in_order_sum(a.astype(np.float64) * b), square_a * square_b)


def cosine_table(a: np.ndarray, square_a: np.ndarray, b: np.ndarray, square_b: np.ndarray) -> np.ndarray:
    """As :func:`cosine_pairs`, of every row of *a* with every row of *b*, to the same digits."""
    out = np.empty((len(a), len(b)))
    left, right = (np.ascontiguousarray(x.T.astype(np.float64)) for x in (a, b))
    step = max(1, _TABLE_CELLS // max(len(b), 1))
    for start in range(0, len(a), step):
        rows = slice(start, min(start + step, len(a)))
        dot = np.zeros((rows.stop - start, len(b)))
        for x, y in zip(left[:, rows], right):
            dot += x[:, None] * y
        out[rows] = _divided(dot, square_a[rows, None] * square_b)
    return out


def l2_normalize(v: Column | str) -> Column:
    """Unit-length vector (doubles); a zero vector stays zero."""
    v = F.col(v) if isinstance(v, str) else v
    both = F.struct(v.alias("v"), _norm(v).alias("n"))
    return let(both, lambda s: F.transform(s["v"], lambda x: x.cast("double") / s["n"]))


def blend(parts: list[tuple[float, Column]]) -> Column:
    """Element-wise weighted sum of vector columns."""
    def scaled(weight, col):
        return F.transform(col, lambda x: x.cast("double") * F.lit(weight))

    out = scaled(*parts[0])
    for weight, col in parts[1:]:
        out = F.zip_with(out, scaled(weight, col), lambda x, y: x + y)
    return out


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    m = np.asarray(matrix, dtype=np.float64)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), NORM_FLOOR)
