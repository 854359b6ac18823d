"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened into arrays."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, Batch, held_out, map_batches, sized, stored

#: Bound of the labelled rows that the trees are fitted on: those with the least hash of their id.
FIT_ROWS = 20_000
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_WEIGHT = 80, 5, 64, 0.15, 1.0, 3.0

#: Per character class: letters, digits, space, ASCII punctuation by kind; anything beyond is told by str methods.
CLASSES = {"symbol_share": "#*$%&<>@^~=+\\/_", "bar_share": "|", "exclamation_share": "!?", "stop_share": ".,;:",
           "quote_share": "\"'()[]{}`-"}
FEATURES = ["log_chars", "log_words", "word_length", "word_spread", "long_word_share", "letter_share", "upper_share",
            "digit_share", "space_share", "beyond_ascii_share", *CLASSES, "lines", "words_per_line", "short_line_share",
            "unstopped_line_share", "repeated_line_share", "distinct_word_share", "top_word_share", "next_same_share",
            "repeated_gram_share", "capital_word_share", "upper_word_share", "marked_word_share", "character_entropy",
            "compressed_share"]
_BLANK = " \t\n\x0b\x0c\r"


def statistics(text: str | None) -> list[float]:
    """The FEATURES of a text; an empty one has zeros throughout."""
    text = text or ""
    words = WORD.findall(text)
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), len(text)
    data = text.encode("utf-8", "surrogatepass")
    at = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    share = lambda some: float(sum(at[ord(c)] for c in some)) / chars
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    counts = Counter(words)
    grams = list(zip(words, words[1:], words[2:]))
    letters = int(at[65:91].sum() + at[97:123].sum()) + len(re.findall("[^\x00-\x7f]", text))
    bytes_share = at[at > 0] / len(data)
    return [
        np.log1p(chars), np.log1p(n), float(lengths.mean()), float(lengths.std()), float((lengths > 12).mean()),
        letters / chars, float(at[65:91].sum()) / chars, float(at[48:58].sum()) / chars, share(_BLANK),
        float(at[192:].sum()) / chars, *(share(some) for some in CLASSES.values()), np.log1p(len(lines)),
        n / max(len(lines), 1), sum(len(line) < 40 for line in lines) / max(len(lines), 1),
        sum(not line.rstrip(_BLANK).endswith((".", "!", "?", ":", '"')) for line in lines) / max(len(lines), 1),
        1 - len(set(lines)) / max(len(lines), 1), len(counts) / n, max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n, 1 - len(set(grams)) / max(len(grams), 1),
        sum(w[0].isupper() for w in words) / n, sum(map(str.isupper, words)) / n,
        sum(not w[-1].isalnum() for w in words) / n, float(-(bytes_share * np.log2(bytes_share)).sum()),
        len(zlib.compress(data, 1)) / len(data),
    ]


@dataclass(frozen=True)
class Trees:
    """Perfect trees of one depth: inner node i has children 2i + 1 and 2i + 2."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    bound: np.ndarray  # trees x inner nodes: right if above
    leaf: np.ndarray  # trees x leaves

    def probability(self, x: np.ndarray) -> np.ndarray:
        """All rows pass all trees level by level."""
        trees, inner = self.feature.shape
        if not trees or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.start)))
        node = np.zeros((len(x), trees), dtype=np.int64)
        which, rows = np.arange(trees), np.arange(len(x))[:, None]
        while node[0, 0] < inner:
            node = 2 * node + 1 + (x[rows, self.feature[which, node]] > self.bound[which, node])
        return 1 / (1 + np.exp(-(self.start + self.leaf[which, node - inner].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Logistic boosting on histograms of quantile bins. Without rows the probability is 1/2 everywhere."""
    rows, n_features = len(x), len(FEATURES)
    inner = 2 ** depth - 1
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if rows else 0.5
    start = float(np.log(share / (1 - share)))
    if not rows or y.min() == y.max():
        return Trees(start, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(n_features)], axis=1)
    feature, bound = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    score = np.full(rows, start)
    offsets = np.arange(n_features) * BINS
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        node = np.zeros(rows, dtype=np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            place = ((node - first)[:, None] * (n_features * BINS) + offsets + binned).ravel()
            shape = (width, n_features, BINS)
            hist_g = np.bincount(place, np.repeat(g, n_features), width * n_features * BINS).reshape(shape)
            hist_h = np.bincount(place, np.repeat(h, n_features), width * n_features * BINS).reshape(shape)
            left_g, left_h = hist_g.cumsum(2)[:, :, :-1], hist_h.cumsum(2)[:, :, :-1]
            all_g, all_h = hist_g.sum(2)[:, :, None], hist_h.sum(2)[:, :, None]
            gain = (left_g ** 2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE)
                    - all_g ** 2 / (all_h + RIDGE))
            gain[(left_h < LEAST_WEIGHT) | (all_h - left_h < LEAST_WEIGHT)] = 0
            for k in range(width):
                f, b = divmod(int(gain[k].argmax()), BINS - 1)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[t, first + k], bound[t, first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(rows), feature[t, node]] > bound[t, node])
        at = node - inner
        leaf[t] = RATE * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + RIDGE)
        score += leaf[t, at]
    return Trees(start, feature, bound, leaf)


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, label, features) of docs (doc_id, label, text)."""
    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "label": batch["label"], "features": [statistics(t) for t in batch["text"]]}

    return map_batches(docs.select("doc_id", "label", "text"), work, "doc_id long, label int, features array<double>")


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Trees:
    """Trees for labels (doc_id, label) of docs (doc_id, text), on at most *fit_rows* rows.

    Null ids and labels are left out; of several labels of an id the largest counts. Rows that share an id and a text
    are one row. The bound is on rows, drawn after they have met their labels, by a hash of the id.
    """
    known = labels.dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    keys = (docs.join(known, "doc_id").select("doc_id", "label", F.sha2(F.coalesce("text", F.lit("")), 256).alias("of_text"))
            .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "of_text").limit(fit_rows))
    drawn = sized(stored(keys))
    chosen = docs.withColumn("of_text", F.sha2(F.coalesce("text", F.lit("")), 256)).join(drawn, ["doc_id", "of_text"])
    one_each = chosen.dropDuplicates(["doc_id", "of_text"])
    rows = with_statistics(one_each).toPandas()
    x = np.array(rows["features"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    order = np.lexsort((*x.T, rows["doc_id"].to_numpy()))  # the same trees however the rows arrive
    return fit(x[order], rows["label"].to_numpy(dtype=np.float64)[order])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row; narrow but for the bounded fit.

    Learns from labelled rows that are not held out (1 of 5). A null text counts as empty, and an empty text has
    zero statistics and is scored like any other; without labels all scores are 1/2. Repeated rows give
    repeated results; other columns are ignored; a null id is scored and not held out.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    trees = train(texts, known.filter(~held_out(F.col("doc_id"), 5, 0)), fit_rows)
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        for batch in batches:
            x = np.array([statistics(t) for t in batch["text"]], dtype=np.float64)
            p = model.value.probability(x)
            yield {"doc_id": batch["doc_id"], "score": p.tolist(), "predicted": (p >= THRESHOLD).astype(int).tolist()}

    return (map_batches(texts, work, "doc_id long, score double, predicted int")
            .withColumn("held_out", held_out(F.col("doc_id"), 5, 0)))
