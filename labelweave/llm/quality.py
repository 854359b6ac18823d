"""Quality rules: base text statistics, and tokeniser fertility in bands per language or script."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, WORD, Batch, kept_in_worker, map_batches, vocabulary_bytes

SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"
WINDOW = 5
#: Words whose measures a worker keeps; the store is emptied when full.
KEPT_WORDS = 400_000


@dataclass(frozen=True)
class Band:
    """A text is rejected outside of these bounds.

    The entropy of n tokens cannot exceed log2(n), so its bound is a share of log2(n), judged from
    *entropy_from* tokens on.
    """

    chars_per_token_min: float
    chars_per_token_max: float
    fallback_share_max: float
    entropy_share_min: float
    entropy_from: int = 40


#: By language where one has an entry, else by the script of most letters.
BANDS = {
    "Latin": Band(1.2, 8.0, 0.10, 0.45),
    "Greek": Band(0.6, 8.0, 0.30, 0.40),
    "Cyrillic": Band(0.9, 8.0, 0.30, 0.40),
    "Han": Band(0.25, 4.0, 0.90, 0.40),
    "Kana": Band(0.25, 4.0, 0.90, 0.40),
    "Hangul": Band(0.25, 4.0, 0.95, 0.40),
    "Arabic": Band(0.4, 8.0, 0.50, 0.40),
    "Hebrew": Band(0.4, 8.0, 0.50, 0.40),
    "Indic": Band(0.25, 8.0, 0.90, 0.40),
    "Other": Band(0.25, 8.0, 0.95, 0.40),
}
#: First and last code point of the blocks whose letters decide a script (fixed by Unicode).
BLOCKS = [
    (0x41, 0x24F, "Latin"), (0x1E00, 0x1EFF, "Latin"), (0x370, 0x3FF, "Greek"), (0x1F00, 0x1FFF, "Greek"),
    (0x400, 0x52F, "Cyrillic"), (0x590, 0x5FF, "Hebrew"), (0x600, 0x77F, "Arabic"), (0x900, 0xDFF, "Indic"),
    (0x1100, 0x11FF, "Hangul"), (0x3040, 0x30FF, "Kana"), (0x3400, 0x9FFF, "Han"), (0xAC00, 0xD7AF, "Hangul"),
    (0xF900, 0xFAFF, "Han"), (0x20000, 0x3134F, "Han"),
]

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, script string, chars_per_token double, fallback_share double, "
          "token_entropy double")


SCRIPTS = sorted({name for _, _, name in BLOCKS} | {"Other"})


def script_of(word: str) -> int:
    """Number of the script of most letters of *word* in SCRIPTS, -1 without letters."""
    if word.isascii():
        return SCRIPTS.index("Latin") if any(map(str.isalpha, word)) else -1
    seen: Counter[str] = Counter()
    for ch in word:
        if ch.isalpha():
            code = ord(ch)
            seen[next((name for low, high, name in BLOCKS if low <= code <= high), "Other")] += 1
    return SCRIPTS.index(min(seen, key=lambda s: (-seen[s], s))) if seen else -1


class Fertility:
    """Token ids, fallback tokens and script of words under one vocabulary with byte fallback.

    Words are numbered as they come; what belongs to a number stands in flat arrays, so that a text is
    measured by array look-ups.
    """

    def __init__(self, model: bytes):
        import sentencepiece
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.is_byte = np.array([self.processor.is_byte(i) for i in range(self.processor.vocab_size())])
        self.number: dict[str, int] = {}
        self.first = np.zeros(KEPT_WORDS, dtype=np.int64)  # where a word's tokens begin in self.tokens
        self.size, self.n_bytes, self.script, self.length = (np.zeros(KEPT_WORDS, dtype=np.int64) for _ in range(4))
        self.tokens = np.zeros(4 * KEPT_WORDS, dtype=np.int64)
        self.filled = 0

    def learn(self, words: list[str]) -> None:
        """Number those of the distinct *words* that have none yet."""
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > len(self.first):
            self.number.clear()
            self.filled = 0
            new = words
            if len(new) > len(self.first):
                for name in ("first", "size", "n_bytes", "script", "length"):
                    setattr(self, name, np.zeros(2 * len(new), dtype=np.int64))
        if not new:
            return
        ids = self.processor.encode(new, num_threads=1)
        at = slice(len(self.number), len(self.number) + len(new))
        self.number.update(zip(new, range(at.start, at.stop)))
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(new))
        tokens = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(sizes.sum()))
        if self.filled + len(tokens) > len(self.tokens):
            self.tokens = np.concatenate([self.tokens[:self.filled], np.zeros(self.filled + 2 * len(tokens), np.int64)])
        self.tokens[self.filled:self.filled + len(tokens)] = tokens
        ends = np.cumsum(sizes)
        self.first[at], self.size[at] = self.filled + ends - sizes, sizes
        bytes_so_far = np.concatenate([[0], np.cumsum(self.is_byte[tokens])])
        self.n_bytes[at] = bytes_so_far[ends] - bytes_so_far[ends - sizes]
        self.script[at] = np.fromiter(map(script_of, new), dtype=np.int64, count=len(new))
        self.length[at] = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
        self.filled += len(tokens)

    def measure(self, counts: Counter) -> tuple[str, int, int, float]:
        """(script, tokens, fallback tokens, entropy in bits) of a text given as counts of numbered words."""
        if not counts:
            return "", 0, 0, 0.0
        which = np.fromiter(map(self.number.__getitem__, counts), dtype=np.int64, count=len(counts))
        times = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
        sizes, script = self.size[which], self.script[which]
        n_tokens = int(sizes @ times)
        letters = np.bincount(script + 1, times * self.length[which], len(SCRIPTS) + 1)[1:]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(self.first[which] - ends + sizes, sizes)
        tokens, group = np.unique(self.tokens[places], return_inverse=True)
        shares = np.bincount(group, np.repeat(times, sizes), len(tokens)) / max(n_tokens, 1)
        main = SCRIPTS[int(letters.argmax())] if letters.any() else "Other"
        return main, n_tokens, int(self.n_bytes[which] @ times), abs(float(-(shares * np.log2(shares)).sum()))


def repeat_words(words: list[str]) -> int:
    """Words that lie in a 5-word window which the text holds more than once."""
    grams = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    starts = np.array([counts[g] > 1 for g in grams])
    covered = np.zeros(len(words), dtype=bool)
    for i in range(WINDOW):
        covered[i:i + len(starts)] |= starts
    return int(covered.sum())


def base_statistics(text: str, words: list[str]) -> tuple[int, int, int, int]:
    """(word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    lines = [line for line in text.split("\n") if line.strip(BLANK)]
    return (sum(map(len, words)), sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)),
            repeat_words(words))


def in_band(band: Band, chars_per_token: float, fallback_share: float, entropy: float, n_tokens: int) -> bool:
    if not band.chars_per_token_min <= chars_per_token <= band.chars_per_token_max:
        return False
    if fallback_share > band.fallback_share_max:
        return False
    return n_tokens < band.entropy_from or entropy >= band.entropy_share_min * math.log2(n_tokens)


def judged(texts: list[str | None], langs: list[str | None], fertility: Fertility, bands: dict[str, Band]) -> list[tuple]:
    """The columns of SCHEMA but the id, for each text."""
    rows = []
    for text, lang in zip(texts, langs):
        text = text or ""
        words = WORD.findall(text)
        n, counts = len(words), Counter(words)
        fertility.learn(list(counts))
        chars, symbols, dup_lines, repeated = base_statistics(text, words)
        failed = n < 10 or 100 * repeated > 20 * n
        script, n_tokens, n_bytes, entropy = fertility.measure(counts)
        per_token, fallback = chars / max(n_tokens, 1), n_bytes / max(n_tokens, 1)
        band = bands.get(lang) or bands.get(script) or bands["Other"]
        kept = not failed and in_band(band, per_token, fallback, entropy, n_tokens)
        rows.append((n, chars, symbols, dup_lines, repeated, failed, kept, script or None, per_token, fallback, entropy))
    return rows


def quality_rules(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", bands: dict[str, Band] | None = None,
                  id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """One row per input row with the base statistics, the fertility measures and the verdict *kept*.

    A text is measured word by word: characters of words per token, share of byte-fallback tokens,
    entropy of its tokens. The bands are those of its language if *lang_col* is given and has an
    entry, else of its main script. Narrow: no shuffle. Null and empty texts have no words and fail the
    base rules; repeated rows give repeated results; other columns are ignored; a null id stays null.
    """
    model = docs.sparkSession.sparkContext.broadcast(vocabulary_bytes(vocabulary))
    chosen = dict(bands or BANDS)
    names = [part.split()[0] for part in SCHEMA.split(", ")][1:]

    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        fertility = kept_in_worker(("fertility", vocabulary), lambda: Fertility(model.value))
        for batch in batches:
            rows = judged(batch["text"], batch["lang"], fertility, chosen)
            yield {"doc_id": batch["doc_id"], **dict(zip(names, map(list, zip(*rows))))}

    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                                   lang.alias("lang")), work, SCHEMA)


def keep_by_rules(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", bands: dict[str, Band] | None = None,
                  text_col: str = "text") -> DataFrame:
    """The rows of *docs* with a true verdict, all columns as they are. Narrow: the verdict is found on the spot."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    model = spark.sparkContext.broadcast(vocabulary_bytes(vocabulary))
    chosen = dict(bands or BANDS)

    def verdicts(texts: pd.Series) -> pd.Series:
        fertility = kept_in_worker(("fertility", vocabulary), lambda: Fertility(model.value))
        rows = judged(texts.tolist(), [None] * len(texts), fertility, chosen)
        return pd.Series([row[names.index("kept")] for row in rows], dtype=bool)

    names = [part.split()[0] for part in SCHEMA.split(", ")][1:]
    return docs.filter(F.pandas_udf(verdicts, "boolean")(F.col(text_col)))
