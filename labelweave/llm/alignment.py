"""Alignment of two tokenizers: where their tokens end together, and which ids meet there how often in the corpus.

Both tokenizers tell spans: one in characters of the text, one in bytes of it. These are coarse cuts; where a span is
not as long as the bytes its token decodes to (bytes of one character, byte-fallback pieces, spaces that a span leaves
out), the token's own bytes say where it ends. What a text's tokens spell must be the text itself, byte for byte, or it
counts as without tokens.

A text is cut before single spaces within it. Neither tokenizer has a token across such a place (the first by its
pattern; of the second's pieces none may hold a space after another character, else texts stay whole), so the parts
align one by one, tokens end together at every cut, and a worker aligns a part that occurs again only once.

Corpus-wide counts are added up by Spark. The counts of the commonest pairs go to the tasks (at most
1 / COMMON_SHARE pairs can hold that share of all links); links of other pairs meet their counts in a join, one row per
text and pair. Nothing is left out either way.

Null and empty texts have no tokens; rows with null or shared ids, and rows that are equal, are each counted. An empty
table gives no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import kept_in_worker, map_batches, stored, vocabulary_bytes, written

CHARACTER_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"

COMMON_SHARE = 1 / 400_000   # pairs with a greater share of all links are sent to the tasks
CHARACTERS_PER_CALL = 100_000
KEPT_PARTS = 250_000         # aligned parts a worker keeps, twice; older ones go
KEPT_CHARACTERS = 200        # longer parts are not kept

#: A space between characters that no definition counts as white space.
_SOLID = "[^\\s\u180e\u200b\ufeff]"
_CUT = re.compile(f"(?<={_SOLID}) (?={_SOLID})")
_ENDS = re.compile(f"{_SOLID}(?:.*{_SOLID})?\\Z", re.DOTALL)
_NO_CUT = re.compile(f" (?:(?<!{_SOLID} )|(?!{_SOLID}))")  # any other space

_SPACE = "▁"


def byte_symbols() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte: itself, or one from 256 up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + at): b for at, b in enumerate(rest)}


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(_SPACE, " ").encode()


class Part(NamedTuple):
    """An aligned part of a text; *pairs* are its links, one by one."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    pairs: list[int]


def refine(coarse_start: np.ndarray, coarse_end: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: their spans' ends, or, for those whose span is not as long as their bytes, by their bytes."""
    exact = np.cumsum(sizes)
    return np.where(coarse_end - coarse_start == sizes, coarse_end, exact)


class Aligner:
    """Both tokenizers with the bytes of every token."""

    def __init__(self, character_model: bytes, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.by_character = Tokenizer.from_str(character_model.decode())
        self.by_character.encode_special_tokens = True
        self.by_piece = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        symbols = byte_symbols()
        size = self.by_character.get_vocab_size()
        entries = [self.by_character.id_to_token(i) for i in range(size)]
        # an entry outside the byte alphabet is a special token, which is never produced
        self.a_bytes = [bytes(symbols.get(c, 0) for c in entry or "") for entry in entries]
        self.b_bytes = [piece_bytes(self.by_piece.id_to_piece(i)) for i in range(self.by_piece.get_piece_size())]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        # how an id is written before a token of its group, and at the end of its side
        self.base = len(self.a_bytes)
        written = [str(i) for i in range(max(self.base, len(self.b_bytes)))]
        self.written = np.array([f"{w}{mark}" for n, mark in ((self.base, ","), (self.base, "|"), (len(self.b_bytes), ","),
                                                              (len(self.b_bytes), ";")) for w in written[:n]], dtype=object)

        # no piece may reach over a cut
        self.cuts = not any(re.search(f"[^{_SPACE}]{_SPACE}", self.by_piece.id_to_piece(i)) for i in range(len(self.b_bytes)))

    def cut(self, text: str) -> list[str]:
        """The parts of *text*, each without the space before it, which both tokenizers see in front of a text."""
        if not self.cuts:
            return [text]
        if not _NO_CUT.search(text):
            return text.split(" ")
        first, *rest = _CUT.split(" " + text)
        return [first[1:], *rest]

    def align(self, parts: list[str]) -> list[Part | None]:
        """The alignment of each of *parts*; None where either tokenizer's tokens do not spell it.

        Parts without white space at their ends are tokenized as one text, in which each of them is cut off again.
        """
        solid = [at for at, part in enumerate(parts) if self.cuts and _ENDS.match(part)]
        out: list[Part | None] = [None] * len(parts)
        for at, part in zip(solid, self._together([parts[at] for at in solid])):
            out[at] = part
        for at in set(range(len(parts))).difference(solid):
            out[at] = self._together([parts[at]])[0]
        return out

    def _together(self, parts: list[str]) -> list[Part | None]:
        if not parts:
            return []
        text = " ".join(parts)
        first = self.by_character.encode(" " + text, add_special_tokens=False)
        second = self.by_piece.encode(text, return_type="offset_mapping", return_bytes=True, num_threads=1)
        whole, a, b = (" " + text).encode(), first.ids, second["ids"]
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            half = len(parts) // 2
            return [None] if not half else self._together(parts[:half]) + self._together(parts[half:])
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        spans = np.array(first.offsets, dtype=np.int64).reshape(-1, 2)
        sizes = np.array([len(part) + 1 for part in parts])
        if len(whole) > len(text) + 1:  # characters to bytes
            wide = np.frombuffer((" " + text).encode("utf-32-le"), dtype=np.uint32)
            size = 1 + (wide > 0x7F).astype(np.int64) + (wide > 0x7FF) + (wide > 0xFFFF)
            offset = np.r_[0, np.cumsum(size)]
            spans, after = offset[spans], offset[np.cumsum(sizes)]
        else:
            after = np.cumsum(sizes)
        a_ends = refine(spans[:, 0], spans[:, 1], self.a_sizes[a])
        # spans in bytes, counted without the space that goes before the text
        spans = np.array(second["offsets"], dtype=np.int64).reshape(-1, 2) + 1
        spans[0, 0] = 0
        b_ends = refine(spans[:, 0], spans[:, 1], self.b_sizes[b])
        cuts, i, j = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        pairs, words = ((a[i] << 32) | b[j]).tolist(), self._written(a, a_ends, b, b_ends, cuts)
        ends = [np.searchsorted(each, after, side="right") for each in (a_ends, b_ends, cuts)]
        cut_to, word_to = ends[2].tolist(), (ends[0] + ends[1]).tolist()
        n_a, n_b = np.diff(ends[0], prepend=0).tolist(), np.diff(ends[1], prepend=0).tolist()
        cut_from, word_from = [0, *cut_to], [0, *word_to]
        return [Part(n_a[at], n_b[at], cut_to[at] - cut_from[at], "".join(words[word_from[at]:word_to[at]])[:-1],
                     pairs[cut_from[at]:cut_to[at]]) for at in range(len(parts))]

    def _written(self, a, a_ends, b, b_ends, cuts) -> list[str]:
        """`a1,a2|b1;a3|b2,b3;` in pieces, one per id: either side between consecutive common ends."""
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        a_last, b_last = cuts[a_group] == a_ends, cuts[b_group] == b_ends
        code = np.concatenate([a + self.base * a_last, 2 * self.base + b + len(self.b_bytes) * b_last])
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        return self.written[code[order]].tolist()


class Parts:
    """Aligned parts by their text, in two generations so that those in use stay."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.young: dict[str, Part | None] = {}
        self.old: dict[str, Part | None] = {}

    def of(self, texts: set[str]) -> dict[str, Part | None]:
        """The alignment of each of *texts*; None where its tokens do not spell it."""
        found, new = {}, []
        for text in texts:
            if text in self.young:
                found[text] = self.young[text]
            elif text in self.old:
                found[text] = self.young[text] = self.old[text]
            else:
                new.append(text)
        for call in _calls(new):
            for text, part in zip(call, self.aligner.align(call)):
                found[text] = part
                if len(text) <= KEPT_CHARACTERS:
                    self.young[text] = part
        if len(self.young) > KEPT_PARTS:
            self.young, self.old = {}, self.young
        return found


def _calls(texts: list[str]):
    """Lists of *texts* of a bounded number of characters, or of one text."""
    call, held = [], 0
    for text in texts:
        if call and held + len(text) > CHARACTERS_PER_CALL:
            yield call
            call, held = [], 0
        call.append(text)
        held += len(text)
    if call:
        yield call


_ALIGNED = ("doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs array<long>, times array<int>")


def align_documents(docs: DataFrame, character_vocabulary: str = CHARACTER_VOCABULARY,
                    piece_vocabulary: str = PIECE_VOCABULARY, with_groups: bool = False) -> DataFrame:
    """Per row its token counts, its groups (as a digest, or as text *with_groups*) and its distinct linked id pairs.

    A pair is a_id * 2^32 + b_id, with how often it is linked in the text.
    """
    models = vocabulary_bytes(character_vocabulary), vocabulary_bytes(piece_vocabulary)

    def work(batches):
        parts = kept_in_worker(("aligner", hash(models)), lambda: Parts(Aligner(*models)))
        gc.set_threshold(200_000, 20, 100)  # many small objects that stay, and no cycles
        for batch in batches:
            out = {name.split(" ")[0]: [] for name in schema.split(", ")}
            cut = [parts.aligner.cut(text) if text else [] for text in batch["text"]]
            known = parts.of({part for each in cut for part in each})
            for doc_id, row, each in zip(batch["doc_id"], batch["row"], cut):
                counts, groups, links = (0, 0, 0, 0), "", Counter()
                aligned = [known[part] for part in each]
                if aligned and None not in aligned:
                    groups = ";".join([part.groups for part in aligned])
                    links = Counter([pair for part in aligned for pair in part.pairs])
                    counts = [sum([part[at] for part in aligned]) for at in range(3)] + [links.total()]
                for name, value in zip(out, (doc_id, row, *counts)):
                    out[name].append(value)
                out["groups_sha256"].append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                out["pairs"].append(list(links.keys()))
                out["times"].append(list(links.values()))
                if with_groups:
                    out["groups"].append(groups)
            yield out

    schema = _ALIGNED + (", groups string" if with_groups else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    return map_batches(rows, work, schema)


def _links(aligned: DataFrame) -> DataFrame:
    """(row, pair, times): one row per text and distinct pair."""
    return aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): how many links hold each id pair, and whether none of its second id's pairs has more."""
    counts = stored(_links(aligned).groupBy("pair").agg(F.sum("times").alias("count")))
    second = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    top = counts.groupBy(second.alias("b")).agg(F.max("count").alias("top"))
    # one row per id of the second vocabulary
    return stored(counts.join(F.broadcast(top), second == F.col("b")).select(
        "pair", "count", (F.col("count") == F.col("top")).alias("best")))


def align_tokenizers(docs: DataFrame, common_share: float = COMMON_SHARE) -> DataFrame:
    """Per row n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256. *common_share* changes cost, not results."""
    aligned = written(align_documents(docs))
    counts, links = pair_counts(aligned), _links(aligned)
    least = (counts.agg(F.sum("count")).first()[0] or 0) * common_share
    common = F.broadcast(counts.where(F.col("count") >= least))  # at most 1 / common_share pairs reach the share
    rare = links.join(common.select("pair"), "pair", "left_anti").join(counts.where(F.col("count") < least), "pair")
    times = F.col("times").cast("long")
    sums = links.join(common, "pair").unionByName(rare).groupBy("row").agg(
        F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"), F.sum(F.col("count") * times).alias("count_sum"))
    none = F.lit(0).cast("long")
    return aligned.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
