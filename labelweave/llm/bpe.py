"""Byte-level BPE as a monoid: halves are encoded apart, neighbours joined by re-encoding their border."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batch, kept_in_worker, map_batches, vocabulary_bytes

#: Pieces of up to this many bytes are merged directly.
LEAF = 64
#: Tokens on each side of a border that are encoded anew at first; doubled until the ends stand.
BORDER = 4
#: Pieces whose tokens a worker keeps; the store is emptied when full, and long pieces are not kept.
KEPT_PIECES, KEPT_BYTES = 400_000, 64

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class ByteBPE:
    """Encoding of single pieces by merge ranks, lowest rank first, leftmost on ties.

    Join: a sequence of tokens is the encoding of its bytes if and only if each two neighbours are the
    encoding of theirs. Tokens left of a window are untouched as long as the window's first token
    comes out as before, and likewise on the right; else the window grows.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern)
        self.pieces: dict[str, tuple[int, str, bytes]] = {}

    def merged(self, data: bytes) -> list[int]:
        """Leaf: merge the neighbours of lowest rank until none is left."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank, never = self.ranks.get, len(self.ranks)
        ranks = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks:
            lowest = min(ranks)
            if lowest == never:
                break
            i = ranks.index(lowest)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], never)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], never)
        return [self.ranks[p] for p in parts]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours' bytes; associative, with [] as its unit."""
        if not left or not right:
            return left or right
        take = BORDER
        while True:
            a, b = left[-take:], right[:take]
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, [*a, *b])))
            left_stands = len(a) == len(left) or window[0] == a[0]
            right_stands = len(b) == len(right) or window[-1] == b[-1]
            if left_stands and right_stands:
                return left[:len(left) - len(a)] + window + right[len(b):]
            take *= 2

    def tree(self, data: bytes) -> list[int]:
        """Encode by halves: level by level from the leaves up, so depth costs no call stack."""
        level = [self.merged(data[i:i + LEAF]) for i in range(0, len(data), LEAF)]
        while len(level) > 1:
            level = [self.join(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0] if level else []

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.tree(data)

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of *ids*, joined pairwise up the tree."""
        level = [self.bytes_of[i] for i in ids]
        while len(level) > 1:
            level = [b"".join(level[i:i + 64]) for i in range(0, len(level), 64)]
        return level[0] if level else b""

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.split.findall(text) for i in self.encode_piece(piece.encode())]

    def piece(self, piece: str) -> tuple[int, str, bytes]:
        """(number of ids, ids as text, decoded bytes) of a piece."""
        found = self.pieces.get(piece)
        if found is None:
            ids = self.encode_piece(piece.encode())
            found = len(ids), " ".join(map(str, ids)), self.decode(ids)
            if len(piece) <= KEPT_BYTES:
                if len(self.pieces) >= KEPT_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = found
        return found


def encode_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", with_ids: bool = False,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: number of tokens, digests of the ids and of the bytes decoded from them.

    *with_ids* adds the ids themselves as array<int>. The pattern's matches cover a text without gaps and
    tokens never cross them, so a text's ids are those of its pieces in order. Narrow: no shuffle. A null
    text counts as empty; repeated rows give repeated results; other columns are ignored; a null id stays null.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(vocabulary_bytes(vocabulary))
    schema = SCHEMA + (", ids array<int>" if with_ids else "")

    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        bpe = kept_in_worker(("byte bpe", vocabulary), lambda: ByteBPE(read_ranks(ranks.value)))
        for batch in batches:
            out: Batch = {"doc_id": batch["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            if with_ids:
                out["ids"] = []
            for text in batch["text"]:
                pieces = [bpe.piece(p) for p in bpe.split.findall(text or "")]
                ids = " ".join(p[1] for p in pieces)
                out["n_tokens"].append(sum(p[0] for p in pieces))
                out["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(b"".join(p[2] for p in pieces)).hexdigest())
                if with_ids:
                    out["ids"].append([int(i) for i in ids.split()])
            yield out

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                       work, schema)


def decode_documents(encoded: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id",
                     ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded binary) of id lists; a null list gives null, an empty one no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(vocabulary_bytes(vocabulary))

    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        bpe = kept_in_worker(("byte bpe", vocabulary), lambda: ByteBPE(read_ranks(ranks.value)))
        for batch in batches:
            yield {"doc_id": batch["doc_id"],
                   "decoded": [None if ids is None else bpe.decode(ids) for ids in batch["ids"]]}

    return map_batches(encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")),
                       work, "doc_id long, decoded binary")
