"""Token counts by a deterministic transducer: transitions carry the tokens they add, chunks compose as state maps."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batch, kept_in_worker, map_batches, vocabulary_bytes

LIMIT = 2048
#: Code points of a chunk, and what a worker keeps before the oldest goes.
CHUNK, KEPT_STATES, KEPT_RUNS = 1 << 16, 300_000, 500_000
#: Unicode white space, which ends every piece and is dropped.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUN = re.compile(f"[^{_SPACE}]+")
SPACE = re.compile(f"[{_SPACE}]")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


#: Where a later token can begin: its place in the text, the token before it ('' at the start of the piece) and how many
#: tokens the symbols after it have added.
Start = tuple[int, str, int]


class State:
    """*text*: the longest end of what was read that a token can go on from. *starts*: the places in it from which a token
    can go on, the last one behind it. Transitions and last symbols are filled in on use; *used* tells when."""

    __slots__ = ("text", "starts", "steps", "ends", "used")

    def __init__(self, text: str, starts: tuple[Start, ...]):
        self.text, self.starts = text, starts
        self.steps: dict[str, tuple[State, int]] = {}
        self.ends: dict[str, int] = {}
        self.used = 0


EMPTY_PIECE = "", ((0, "", 0),)


def forget_oldest(kept: dict, most: int) -> None:
    """Drop the older half of what is beyond *most* entries."""
    if len(kept) > most:
        for key in list(islice(kept, len(kept) // 2)):
            del kept[key]


class PieceTransducer:
    """BPE of one piece, read symbol by symbol.

    A token can follow another if the two encode to themselves, and exactly one token ending at a position follows the
    encoding before it. A later token can only begin where what was read goes on into it, so prefixes that agree in the
    longest end from which a token can go on, and in the tokens before the places where one can, can not be told apart by
    what follows: they are one state. A symbol leads to one state and adds a fixed number of
    tokens (negative where earlier ones melt). The last symbol of a piece carries the end mark. The vocabulary's prefixes
    are laid out once, transitions are compiled when first used, and those not used for longest go first.
    """

    def __init__(self, merges: list[tuple[str, str]], end: str):
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.end = end
        self.made = {a + b for a, b in merges}
        #: texts from which some token goes on
        self.goes_on = {""}
        for token in self.made:
            bare = token.removesuffix(end)
            self.goes_on.update(bare[:n] for n in range(1, len(bare)))
        self.fits: dict[tuple[str, str], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.start = State(*EMPTY_PIECE)
        self.states = {EMPTY_PIECE: self.start}
        self.now = 0

    def forget(self) -> None:
        """Keep the states used since the last time, and the links between them."""
        kept = {key: state for key, state in self.states.items() if state.used >= self.now or state is self.start}
        if len(kept) > KEPT_STATES // 2:
            kept = dict(islice(reversed(kept.items()), KEPT_STATES // 2)) | {EMPTY_PIECE: self.start}
        alive = {id(state) for state in kept.values()}
        for state in kept.values():
            state.steps = {letter: to for letter, to in state.steps.items() if id(to[0]) in alive}
        self.states, self.now = kept, self.now + 1

    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.end):
            bare = token.removesuffix(self.end)
            return [*bare[:-1], bare[-1] + self.end]
        return list(token)

    def encode(self, parts: list[str]) -> list[str]:
        """Merges of lowest rank first, leftmost on ties."""
        rank, never = self.rank.get, len(self.rank)
        ranks = [rank(pair, never) for pair in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == never:
                break
            i = ranks.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), never)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), never)
        return parts

    def follows(self, before: str, token: str) -> bool:
        """Whether *token* stands after *before* ('' at the start) in an encoding."""
        key = before, token
        if key not in self.fits:
            forget_oldest(self.fits, KEPT_STATES)
            alone = [before, token] if before else [token]
            self.fits[key] = self.encode([*self.symbols(before), *self.symbols(token)]) == alone
        return self.fits[key]

    def last_token(self, state: State, symbol: str) -> tuple[str, int]:
        """(last token after *symbol*, tokens that the symbol adds)."""
        whole, made = state.text + symbol, self.made
        for at, before, since in state.starts:
            token = whole[at:]
            if (token in made or token == symbol) and self.follows(before, token):
                return token, 1 - since
        raise ValueError(f"no token ends with {symbol!r}")

    def step(self, state: State, letter: str) -> tuple[State, int]:
        token, adds = self.last_token(state, letter)
        whole = state.text + letter
        open_ = [start for start in state.starts if whole[start[0]:] in self.goes_on]
        cut = open_[0][0] if open_ else len(whole)
        key = whole[cut:], (*((at - cut, before, since + adds) for at, before, since in open_), (len(whole) - cut, token, 0))
        to = self.states.get(key)
        if to is None:
            to = self.states[key] = State(*key)
        state.steps[letter] = to, adds
        return to, adds

    def count(self, piece: str) -> int:
        if len(self.states) > KEPT_STATES:
            self.forget()
        state, n, now = self.start, 0, self.now
        for letter in piece[:-1]:
            state, added = state.steps.get(letter) or self.step(state, letter)
            state.used = now
            n += added
        last = piece[-1]
        added = state.ends.get(last)
        if added is None:
            added = state.ends[last] = self.last_token(state, last + self.end)[1]
        return n + added


class ChunkMap(NamedTuple):
    """What a chunk does to the state before it: *head* continues the open run, *count* tokens follow whatever
    the state, *tail* is the run left open. Without white space (*whole*) the chunk only adds its head."""

    head: str
    count: int
    tail: str
    whole: bool


EMPTY = ChunkMap("", 0, "", True)


class PieceCounts(dict):
    """Tokens of pieces."""

    def __init__(self, transducer: PieceTransducer):
        super().__init__()
        self.transducer, self.letters = transducer, byte_letters()

    def __missing__(self, piece: str) -> int:
        n = self.transducer.count("".join([self.letters[b] for b in piece.encode("utf-8", "surrogatepass")]))
        if len(piece) <= 64:
            self[piece] = n
        return n


class RunCounts(dict):
    """Tokens of runs without white space."""

    def __init__(self, pattern, pieces: PieceCounts):
        super().__init__()
        self.pattern, self.pieces = pattern, pieces

    def __missing__(self, run: str) -> int:
        n = sum(map(self.pieces.__getitem__, self.pattern.findall(run)))
        if len(run) <= 64:
            self[run] = n
        return n


class TokenCounter:
    """Counts for a tokenizer file with BPE, an end mark and a splitting pattern, as its library gives them."""

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer
        spec = json.loads(data)
        self.normal = Tokenizer.from_str(data.decode()).normalizer
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.pieces = PieceCounts(PieceTransducer(merges, spec["model"]["end_of_word_suffix"]))
        self.runs = RunCounts(regex.compile(pattern), self.pieces)

    def normalized(self, text: str) -> str:
        """Composed and lower-cased; texts of Latin letters only are composed already."""
        return text.lower() if text.isascii() or max(text) < "\u0250" else self.normal.normalize_str(text)

    def chunk_map(self, chunk: str) -> ChunkMap:
        runs = RUN.findall(chunk)
        if not runs:
            return ChunkMap("", 0, "", not chunk)
        if len(runs[0]) == len(chunk):
            return ChunkMap(chunk, 0, "", True)
        head = "" if SPACE.match(chunk[0]) else runs.pop(0)
        tail = runs.pop() if runs and not SPACE.match(chunk[-1]) else ""
        return ChunkMap(head, sum(map(self.runs.__getitem__, runs)), tail, False)

    def compose(self, left: ChunkMap, right: ChunkMap) -> ChunkMap:
        if left.whole and right.whole:
            return ChunkMap(left.head + right.head, 0, "", True)
        if left.whole:
            return right._replace(head=left.head + right.head)
        if right.whole:
            return left._replace(tail=left.tail + right.head)
        between = left.tail + right.head
        return ChunkMap(left.head, left.count + (self.runs[between] if between else 0) + right.count, right.tail, False)

    def scan(self, maps: list[ChunkMap]) -> ChunkMap:
        """The maps' composition, neighbours first: log2 of their number rounds."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0] if maps else EMPTY

    def count(self, text: str, chunk: int = CHUNK) -> int:
        forget_oldest(self.runs, KEPT_RUNS)
        forget_oldest(self.pieces, KEPT_RUNS)
        total = 0
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:
                total += 1  # an added token stands for itself
            elif part:
                part = self.normalized(part)
                whole = self.scan([self.chunk_map(part[k:k + chunk]) for k in range(0, len(part), chunk)])
                total += whole.count + sum(self.runs[run] for run in (whole.head, whole.tail) if run)
        return total


def token_counts(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row. Narrow: no shuffle.

    A null text counts as empty: no bytes, no tokens. Repeated rows give repeated results; other columns are
    ignored; a null id stays null.
    """
    data = docs.sparkSession.sparkContext.broadcast(vocabulary_bytes(vocabulary))

    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        counter = kept_in_worker(("token counter", vocabulary), lambda: TokenCounter(data.value))
        for batch in batches:
            n = [counter.count(t or "") for t in batch["text"]]
            yield {"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": n,
                   "over_limit": [k > limit for k in n]}

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"))
    return map_batches(texts, work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
