"""Secret scans: fixed base patterns, and weak credential parts reported where complementary parts meet."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, Batch, map_batches

# Fixed by the contract.
ASSIGN = re.compile("(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.ASCII | re.IGNORECASE)
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")  # runs are maximal, so the length can stand in the pattern
ASSIGN_MIN, ACCESS_MIN = 6, 20

# Weak parts: none says much alone.
IDENTIFIER = re.compile("(?<![A-Za-z0-9])(?:access[_-]?key(?:[_-]?id)?|client[_-]?id|account[_-]?id|user(?:name)?|login)"
                        "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.@=-]{4,})", re.ASCII | re.IGNORECASE)
IDENTIFIER_HINTS = ("access", "client", "account", "user", "login")
BARE_SECRET = re.compile("(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile("[a-z][a-z0-9+.-]{1,15}://[^\\s\"'<>|]{4,}", re.ASCII | re.IGNORECASE)
SCOPE_END = re.compile("\\n[\\x20\\t\\r]*\\n")

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
#: The part a kind plays in a credential.
ROLE = {"assign": "secret", "hex": "secret", "secret": "secret", "access": "identifier", "identifier": "identifier",
        "endpoint": "endpoint"}
#: A weak part is reported if a part of one of these roles lies in reach within its scope.
NEEDS = {"identifier": ("secret",), "secret": ("identifier", "endpoint"), "endpoint": ("secret",)}
#: Default of the look-up alone; scans and masking let parts meet anywhere in their scope.
REACH = 400
SECRET_BITS = 3.5

SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "found array<struct<kind:string,start:int,end:int>>")


class Span(NamedTuple):
    start: int
    end: int
    kind: str


def in_order(spans) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def base_spans(text: str) -> list[Span]:
    spans = []
    lowered = text.lower()
    if any(hint in lowered for hint in ASSIGN_HINTS):
        spans += [Span(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    spans += [Span(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_MIN]
    spans += [Span(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return in_order(spans)


def looks_random(token: str) -> bool:
    """Letters and digits of both cases with a high entropy per character."""
    if not (re.search("[a-z]", token) and re.search("[A-Z]", token) and re.search("[0-9]", token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= SECRET_BITS


def weak_parts(text: str, base: list[Span]) -> list[Span]:
    """Weak candidates that do not overlap a base span."""
    parts = []
    lowered = text.lower()
    if any(hint in lowered for hint in IDENTIFIER_HINTS):
        parts += [Span(m.start(), m.end(), "identifier") for m in IDENTIFIER.finditer(text)]
    if "://" in text:
        parts += [Span(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    parts += [Span(m.start(), m.end(), "secret") for m in BARE_SECRET.finditer(text) if looks_random(m[0])]
    base_ends, base_starts, taken = [], [], 0
    for s in base:  # running maximum of ends, so that one search tells of any overlap
        taken = max(taken, s.end)
        base_starts.append(s.start)
        base_ends.append(taken)
    free = []
    for p in in_order(parts):
        before = bisect_left(base_starts, p.end)
        if not before or base_ends[before - 1] <= p.start:
            free.append(p)
    return free


def linked(text: str, base: list[Span], weak: list[Span], reach: int | None = REACH) -> list[Span]:
    """The weak parts that meet a complementary part: an interval join of sorted spans, without listing pairs.

    Two parts meet if both lie in one scope (no blank line between them) and at most *reach* characters apart (None: any
    number).
    """
    if not weak:
        return []
    scope_ends = [m.start() for m in SCOPE_END.finditer(text)]
    by_role: dict[tuple[str, int], list[Span]] = {}
    for s in in_order([*base, *weak]):
        by_role.setdefault((ROLE[s.kind], bisect_left(scope_ends, s.end)), []).append(s)
    keys = {k: ([s.start for s in spans], max(s.end - s.start for s in spans)) for k, spans in by_role.items()}

    def meets(part: Span, role: str) -> bool:
        key = (role, bisect_left(scope_ends, part.end))
        if key not in by_role:
            return False
        if reach is None:
            return True
        starts, longest = keys[key]
        low = bisect_left(starts, part.start - reach - longest)
        high = bisect_right(starts, part.end + reach)
        return any(s.end >= part.start - reach for s in by_role[key][low:high])

    return [p for p in weak if any(meets(p, role) for role in NEEDS[p.kind])]


def digest(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def find_secrets(docs: DataFrame, reach: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts, digest of the base spans, and all spans in code points.

    Scopes lie within a document, so the job is narrow: no shuffle. A null text counts as empty; repeated
    rows give repeated results; other columns are ignored; a null id stays null.
    """
    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                text = text or ""
                base = base_spans(text)
                spans = in_order([*base, *linked(text, base, weak_parts(text, base), reach)])
                n = Counter(s.kind for s in base)
                rows.append((doc_id, n["assign"], n["access"], n["hex"],
                             hashlib.sha256(digest(base).encode()).hexdigest(), digest(spans),
                             [{"kind": s.kind, "start": s.start, "end": s.end} for s in spans]))
            yield dict(zip(names, map(list, zip(*rows))))

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                       work, SCHEMA)


def masked(text: str, reach: int | None = None) -> str:
    """*text* with each run of overlapping spans replaced by the kind of its first, in brackets."""
    base = base_spans(text)
    out, at, end = [], 0, 0
    for s in in_order([*base, *linked(text, base, weak_parts(text, base), reach)]):
        if s.start >= end:
            out += [text[max(at, end):s.start], f"[{s.kind}]"]
            at = s.start
        end = max(end, s.end)
    return "".join([*out, text[end:]])


def redact(docs: DataFrame, reach: int | None = None, text_col: str = "text") -> DataFrame:
    """*docs* with every span masked in *text_col*; all other columns and rows stay, a null text stays null."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    mask = F.pandas_udf(lambda texts: texts.map(lambda t: t if t is None else masked(t, reach)), "string")
    return docs.withColumn(text_col, mask(F.col(text_col)))
