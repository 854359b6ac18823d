"""Merkle manifest, tokenizer alignment and piecewise fingerprints against plain second versions."""

import hashlib
import itertools
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF
from labelweave.llm import alignment, merkle, piecewise

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, node int, part int, row string"


def documents(spark, rows, slices=3):
    """*rows* of (doc_id, text, source), with further columns whose names the operators use inside."""
    full = [(i, t, "en", s, None if t is None else len(t), "x", 1, 2, "y") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(slices)


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


# --- Merkle manifest ---------------------------------------------------------

def plain_manifest(rows):
    def leaf(i, text, s, n):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, "en", n, text)))

    def climb(level, at):
        """Levels above *level* and the siblings of place *at* on the way up."""
        path = []
        while len(level) > 1:
            run = at // 3 * 3
            path.append((level[run:at], level[at + 1:run + 3]))
            level, at = [H("".join(level[k:k + 3])) for k in range(0, len(level), 3)], at // 3
        return level[0], path

    trees = {}
    for i, text, s in rows:
        n = None if text is None else len(text)
        even = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        changed = text.replace("\n", "") if even and text is not None else text
        trees.setdefault(s, []).append((i, leaf(i, text, s, n), leaf(i, changed, s, n)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        trees[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    subroots = [climb([x[1] for x in trees[s]], 0)[0] for s in order]
    out = []
    for rank, s in enumerate(order):
        for at, (i, digest, changed) in enumerate(trees[s]):
            root, top = climb(subroots, rank)
            path = climb([x[1] for x in trees[s]], at)[1] + top
            folded = changed
            for left, right in path:
                folded = H("".join(left) + folded + "".join(right))
            proof = H("".join(h for left, right in path for h in left + right))
            out.append((i, digest, subroots[rank], root, proof, folded, folded == root))
    return sorted(map(repr, out))


def reported(frame):
    return sorted(repr(tuple(row)) for row in frame.collect())


MERKLE_ROWS = ([(i, f"line {i}\nsecond {i}", "hot") for i in range(40)] + [(i, "plain", f"s{i % 4}") for i in range(100, 111)]
               + [(None, "no id\n", "hot"), (None, "no id\n", "hot"), (5, "line 5\nsecond 5", "hot"), (7, None, None),
                  (8, "", None), (9, "é\n日", "ß"), (12, "x\n" * 3000, "long")])


@pytest.mark.parametrize("rows", [MERKLE_ROWS, MERKLE_ROWS[:1], MERKLE_ROWS[:3], MERKLE_ROWS[-3:], []],
                         ids=["many", "one", "run", "sources", "none"])
def test_manifest_equals_plain_version(spark, rows):
    assert reported(merkle.merkle_report(documents(spark, rows))) == plain_manifest(rows)


def test_manifest_without_heavy_nodes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEAVY_SHARE", 1)  # all but the root's children are joined by key
    assert reported(merkle.merkle_report(documents(spark, MERKLE_ROWS))) == plain_manifest(MERKLE_ROWS)


def test_heavy_nodes_are_few(spark):
    built = merkle.manifest(documents(spark, [(i, str(i), "one") for i in range(500)]))
    levels = 6
    assert built.heavy.count() <= levels * merkle.HEAVY_SHARE
    assert built.light.count() + built.heavy.count() == 500 + 167 + 56 + 19 + 7 + 3


# --- tokenizer alignment -----------------------------------------------------

def plain_alignment(rows):
    first = Tokenizer.from_file(public_tokenizers.path(alignment.CHARACTER_VOCABULARY))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECE_VOCABULARY))
    symbols = alignment.byte_symbols()
    told, counts = [], Counter()
    for i, text in rows:
        whole = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_bytes = [bytes(symbols[c] for c in first.id_to_token(x)) for x in a]
        b_bytes = [alignment.piece_bytes(second.id_to_piece(x)) for x in b]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            told.append((i, 0, 0, 0, [], ""))
            continue
        a_at = dict(zip(itertools.accumulate(map(len, a_bytes)), a))
        b_at = dict(zip(itertools.accumulate(map(len, b_bytes)), b))
        common, groups, start = sorted(a_at.keys() & b_at.keys()), [], 0
        for end in common:
            groups.append("|".join(",".join(str(x) for e, x in at.items() if start < e <= end) for at in (a_at, b_at)))
            start = end
        links = [(a_at[end], b_at[end]) for end in common]
        counts.update(links)
        told.append((i, len(a), len(b), len(common), links, H(";".join(groups))))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(repr((i, a, b, g, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest))
                  for i, a, b, g, links, digest in told)


ODD_TEXTS = ["", "x ▁ y", "𓀀𓀀 日本語 é\n\n\t  ab  ﬁ <s> </s> <unk> <0x41> <|endoftext|> 🎉👍🏽", "a", " ", "  lead and trail  ",
             " x​ y\r\n", "don't 's 've", "é ́x", "one two\nthree  four", "　 wide   spaces", "日 本 " * 300]


def test_alignment_equals_plain_version(spark):
    texts = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect()]
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS + texts)] + [(None, None), (None, "a b"), (3, "a b"), (3, "a b")]
    frame = documents(spark, [(i, t, "s") for i, t in rows])
    want = plain_alignment(rows)
    for share in (alignment.COMMON_SHARE, 0.01, 2.0):  # all pairs common, some, none
        assert reported(alignment.align_tokenizers(frame, share)) == want
    assert alignment.align_tokenizers(frame.where("false")).collect() == []


def test_groups_as_text(spark):
    row = alignment.align_documents(documents(spark, [(1, "a b", "s")]), with_groups=True).first()
    first = Tokenizer.from_file(public_tokenizers.path(alignment.CHARACTER_VOCABULARY))
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECE_VOCABULARY))
    assert row["groups"] == ";".join(f"{x}|{y}" for x, y in zip(first.encode(" a b").ids, second.encode("a b")))


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(*map(alignment.vocabulary_bytes, (alignment.CHARACTER_VOCABULARY, alignment.PIECE_VOCABULARY)))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .,'é日🎉\n\t ​1", max_size=30))
def test_parts_tokenize_as_the_whole(aligner, text):
    whole = aligner.by_character.encode(" " + text, add_special_tokens=False).ids
    pieces = aligner.by_piece.encode(text)
    cut = aligner.cut(text)
    assert " ".join(cut) == text
    assert [i for part in cut for i in aligner.by_character.encode(" " + part, add_special_tokens=False).ids] == whole
    assert [i for part in cut for i in aligner.by_piece.encode(part)] == pieces


# --- piecewise fingerprints --------------------------------------------------

def plain_fingerprint(text):
    codes, size, signs = [ord(c) for c in text], 3, []
    while size * 64 < len(codes):
        size *= 2
    for block in (size, 2 * size):
        out, chunk = [], []
        for i, code in enumerate(codes):
            seen, mixed = codes[max(0, i - 6):i + 1][::-1], 0
            for k, x in enumerate(seen):
                mixed ^= (x << (5 * k)) % 2 ** 32
            chunk.append(code)
            if (sum(seen) + sum(x * (7 - k) for k, x in enumerate(seen)) + mixed) % 2 ** 32 % block == block - 1 or i + 1 == len(codes):
                v = sum((x + 1) * pow(int(piecewise._FACTOR), k, 2 ** 64) for k, x in enumerate(chunk)) % 2 ** 64
                out.append(((v ^ (v >> 29)) * int(piecewise._MIX)) % 2 ** 64 >> 52)
                chunk = []
        kept = [v for k, v in enumerate(out) if not (k >= 3 and out[k - 3] == out[k - 2] == out[k - 1] == v)]
        signs.append("".join(piecewise.LETTERS[v // 64] + piecewise.LETTERS[v % 64] for v in kept))
    return f"{size}:{signs[0]}:{signs[1]}"


def plain_likeness(a, b):
    if a == b:
        return 1.0
    (na, *sa), (nb, *sb) = a.split(":"), b.split(":")
    best = 0.0
    for (x, s), (y, t) in itertools.product(zip((int(na), 2 * int(na)), sa), zip((int(nb), 2 * int(nb)), sb)):
        if x == y and s and t:
            s, t = ([z[i:i + 2] for i in range(0, len(z), 2)] for z in (s, t))
            row = list(range(len(t) + 1))
            for i, u in enumerate(s, 1):
                new = [i]
                for j, v in enumerate(t, 1):
                    new.append(row[j - 1] if u == v else min(row[j], new[-1]) + 1)
                row = new
            best = max(best, 1 - row[-1] / (len(s) + len(t)))
    return best


FINGERPRINT_TEXTS = ["", "ab", "é日🎉" * 50, "a" * 1000, "line one is here\n" * 300, "word " * 7, "x"]


@pytest.mark.parametrize("slices", [1, 7])
def test_fingerprints_equal_plain_version(spark, slices):
    texts = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(40).collect()]
    rows = [(i, t) for i, t in enumerate(FINGERPRINT_TEXTS + texts)] + [(-1, None)]
    ordered = sorted(rows, key=lambda row: -row[0])
    want = []
    for (i, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1]):
        t, n = t or "", n or ""
        edited = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
        mark, changed = plain_fingerprint(t), plain_fingerprint(edited)
        want.append((i, len(t), H(edited), mark, changed, plain_likeness(mark, changed), plain_likeness(mark, plain_fingerprint(n))))
    found = piecewise.edited_fingerprints(documents(spark, [(i, t, "s") for i, t in rows], slices)).collect()
    assert len(found) == len(want)
    for got, expected in zip(sorted(found, key=lambda row: row[0]), sorted(want)):
        assert tuple(got)[:5] == expected[:5]
        assert got[5:] == pytest.approx(expected[5:], abs=1e-12)


def test_fingerprints_of_ties_nulls_one_row_and_none(spark):
    rows = [(None, "same text", "s")] * 5 + [(3, "same text", "s")] * 4 + [(3, None, "s")]
    found = piecewise.edited_fingerprints(documents(spark, rows)).collect()
    assert Counter(row["doc_id"] for row in found) == {None: 5, 3: 5}
    assert {row["fingerprint"] for row in found if row["n_chars"]} == {plain_fingerprint("same text")}
    one = piecewise.edited_fingerprints(documents(spark, [(1, "alone here", "s")])).collect()
    assert [(row["near_next"], row["n_chars"]) for row in one] == [(1.0, 10)]
    assert piecewise.edited_fingerprints(documents(spark, [])).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=40), st.lists(st.sampled_from("abcd"), max_size=40))
def test_common_chunks(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    assert piecewise.common_chunks(a, b) == row[-1]


def test_edits_stay_alike_and_others_do_not(spark):
    found = piecewise.edited_fingerprints(spark.read.parquet(f"{SF}/documents.parquet")).where("n_chars > 500").collect()
    edited = [row["near_edited"] for row in found]
    other = [row["near_next"] for row in found if row["near_next"] < 0.95]  # copies may lie side by side
    assert sum(x > 0.45 for x in edited) > 0.97 * len(edited)
    assert sum(x < 0.2 for x in other) > 0.9 * len(other)
