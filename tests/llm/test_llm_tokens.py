import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from labelweave.llm import bpe, token_transducer
from labelweave.llm.common import vocabulary_bytes

SCHEMA = "doc_id long, text string, n_tokens string"
BITS = ["a", "b", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "​", "1", "٣", "é", "ß", "Σ", "İ", "中", "🙂",
        "'", "s", "'ll", "'re", "'v", "!", "#", "\x00", "́", "ǅ", "²", "x" * 30, "ing", "﻿", "\x0b",
        "<|endoftext|>", "<|startoftext|>", "<|", "E", "한"]


def texts(seed, n):
    draw = random.Random(seed)
    some = ["".join(draw.choices(BITS, k=draw.randint(0, 40))) for _ in range(n)]
    return [*some, "", None, "ab" * 20_000, "=-" * 5_000, "word " * 10_000,
            "".join(draw.choices("etaoinshrdlu", k=3_000))]


@pytest.fixture(scope="module")
def byte_bpe():
    return bpe.ByteBPE(bpe.read_ranks(vocabulary_bytes("byte_bpe_50k.tiktoken")))


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library_and_round_trips(spark, library):
    some = texts(1, 400)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(some)], SCHEMA)
    encoded = bpe.encode_documents(df, with_ids=True)
    rows = encoded.collect()
    assert len(rows) == len(some)
    for r in rows:
        text = some[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert (r.ids, r.n_tokens) == (ids, len(ids))
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    decoded = {r.doc_id: bytes(r.decoded) for r in bpe.decode_documents(encoded).collect()}
    assert decoded == {i: (t or "").encode() for i, t in enumerate(some)}


def test_join_is_associative_and_independent_of_the_cut(byte_bpe, library):
    draw = random.Random(3)
    for _ in range(100):
        data = "".join(draw.choices("aabetho nsr='", k=draw.randint(2, 300))).replace(" ", "").encode()
        whole = byte_bpe.merged(data)
        i, k = sorted((draw.randint(0, len(data)), draw.randint(0, len(data))))
        a, b, c = (byte_bpe.merged(x) for x in (data[:i], data[i:k], data[k:]))
        assert byte_bpe.join(byte_bpe.join(a, b), c) == byte_bpe.join(a, byte_bpe.join(b, c)) == whole
        assert byte_bpe.tree(data) == whole


@pytest.fixture(scope="module")
def counter():
    return token_transducer.TokenCounter(vocabulary_bytes("word_bpe_49k.json"))


def test_counts_equal_the_library(spark):
    some = texts(2, 600)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(some)], SCHEMA)
    want = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = token_transducer.token_counts(df).collect()
    assert len(rows) == len(some)
    for r in rows:
        text = some[r.doc_id] or ""
        n = len(want.encode(text, add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(text.encode()), n > 2048)


def test_chunks_compose_to_the_same_count(counter):
    for text in texts(5, 150):
        assert len({counter.count(text or "", chunk) for chunk in (3, 17, 1 << 16)}) == 1


def test_composition_is_associative(counter):
    draw = random.Random(8)
    for _ in range(100):
        a, b, c = (counter.chunk_map(counter.normalized("".join(draw.choices(["a", "b ", " ", "ing", "'s"], k=4)))) for _ in "abc")
        assert counter.compose(counter.compose(a, b), c) == counter.compose(a, counter.compose(b, c))
        assert counter.compose(token_transducer.EMPTY, a) == a == counter.compose(a, token_transducer.EMPTY)


def test_counts_stand_when_old_states_and_runs_go(monkeypatch):
    data = vocabulary_bytes("word_bpe_49k.json")
    library, counter = Tokenizer.from_str(data.decode()), token_transducer.TokenCounter(data)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("aeinorstlé漢") for _ in range(rng.randint(1, 14))) for _ in range(12)) for _ in range(150)]
    monkeypatch.setattr(token_transducer, "KEPT_STATES", 200)
    monkeypatch.setattr(token_transducer, "KEPT_RUNS", 50)
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [counter.count(t) for t in texts] == want
    assert len(counter.pieces.transducer.states) < 400 and counter.pieces.transducer.now > 5


def test_prefixes_alike_in_what_follows_are_one_state():
    data = vocabulary_bytes("word_bpe_49k.json")
    counter, rng = token_transducer.TokenCounter(data), random.Random(9)
    ends = ["".join(rng.choice("etaoinshrdlu") for _ in range(9)) for _ in range(20)]
    words = {"".join(rng.choice("etaoinshrdlu") for _ in range(5)) + rng.choice(ends) for _ in range(3000)}
    prefixes = {w[:n] for w in words for n in range(14)}
    for word in words:
        counter.count(word)
    assert len(counter.pieces.transducer.states) < 0.5 * len(prefixes)


def test_states_stay_few_on_long_pieces(counter):
    counter.pieces.transducer.clear()
    counter.count("ha" * 50_000)
    assert len(counter.pieces.transducer.states) < 500


@pytest.mark.parametrize("operator", [bpe.encode_documents, token_transducer.token_counts])
def test_empty_tables_nulls_and_repeated_rows(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = operator(spark.createDataFrame([(None, None, None), (1, "ab cd", ""), (1, "ab cd", "")], SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 0), (1, 2), (1, 2)]
