import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from labelweave.llm import hyperminhash, positional_index
from labelweave.llm.common import ascii_lower
from labelweave.llm.components import connected_components

DOCS = "doc_id long, text string, component_id string, term string"
WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall(ascii_lower(t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited_copies():
    draw = random.Random(5)
    words = [f"w{k}" for k in range(3000)]
    rows = []
    for length in (6, 7, 8, 12, 30, 120):
        for _ in range(5):
            base = draw.choices(words, k=length)
            now = base
            for _ in range(5):  # chains and stars of copies that drift apart
                rows.append(" ".join(now))
                now = list(now if draw.random() < .6 else base)
                for _ in range(max(1, length * draw.choice([0, 1, 2, 3]) // 100)):
                    now[draw.randrange(len(now))] = draw.choice(words)
    base = draw.choices(words, k=120)
    for _ in range(120):
        now = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            now[draw.randrange(120)] = draw.choice(words)
        rows.append(" ".join(now))
    rows += ["", None, "a b", "A  b", " \n", "a b c d e f", "É a b c d e", "é a b c d e", "long " * 30_000]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("hub_rounds, pairs", [(6, 50), (3, 0)])
def test_components_match_brute_force(spark, monkeypatch, hub_rounds, pairs):
    monkeypatch.setattr(hyperminhash, "HUB_ROUNDS", hub_rounds)
    monkeypatch.setattr(hyperminhash, "PAIRS_PER_MEMBER", pairs)
    rows = edited_copies()
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], DOCS)
    got = hyperminhash.near_duplicates(df).collect()
    want = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    one, two = "a b c d e f g h", "q r s t u v w x"
    df = spark.createDataFrame([(5, one, "", ""), (5, one, "", ""), (3, one.upper(), "", ""), (None, one, "", ""),
                                (None, two, "", ""), (9, None, "", "")], DOCS)
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in hyperminhash.near_duplicates(df).collect())
    assert got == [(-1, -1, True), (-1, 3, False), (3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True)]
    assert hyperminhash.near_duplicates(df.limit(0)).count() == 0


def test_registers_estimate_similarity_of_small_and_large_sets():
    draw = hyperminhash.mixed(__import__("numpy").arange(1, 200_001, dtype="uint64"))
    import numpy as np
    for n in (40, 400, 8000):
        errors = []
        for k in range(40):
            part = draw[k * 4000 % 100_000:][:2 * n]
            a, b = part[:n], np.concatenate([part[:int(.9 * n)], part[n:int(1.1 * n)]])
            regs = hyperminhash.registers([np.unique(a), np.unique(b)])
            size = np.array([float(n)])
            errors.append(hyperminhash.estimate(regs[:1], regs[1:], size, size)[0] - .9 / 1.1)
        assert abs(np.mean(errors)) < .04


def test_accidental_matches_are_corrected():
    import numpy as np
    n = 20_000
    a = hyperminhash.mixed(np.arange(1, n + 1, dtype=np.uint64))
    b = hyperminhash.mixed(np.arange(n + 1, 2 * n + 1, dtype=np.uint64))
    regs = hyperminhash.registers([np.unique(a), np.unique(b)])
    size = np.array([float(n)])
    assert abs(hyperminhash.estimate(regs[:1], regs[1:], size, size)[0]) < .02


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, k) for k in range(2, 60)] + [(70, 70)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{k: 1 for k in range(1, 60)}, 70: 70}


def brute_hits(docs, items):
    word = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    cut = lambda t: word.findall(ascii_lower(t or ""))
    windows = collections.defaultdict(set)
    for item, text in items:
        w = cut(text)
        n = min(len(w), 10)
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add(item)
    out = {}
    for doc, text in docs:
        w = cut(text)
        hit, ids = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k:k + n]))
                if found:
                    hit.update(range(k, k + n))
                    ids.update(str(i) for i in found if i is not None)
        out[doc] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))
    return out


def test_decontamination_matches_brute_force(spark):
    draw = random.Random(6)
    words = ["a", "b", "the", "The", "of", "é", "É", "x1", "ß", "中文"] + [f"rare{k}" for k in range(40)]
    text = lambda n: "".join(draw.choice(words) + draw.choice([" ", ", ", ".\n", "-"]) for _ in range(n))
    items = [(i, text(draw.choice([1, 4, 9, 10, 11, 30]))) for i in range(20)]
    items = [(i, t) for i, t in items if len(t) > 12] + [(30, ""), (31, None), (2, "another text under a known number x1 x1 x1 x1")]
    docs = []
    for i in range(120):
        t = text(draw.randint(0, 60))
        if draw.random() < .5:
            whole = draw.choice(items)[1] or ""
            k = draw.randint(0, len(whole) // 3)
            t = t + whole[k:k + draw.randint(0, len(whole))] * draw.choice([1, 1, 2]) + text(5)
        docs.append((i, t))
    docs += [(200, ""), (201, None), (202, (items[0][1] or "") * 400)]
    got = positional_index.decontaminate(
        spark.createDataFrame([(i, t, "clash", "clash") for i, t in docs], DOCS),
        spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == brute_hits(docs, items)
    assert len(got) == len(docs)


def test_decontamination_of_nulls_repeats_and_empty_tables(spark):
    words = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(None, words, "", ""), (1, words, "", ""), (1, words, "", ""), (2, None, "", "")], DOCS)
    items = spark.createDataFrame([(None, words), (7, words), (7, words)], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items) for r in positional_index.decontaminate(docs, items).collect())
    assert got == [(0, 12, 12, 1), (1, 12, 12, 1), (1, 12, 12, 1), (2, 0, 0, 0)]
    assert positional_index.decontaminate(docs, items.limit(0)).filter("contaminated OR n_items > 0").count() == 0
    assert positional_index.decontaminate(docs.limit(0), items).count() == 0


def test_phrases_and_proximity(spark):
    docs = spark.createDataFrame([(1, "red fox runs far, red dog sleeps"), (2, "the fox is red"), (3, "dog and fox")],
                                 "doc_id long, text string")
    phrases = spark.createDataFrame([(0, ["red", "dog"]), (1, ["fox"]), (2, ["fox", "absent"])],
                                    "phrase_id long, terms array<string>")
    found = positional_index.phrase_matches(docs, phrases).select("doc_id", F.explode("hits").alias("h")).collect()
    assert sorted((r.doc_id, r.h.start, r.h.n, r.h.phrase_id) for r in found) == [
        (1, 1, 1, 1), (1, 4, 2, 0), (2, 1, 1, 1), (3, 2, 1, 1)]
    index = positional_index.build_index(docs)
    queries = spark.createDataFrame([(0, ["fox", "red"]), (1, ["red", "dog", "sleeps"]), (2, ["red", "none"])],
                                    "query_id long, terms array<string>")
    near = lambda slop: sorted(map(tuple, positional_index.proximity_matches(index, queries, slop).collect()))
    assert near(1) == [(0, 1, 1)] and near(2) == [(0, 1, 1), (0, 2, 1), (1, 1, 6)]


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark):
    words = [f"w{k}" for k in range(60)]
    one, near, other = " ".join(words), " ".join(words[:-1]), " ".join(reversed(words))
    df = spark.createDataFrame([(4, one, "", ""), (4, other, "", ""), (2, near, "", ""), (7, other + " x", "", "")], DOCS)
    got = sorted((r.doc_id, r.component_id, r.kept) for r in hyperminhash.near_duplicates(df).collect())
    assert got == [(2, 2, True), (4, 2, False), (4, 4, True), (7, 4, False)]
    items = spark.createDataFrame([(1, " ".join(words[5:15]))], "item_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit) for r in positional_index.decontaminate(df, items).collect())
    assert got == [(2, 59, 10), (4, 60, 0), (4, 60, 10), (7, 61, 0)]


def test_near_copies_without_ids_are_compared(spark):
    words = [f"w{k}" for k in range(80)]
    df = spark.createDataFrame([(None, " ".join(words[:n]), "", "") for n in (78, 79, 80)], DOCS)
    got = hyperminhash.near_duplicates(df).collect()
    assert {r.component_id for r in got} == {None} and sorted(r.kept for r in got) == [False, False, True]


def crowd(n, edits=3):
    draw = random.Random(n)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(n):
        now = list(base)
        for at in draw.sample(range(0, 120, 6), edits):  # each takes five shingles away and adds five
            now[at] = f"m{i}e{at}"
        rows.append((i, " ".join(now)))
    return rows


def test_a_crowd_below_the_threshold_costs_no_pairs(spark, monkeypatch):
    looked_at = []
    plain = hyperminhash.confirmed

    def counted(pairs, sets, threshold):
        looked_at.append(pairs.count())
        return plain(pairs, sets, threshold)

    monkeypatch.setattr(hyperminhash, "confirmed", counted)
    most = {}
    for n in (200, 400):
        looked_at.clear()
        rows = crowd(n)
        got = hyperminhash.near_duplicates(spark.createDataFrame([(i, t, "", "") for i, t in rows], DOCS)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)
        most[n] = sum(looked_at)
    assert most[400] < 3 * most[200] and most[400] < 400 * 399 / 2 / 5


@pytest.mark.parametrize("block_bytes", [100, 4_000_000])
def test_pairs_in_buckets_lose_no_link(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(hyperminhash, "BLOCK_BYTES", block_bytes)
    import numpy as np
    draw = np.random.default_rng(3)
    sets = []
    for n in (1, 3, 100, 130, 140, 500, 560):
        base = draw.integers(0, 2 ** 63, n).astype(np.uint64)
        for _ in range(6):
            s = base[draw.random(n) > draw.choice([0, .05, .1, .15])]
            sets.append(np.unique(np.concatenate([s, draw.integers(0, 2 ** 63, draw.integers(1, 2 + n // 20)).astype(np.uint64)])))
    stored = spark.createDataFrame([(i, len(s), s.tobytes()) for i, s in enumerate(sets)], "node long, n_shingles long, hashes binary")
    left = stored.selectExpr("explode(array(7L, 9L)) AS key", "node", "node AS label", "n_shingles AS size")
    found = [tuple(r) for r in hyperminhash.pairs_in_buckets(left, stored, 80).collect()]
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert len(found) == len(set(found)) and want and want <= set(found)
    assert len(found) < 3 * len(want)
