import collections
import glob
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelweave.llm import backoff_lm, boosted_trees, hyperdimensional
from labelweave.llm.common import held_out

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, score string, word string"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_base_scores_match_brute_force(spark, documents):
    got = {r.doc_id: r for r in backoff_lm.language_model_scores(documents).collect()}
    rows = documents.select("doc_id", "text").collect()
    train = collections.Counter()
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 10:
            train.update(backoff_lm.tokens(r.text))
    n, v = sum(train.values()), len(train)
    assert len(got) == len(rows)
    for r in rows:
        found, g = backoff_lm.tokens(r.text), got[r.doc_id]
        assert g.base_score == pytest.approx(sum(math.log10((train[t] + .1) / (n + .1 * (v + 1))) for t in found))
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(found), sum(train[t] > 0 for t in found), n)
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    held = [g for g in got.values() if g.held_out]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)


def reference_backoff(grams, counts, n_all, n_distinct, history, word):
    """Recursive definition: discounted count if the n-gram is kept, else weight times the shorter history."""
    unit = n_all + .1 * (n_distinct + 1)
    if not history:
        return (counts[word] + .1) / unit
    follow = {g[-1]: c for g, c in grams.items() if g[:-1] == history}
    if not follow:
        return reference_backoff(grams, counts, n_all, n_distinct, history[1:], word)
    total = grams[history] if len(history) > 1 else counts[history[0]]
    if word in follow:
        return (follow[word] - .5) / total
    kept = sum((c - .5) / total for c in follow.values())
    lower = sum(reference_backoff(grams, counts, n_all, n_distinct, history[1:], w) for w in follow)
    return (1 - kept) / (1 - lower) * reference_backoff(grams, counts, n_all, n_distinct, history[1:], word)


@pytest.mark.parametrize("word_share", [1e-6, 0.02])
def test_scores_match_the_recursive_model(spark, word_share):
    draw = random.Random(1)
    texts = [" ".join(draw.choices("abcdefgh", [8, 4, 3, 2, 1, 1, .5, .2], k=draw.randint(0, 30))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], SCHEMA)
    learn = df.filter("doc_id < 50")
    share = .01
    got = {r.doc_id: r for r in backoff_lm.score(df, learn, word_share=word_share, gram_share=share).collect()}
    lists = [backoff_lm.tokens(t) for t in texts[:50]]
    counts = collections.Counter(w for x in lists for w in x)
    n = sum(counts.values())
    frequent = {w for w, c in counts.items() if c >= word_share * n}
    dense = {w for w, c in counts.items() if c >= share * n} & frequent
    grams = {}
    for k in (2, 3):
        level = collections.Counter(tuple(x[i:i + k]) for x in lists for i in range(len(x) - k + 1))
        grams.update({g: c for g, c in level.items() if c >= max(share * n, 2) and set(g) <= dense
                      and (k == 2 or (g[:-1] in grams and g[1:] in grams))})
    for i, text in enumerate(texts):
        total, history = 0.0, ()
        for w in backoff_lm.tokens(text):
            total += math.log10(reference_backoff(grams, counts, n, len(counts), history, w))
            history = (*history, w)[-2:]
        assert got[i].score == pytest.approx(total, abs=1e-9), text


def test_the_model_keeps_every_repeated_ngram_at_any_share(spark, monkeypatch):
    monkeypatch.setattr(backoff_lm, "WORD_SHARE", 1e-4)
    monkeypatch.setattr(backoff_lm, "GRAM_SHARE", 1e-5)
    draw = random.Random(4)
    words = [f"w{k}" for k in range(60)] + ["é", "日本"]
    rare = "one rare phrase"  # 4 of 500,000 tokens: below the share, and met by join
    texts = [" ".join(draw.choices(words, [1 / (k + 1) for k in range(62)], k=draw.randint(0, 60))) for _ in range(80)]
    texts += [f"w0 {rare} w1", f"w3 {rare} w1", f"w5 {rare}", rare, "unseen words w0 w1 unseen", "", None]
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], SCHEMA)
    filler = "w0 " * 500_000
    learn = df.filter("doc_id < 84").unionByName(spark.createDataFrame([(99, filler, "", "")], SCHEMA))
    got = {r.doc_id: r for r in backoff_lm.score(df, learn).collect()}
    lists = [backoff_lm.tokens(t) for t in [*texts[:84], filler]]
    counts = collections.Counter(w for x in lists for w in x)
    n = sum(counts.values())
    grams = {g: c for k in (2, 3) for g, c in collections.Counter(
        tuple(x[i:i + k]) for x in lists for i in range(len(x) - k + 1)).items() if c >= 2}
    assert grams["one", "rare", "phrase"] == 4 < 1e-5 * n
    for i, text in enumerate(texts):
        total, history = 0.0, ()
        for w in backoff_lm.tokens(text):
            total += math.log10(reference_backoff(grams, counts, n, len(counts), history, w))
            history = (*history, w)[-2:]
        assert got[i].score == pytest.approx(total, abs=1e-9), text


def test_language_model_without_training_text_and_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "", ""), (1, None, "", ""), (2, "a b", "", ""), (None, "a", "", "")], SCHEMA)
    rows = backoff_lm.score(df, df.limit(0)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.score) for r in rows) == [
        (0, 2, 0, 0), (1, 1, 0, 0), (1, 1, 0, 0), (2, 3, 0, 0)]
    assert backoff_lm.score(df.limit(0), df).count() == 0


def test_numbers_of_tokens_tell_words_apart_and_texts_too(monkeypatch):
    monkeypatch.setattr(backoff_lm, "CHUNK_BYTES", 500)
    draw = random.Random(1)
    texts = [None, "", " ", "Hello hello HELLO", "x" * 300, "x" * 299 + " " + "y" * 256 + "\t" + "z" * 257, "é É\x0b日本 \x1f a\x00b"]
    texts += ["".join(draw.choices("aAbé \n\x00日", k=draw.randint(0, 60))) for _ in range(300)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["cut off", *texts])}).slice(1)
    number, word, seen = {}, {}, 0
    for i, j, data, offsets in backoff_lm.texts_in_chunks(batch):
        found, text = backoff_lm.token_hashes(data, offsets)
        want = [(k, w) for k in range(i, j) for w in backoff_lm.tokens(texts[k])]
        assert [k - i for k, _ in want] == text.tolist()
        for (_, w), h in zip(want, found.tolist(), strict=True):
            assert number.setdefault(w, h) == h and word.setdefault(h, w) == w
        seen += j - i
    assert seen == len(texts)


def test_places_of_hashes():
    draw = np.random.default_rng(1)
    for n in (0, 1, 5, 3000):
        keys = np.unique(draw.integers(-2 ** 63, 2 ** 63 - 1, n))
        asked = draw.permutation(np.r_[keys, keys[:n // 2], draw.integers(-2 ** 63, 2 ** 63 - 1, 500)])
        found, places = backoff_lm.Places(keys).find(asked)
        assert (keys[places] == asked[found]).all() and found.tolist() == np.flatnonzero(np.isin(asked, keys)).tolist()


def test_language_model_leaves_no_shuffled_data_behind(spark):
    def shuffled():
        return set(glob.glob(f"{spark.conf.get('spark.local.dir', '/tmp')}/**/blockmgr-*/*/shuffle_*.data", recursive=True))

    df = spark.createDataFrame([(i, "a b c d " * 20 + str(i), "", "") for i in range(40)], SCHEMA).repartition(4)
    before = shuffled()
    scores = backoff_lm.score(df, df)
    assert not shuffled() - before
    assert scores.count() == 40


def test_flat_trees_equal_a_walk_node_by_node():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(600, len(boosted_trees.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > .5)).astype(float)
    trees = boosted_trees.fit(x, y, trees=12, depth=4)
    p = trees.probability(x)
    for row, got in zip(x[:80], p):
        total = trees.start
        for f, b, leaf in zip(trees.feature, trees.bound, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > b[node] else 1)
            total += leaf[node - len(f)]
        assert got == pytest.approx(1 / (1 + math.exp(-total)))
    assert ((p > .5) == y).mean() > .9


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = boosted_trees.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > .95
    assert all(r.predicted == (r.score >= .3) for r in rows)


def test_quality_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "", ""), (1, None, "", ""), (None, "a b", "", ""), (3, "é" * 100_000, "", "")], SCHEMA)
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    rows = boosted_trees.quality_scores(df, labels).collect()
    assert [r.score for r in rows] == [.5] * 4 and boosted_trees.quality_scores(df.limit(0), labels).count() == 0


def test_labels_only_teach_from_rows_that_are_not_held_out(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id"), 5, 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = ({r.doc_id: r.score for r in boosted_trees.quality_scores(documents, x).collect()} for x in (labels, turned))
    assert first == second


def test_languages_on_held_out_documents(spark, documents):
    rows = hyperdimensional.language_of_documents(documents).join(documents.select("doc_id", "lang", "text"), "doc_id")
    rows = rows.filter("held_out AND length(text) > 60").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > .97
    assert all(0 <= r.score <= 1 for r in rows)


def test_profiles_match_the_definition():
    p = hyperdimensional.Profiles()
    (got,), has = p.bundles(["Ab, 1é!"])
    text, want = " ab é ", np.zeros(hyperdimensional.DIM)
    for i in range(len(text) - 2):
        x, y, z = (p.letter(ord(c)).astype(int) for c in text[i:i + 3])
        want += np.roll(x, 2) * np.roll(y, 1) * z
    assert has[0] and (got == want).all()


def test_language_edge_rows(spark):
    learn = spark.createDataFrame([("aaa bbb", "x"), ("ccc ddd", "y"), (None, "y"), ("eee", None)], "text string, lang string")
    df = spark.createDataFrame([(1, None, "", ""), (2, "12 -", "", ""), (3, "aa bb", "", ""), (3, "aa bb", "", ""),
                                (None, "ccc", "", ""), (4, "日本語" * 40_000, "", "")], SCHEMA)
    got = hyperdimensional.languages(df, learn).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got if r.doc_id != 4) == [
        (0, "y"), (1, "und"), (2, "und"), (3, "x"), (3, "x")]
    assert {r.lang_pred for r in hyperdimensional.languages(df, learn.limit(0)).collect()} == {"und"}
    assert hyperdimensional.languages(df.limit(0), learn).count() == 0


def test_the_fit_is_bounded_by_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(boosted_trees, "fit", lambda x, y: seen.append((len(x), sorted(set(y)))) or boosted_trees.Trees)
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 2000).alias("text"))
    more = spark.createDataFrame([(2, "another"), (2, "another"), (None, "no id"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    boosted_trees.train(docs.unionByName(more), labels, fit_rows=100)
    boosted_trees.train(docs.unionByName(more), labels, fit_rows=5000)
    assert seen[0][0] == 100 and seen[1] == (2002, [0.0, 1.0])


def best_split(x, y):
    """The split of least squared error of a binary target over all features and cuts, by trying every one."""
    best = (0.0, None, None)
    whole = ((y - y.mean()) ** 2).sum()
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            low, high = y[x[:, f] <= cut], y[x[:, f] > cut]
            gain = whole - ((low - low.mean()) ** 2).sum() - ((high - high.mean()) ** 2).sum()
            if gain > best[0] + 1e-9:
                best = (gain, f, cut)
    return best


def test_one_split_separates_as_the_best_by_trial(spark):
    draw = np.random.default_rng(2)
    x = np.zeros((400, len(boosted_trees.FEATURES)))
    x[:, :6] = draw.integers(0, 12, (400, 6))
    y = ((x[:, 3] > 6) ^ (draw.random(400) < .1)).astype(float)
    _, feature, cut = best_split(x, y)
    trees = boosted_trees.fit(x, y, trees=1, depth=1)
    p = trees.probability(x)
    side = x[:, feature] <= cut
    assert len(set(p[side])) == 1 and len(set(p[~side])) == 1 and p[side][0] < p[~side][0]
