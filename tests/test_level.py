"""Cosines are those of the stored vectors: level ones come out level, and blends keep their digits."""

import numpy as np
import pytest

from labelweave.functions.similarity import cosine_pairs, cosine_table, squares
from labelweave.operators import articles as a
from labelweave.operators import grouping as g
from labelweave.operators import matching as m
from labelweave.operators.embed import hashed_trigrams
from labelweave.operators.model import MergeModel


def ones(low, high):
    v = np.zeros(64)
    v[low:high] = 1.0
    return [float(x) for x in (v / np.linalg.norm(v)).astype(np.float32)]


LEFT, RIGHT = ones(0, 32), ones(26, 58)  # 6 of 32 shared: exactly 0.1875


def test_level_cosine_reaches_its_threshold(spark):
    df = spark.createDataFrame([(1, "hot gear", LEFT), (2, "hot gear", RIGHT)], "row_id long, label string, embedding array<float>")
    for found in (m.similar_pairs(df, cos_min=0.1875, jw_min=0.8), m.similar_pairs_topk(df, k=2, cos_min=0.1875, jw_min=0.8)):
        assert [(r.source_id, r.target_id, r.cos) for r in found.collect()] == [(2, 1, 0.1875)]
    model = MergeModel(intercept=-0.1875, lexical=0.0, cosine=1.0)  # a logit of 0
    pairs = spark.createDataFrame([(2, 1)], "source_id long, target_id long")
    groups = g.classify_all_groups(df, pairs, model, 0.5).where("member_id = 2").collect()
    assert [(r.seed_id, r.member_id, r.cosine_similarity) for r in groups] == [(1, 2, 0.1875)]


def test_level_cosine_is_shown_as_it_is(spark):
    articles = spark.createDataFrame([(1, "x", LEFT, ["x"])], "article_id long, text string, embedding array<float>, keywords array<string>")
    entries = spark.createDataFrame([("c", "c", 0, "gear", RIGHT)], "category string, name string, ord long, entry string, embedding array<float>")
    row = a.similarity_stats(articles, entries).first()
    assert (row.max_similarity, row.top_scores) == (0.1875, "0.188")


def test_cosine_table_is_that_of_pairs():
    rng = np.random.default_rng(1)
    x, y = (rng.normal(size=(n, 64)).astype(np.float32) for n in (300, 200))
    x[3] = 0.0
    sx, sy = squares(x), squares(y)
    table = cosine_table(x, sx, y, sy)
    for row in (0, 3, 299):
        assert (table[row] == cosine_pairs(np.repeat(x[row:row + 1], 200, axis=0), np.repeat(sx[row], 200), y, sy)).all()
    assert not table[3].any()


def test_blended_vectors_are_not_cut_to_single_precision(spark):
    text = "Clean water matters to every town along the river. Rivers carry clean water to the sea."
    row = a.describe_articles(spark.createDataFrame([(1, text)], "article_id long, text string")).first()
    full, words, phrases = (hashed_trigrams()([t])[0].astype(np.float32).astype(np.float64) for t in (
        text, " ".join(row.keywords), " ".join(row.key_phrases)))
    want = 0.4 * full + 0.3 * words + 0.3 * phrases
    assert np.abs(np.array(row.embedding) - want).max() < 1e-15
    entry = hashed_trigrams()(["clean water"])[0].astype(np.float32)
    entries = spark.createDataFrame([("c", "c", 0, "clean water", [float(x) for x in entry])],
                                    "category string, name string, ord long, entry string, embedding array<float>")
    described = spark.createDataFrame([(1, row.keywords, row.embedding)], "article_id long, keywords array<string>, embedding array<double>")
    got = a.similarity_stats(described, entries).first().max_similarity
    true = want @ entry / np.sqrt((want @ want) * (entry.astype(float) @ entry.astype(float)))
    assert got == pytest.approx(true, abs=1e-14)
