"""Queries do their whole job: every copy, every pair and every entry, on rows built here."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from labelweave.operators import articles as art
from labelweave.operators import grouping as g
from labelweave.operators import matching as m
from labelweave.operators.model import MergeModel


def vector(seed):
    return [float(x) for x in np.random.default_rng(seed).normal(size=64).astype(np.float32)]


@pytest.fixture()
def tables(spark, folder):
    """A writer of the tables that the label and article queries read; parts without a vector get that of the default encoder."""
    def write(names, stored=(), texts=()):
        part = [(i, name, "Brand#1", "SMALL") for i, name in enumerate(names)]
        spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{folder}/part.parquet")
        spark.createDataFrame([(i, v, c) for i, v, c in stored], "vec_id long, embedding array<float>, label int").write.parquet(
            f"{folder}/embeddings.parquet")
        spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
        return folder
    return write


def test_groups_hold_every_copy(spark, tables):
    names = ["hot gear", "hot gears", "hot gear", "cold plate", "hot gear", "hot gears", "cold plate"]
    got = entry.queries()["classify_all_groups"](spark, tables(names))
    assert got.columns == ["seed_id", "seed_label", "member_id", "member_label", "lexical_similarity", "cosine_similarity",
                           "merge_probability"]
    rows = [(r.seed_id, r.seed_label, r.member_id, r.member_label) for r in got.collect()]
    assert sorted(rows) == [(0, "hot gear", i, names[i]) for i in (0, 1, 2, 4, 5)]  # 0 is the one target of a merge


def test_groups_are_scored_once_and_ordered(spark, monkeypatch):
    """Hits are told once for a list of copies, and come by target, falling probability and member, level ones of several
    labels among them; copies of a target are targets of their own."""
    names = ["hot gear", "hot gears", "bolt"]
    near, far = vector(1), vector(2)
    rows = [(i, names[i * 7 % 3], far if i % 5 == 0 else near) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, label string, embedding array<float>")
    targets = [2, 5, 8, 11, 299]
    pairs = spark.createDataFrame([(300, t) for t in targets], "source_id long, target_id long")
    model = MergeModel(intercept=-0.5, lexical=0.0, cosine=1.0)  # all labels of a vector are level
    unit = {i: np.array(v) / np.linalg.norm(v) for i, _, v in rows}
    want = [(t, m) for t in targets for _, m in sorted((-round(float(unit[t] @ unit[m]), 9), m) for m in unit) if unit[t] @ unit[m] >= 0.5]
    seen, scorer = spark.sparkContext.accumulator(0), g._probable

    def counted(*args):
        inner = scorer(*args)

        def score(left, right):
            for part in inner(left, right):
                seen.add(len(part["seed_id"]))
                yield part
        return score
    monkeypatch.setattr(g, "_probable", counted)
    monkeypatch.setattr(g, "LIST_ROWS", 20, raising=False)
    got = [(r.seed_id, r.member_id) for r in g.classify_all_groups(df, pairs, model, 0.5).collect()]
    assert got == want
    assert len(targets) * 3 <= seen.value < len(want) / 3


def test_a_label_without_a_vector_stops_the_groups(spark):
    df = spark.createDataFrame([(0, "hot gear", vector(1)), (1, "hot gear", vector(1)), (2, "hot", None)],
                               "row_id long, label string, embedding array<float>")
    pairs = spark.createDataFrame([(1, 0)], "source_id long, target_id long")
    with pytest.raises(Exception, match="no vector"):
        g.classify_all_groups(df, pairs, MergeModel(-6.0, 7.0, 5.0)).collect()


def test_negatives_are_all_pairs_that_are_no_merge(spark, tables):
    names = ["hot gear", "cold plate", "hot gears", "hot gear", None, "new rod"]
    got = entry.queries()["negative_candidates"](spark, tables(names, [(3, vector(1), 0), (5, vector(2), 1)]))
    every = {(i, j) for i in range(6) for j in range(i + 1, 6)}
    # 0 and 2 are alike in label and default vector; 3 has a vector of its own, 4 has nothing to compare
    assert sorted((r.i, r.j) for r in got.collect()) == sorted(every - {(0, 2)})


@pytest.mark.parametrize("block_rows", [8192, 40])
def test_pairs_apart_are_the_rest_of_the_merges(spark, block_rows):
    rng = np.random.default_rng(3)
    rows = [(int(i), ["bcab", "abca", "hot gear", "hot gears"][i % 4], vector(i % 3)) for i in rng.permutation(150)]
    rows += [(200, "hot gear", [0.0] * 64), (201, "hot gear", [0.0] * 64), (202, "bcab", None), (202, "abca", vector(0))]
    df = spark.createDataFrame(rows, "row_id long, label string, embedding array<float>").cache()
    whole = df.where("embedding IS NOT NULL")
    merges = sorted((r.target_id, r.source_id) for r in m.similar_pairs(whole, cos_min=0.25, jw_min=0.8).collect())
    got = sorted((r.i, r.j) for r in m.unlinked_pairs(df, 0.25, 0.8, block_rows=block_rows).collect())
    ids = [r[0] for r in rows]
    every = sorted((min(a, b), max(a, b)) for n, a in enumerate(ids) for b in ids[:n] if a != b)
    assert sorted(got + merges) == every and len(merges) > 100
    assert spark.createDataFrame([], df.schema).transform(m.unlinked_pairs).count() == 0


def test_statistics_are_over_every_entry(spark, tables):
    """The entry that is most like the article is the last of 70 in label order."""
    stored = [(i, vector(i), 0) for i in range(70)]
    where = tables(["zinc rod"] + [f"hot gear {i:02d}" for i in range(1, 70)], stored, ["hot gear"])
    unit = np.array([v for _, v, _ in stored], dtype=np.float64)
    cos = (unit / np.linalg.norm(unit, axis=1, keepdims=True)) @ (unit[0] / np.linalg.norm(unit[0]))
    row, = entry.queries()["similarity_stats"](spark, where).collect()
    assert (row.max_similarity, row.avg_similarity) == (1.0, round(cos.mean(), 6))
    assert row.top_entries.split(", ")[0] == "zinc rod" and row.top_scores == ", ".join(f"{c:.3f}" for c in sorted(cos)[:-4:-1])


def test_best_entries_are_those_of_all_similarities(spark):
    """Copies, level entries, zero vectors on both sides and parts of a category, against every similarity."""
    rng = np.random.default_rng(2)
    base = [[float(x) for x in np.round(rng.normal(size=8), 1).astype(np.float32)] for _ in range(40)] + [[0.0] * 8]
    rows = [("ab"[i % 7 == 0], i * 3, f"e{i}", base[int(rng.integers(41))]) for i in range(200)] + [("c", 1, "one", base[0])]
    entries = spark.createDataFrame([(c, c, o, e, v) for c, o, e, v in rows],
                                    "category string, name string, ord long, entry string, embedding array<float>")
    texts = [base[i] for i in (0, 3, 40)] + [vector(9)[:8]]
    articles = spark.createDataFrame(list(enumerate(texts)), "article_id long, embedding array<float>")

    def cos(x, y):
        x, y = np.array(x, dtype=np.float64), np.array(y, dtype=np.float64)
        return float(x @ y / np.sqrt((x @ x) * (y @ y))) if x.any() and y.any() else 0.0
    found = art.article_entry_similarity(articles.withColumn("keywords", F.array(F.lit("a"))), entries, False, 30)
    for got in (found, art.similarity_stats(articles, entries)):
        got = {(r.article_id, r.category): r for r in got.collect()}
        assert len(got) == 12
        for (i, category), r in got.items():
            sims = sorted((-round(cos(texts[i], v), 12), o, e) for c, o, e, v in rows if c == category)
            assert r.top_entries == ", ".join(s[2] for s in sims[:3]) and r.max_similarity == pytest.approx(-sims[0][0])
            assert r.avg_similarity == pytest.approx(-np.mean([s[0] for s in sims]), abs=1e-12)
