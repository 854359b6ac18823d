import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from labelweave.functions.similarity import jaro_winkler_arrays, unit_rows
from labelweave.operators import matching as m
from labelweave.operators.keyed import argmax_per_group, lookup_unique
from labelweave.plans.alignment import align
from queries.common import vectors


@pytest.fixture(scope="module")
def clustered(spark):
    """60 labels in near-copy families with close vectors, a third of them equal."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(8, 16))
    rows = []
    for i in range(60):
        family = 0 if i % 3 == 0 else i % 8
        noise = 0.0 if i % 3 == 0 else 0.12
        vector = base[family] + noise * rng.normal(size=16)
        label = "water quality" if i % 3 == 0 else f"family {'abcdefgh'[family] * 3} {i % 4}"
        rows.append((i * 10, label, [float(x) for x in vector]))
    return rows, spark.createDataFrame(rows, "row_id long, label string, embedding array<float>").cache()


def brute(rows, cos_min, jw_min):
    unit = unit_rows(np.array([r[2] for r in rows], dtype=np.float32))
    out = set()
    for i, j in itertools.combinations(range(len(rows)), 2):
        jw = jaro_winkler_arrays([rows[i][1]], [rows[j][1]])[0]
        if unit[i] @ unit[j] >= cos_min and jw >= jw_min:
            out.add((rows[j][0], rows[i][0]))
    return out


def ids(df):
    return sorted((r.source_id, r.target_id) for r in df.select("source_id", "target_id").collect())


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(0, "Café"), (1, "cafe"), (2, "thé"), (3, "CAFE"), (4, None)], "row_id long, label string")
    assert ids(m.exact_duplicates(df)) == [(1, 0), (3, 0)]
    # the hot-key path gives the same answer
    assert ids(m.exact_duplicates(df, hot_rows=2)) == [(1, 0), (3, 0)]


def test_hot_key_lookup(spark):
    probe = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        (F.col("id") % 50).cast("string")).alias("k"))
    build = probe.groupBy("k").agg(F.min("id").alias("v"), F.count("*").alias("n"))
    wanted = {r.k: r.v for r in build.collect()}
    for hot in (10_000, 100, 1):
        got = lookup_unique(probe, build, "k", "n", "v", hot).collect()
        assert len(got) == 1000 and all(r.v == wanted[r.k] for r in got)


def test_similar_pairs_match_brute_force_for_any_block_size(clustered):
    rows, df = clustered
    want = sorted(brute(rows, 0.85, 0.80))
    assert len(want) > 190  # the copies alone give 190 pairs
    for size in (7, 8192):
        assert ids(m.similar_pairs(df, block_rows=size)) == want


def test_topk_is_a_subset_and_exact_when_wide(clustered):
    rows, df = clustered
    full = set(ids(m.similar_pairs(df)))
    assert set(ids(m.similar_pairs_topk(df, k=4, block_rows=9))) < full
    assert set(ids(m.similar_pairs_topk(df, k=64, block_rows=9))) == full


def test_rules_overlap_and_alignment(clustered):
    rows, df = clustered
    exact, similar = m.exact_duplicates(df), m.similar_pairs(df)
    both = m.union_rules(exact, similar)
    assert both.count() == exact.count() + similar.count()
    assert ids(m.union_rules(exact, similar, distinct=True)) == sorted(set(ids(both)))
    whole, lean = align(df, every_pair=True), align(df)
    a, b = whole.metrics.first(), lean.metrics.first()
    assert (a.unique_sources, a.aligned) == (b.unique_sources, b.aligned) and b.pairs < a.pairs
    assert b.aligned + b.unique_sources == b.original == 60
    left = sorted(r.row_id for r in lean.aligned.collect())
    assert left == sorted(r.row_id for r in whole.aligned.collect()) and len(left) == b.aligned


def test_blocks_on_the_given_vectors(spark):
    v = vectors(spark, SF).cache()
    one = ids(m.similar_pairs(v, cos_min=0.25))
    assert len(one) == 48 and ids(m.similar_pairs(v, cos_min=0.25, block_rows=33)) == one
    assert m.similar_pairs(v).count() == 0


def test_compartments_metrics_and_export(spark):
    labels = spark.createDataFrame([(i, f"l{i}") for i in range(4)], "row_id long, label string")
    pairs = spark.createDataFrame([(1, 0), (3, 0), (3, 0)], "source_id long, target_id long")
    got = [(r.canonical_id, r.member_id) for r in m.compartments(pairs, labels).collect()]
    assert got == [(0, 0), (0, 1), (0, 3)]
    x = m.merge_metrics(labels, pairs).first()
    assert (x.original, x.pairs, x.unique_sources, x.aligned, x.reduction_pct) == (4, 3, 2, 2, 50.0)
    assert sorted(r.row_id for r in m.export_aligned(labels, pairs).collect()) == [0, 2]
    assert m.merge_metrics(labels.limit(0), pairs.limit(0)).first().reduction_pct is None
    stray = pairs.unionByName(spark.createDataFrame([(99, 0)], "source_id long, target_id long"))
    assert m.unknown_sources(labels, stray).first()[0] == 1
    prompt = m.merge_prompts(pairs.limit(1), labels).first().prompt
    assert prompt == "Should 'l1' be merged into 'l0'? Answer 'Yes' or 'No'."


def test_argmax_tie_takes_the_lower_id(spark):
    df = spark.createDataFrame([(1, 5, 0.9), (1, 2, 0.9), (1, 9, 0.1)], "rec long, lid long, p double")
    assert tuple(argmax_per_group(df, ["rec"], "p", "lid").first()) == (1, 2, 0.9)


def test_long_labels_report_their_normalised_text(spark):
    label = "Énergie et développement durable | " * 3
    df = spark.createDataFrame([(0, label), (1, label.upper()), (2, "x"), (3, None)], "row_id long, label string")
    got = m.exact_duplicates(df).first()
    assert (got.source_id, got.target_id, got.norm_key) == (1, 0, "energie et developpement durable | " * 3)
    line = m.merge_audit(m.union_rules(m.exact_duplicates(df), m.exact_duplicates(df).limit(0))).first().line
    assert line.endswith(f"norm='{got.norm_key}'")


def test_representatives_keep_spellings_apart(spark):
    v = [1.0, 0.0]
    df = spark.createDataFrame([(0, "ABCDEFGH", v), (5, "abcdefgh", v), (9, "abcdefgz", v), (10, "abcdefgz", v)],
                               "row_id long, label string, embedding array<float>")
    kept = lambda whole: sorted(r.row_id for r in align(df, every_pair=whole).aligned.collect())
    assert kept(False) == kept(True) == [0]
    assert {(r.row_id, r.copies) for r in m.representatives(df).collect()} == {(0, 1), (5, 1), (9, 2)}


@pytest.mark.parametrize("bad", [[1.0], None])
def test_ragged_or_missing_vectors_are_errors(spark, bad):
    df = spark.createDataFrame([(0, "a", [1.0, 0.0]), (1, "b", bad)], "row_id long, label string, embedding array<float>")
    with pytest.raises(Exception, match="vector"):
        m.similar_pairs(df).collect()


def test_blocks_dealt_to_few_partitions(clustered, monkeypatch):
    from labelweave.operators import blocks
    rows, df = clustered
    want = ids(m.similar_pairs(df, block_rows=7))
    monkeypatch.setattr(blocks, "MAX_PARTITIONS", 3)
    assert ids(m.similar_pairs(df, block_rows=7)) == want


def test_one_target_with_most_pairs(spark):
    labels = spark.range(3000).selectExpr("id AS row_id", "concat('l', id) AS label")
    pairs = spark.range(1, 3000).selectExpr("id AS source_id", "0L AS target_id")
    got = m.label_pairs(pairs, labels)
    assert got.count() == 2999 and got.where("target_label <> 'l0' OR source_label <> concat('l', source_id)").count() == 0
    assert m.compartments(pairs, labels).count() == 3000
