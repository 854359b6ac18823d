"""Examples are made without meeting all merges: drawn pairs are judged alone, features come from where pairs are found."""

import numpy as np
import pytest

from labelweave.functions.similarity import jaro_winkler_arrays
from labelweave.operators import grouping as g
from labelweave.operators import matching as m
from labelweave.operators import model as mo

COS, JW = 0.5, 0.8


@pytest.fixture(scope="module")
def labels(spark):
    """Labels with copies, whose measure depends on which of them comes first, and a zero vector."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(4, 8))
    rows = [(i, ["bcab", "abca", "hot gear", "hot gears"][i % 4], [float(np.float32(x)) for x in base[i % 3] + 0.4 * rng.normal(size=8)])
            for i in range(60)]
    rows += [(100 + i, *rows[i][1:]) for i in range(5)] + [(200, "hot gear", [0.0] * 8), (201, "hot gear", [0.0] * 8)]
    return spark.createDataFrame(rows, "row_id long, label string, embedding array<float>").cache()


def pairs_of(df):
    return sorted((r[0], r[1]) for r in df.collect())


def test_drawn_pairs_are_judged_as_by_all_merges(spark, labels):
    classes = m.class_table(labels)
    merges = m.similar_classes(labels, classes, cos_min=COS, jw_min=JW).select("source_id", "target_id")
    rule = lambda pairs: m.linked_pairs(pairs, labels, COS, JW)
    every = labels.selectExpr("row_id i").join(labels.selectExpr("row_id j"), on=None).where("i < j")
    assert pairs_of(mo.negative_candidates(every, rule)) == pairs_of(mo.negative_candidates(every, merges, classes))
    want = pairs_of(mo.sample_negatives(labels, merges, 50, classes=classes))
    assert pairs_of(mo.sample_negatives(labels, rule, 50)) == want and len(want) == 50


def test_features_found_with_the_pairs_are_those_of_the_labels(spark, labels):
    merges = m.similar_classes(labels, cos_min=COS, jw_min=JW, with_lex=True)
    negatives = mo.sample_negatives(labels, lambda pairs: m.linked_pairs(pairs, labels, COS, JW), 20)
    got = mo.known_features(merges, negatives, labels)
    want = mo.pair_features(mo.union_examples(merges, negatives), labels)
    rows = lambda df: sorted((r.i, r.j, round(r.lex, 12), round(r.cos, 12), r.label) for r in df.collect())
    assert rows(got) == rows(want)


def test_compartments_read_their_pairs_once(spark, labels):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    pairs = spark.createDataFrame([(1, 0), (2, 0), (2, 0), (5, 4)], "source_id long, target_id long").mapInArrow(
        count, "source_id long, target_id long")
    got = m.compartments(pairs, labels)
    assert [(r.canonical_id, r.member_id) for r in got.collect()] == [(0, 0), (0, 1), (0, 2), (4, 4), (4, 5)]
    assert seen.value == 4


def test_groups_of_representatives_and_their_copies_are_all_groups(spark, labels):
    model = mo.MergeModel(intercept=-6.0, lexical=7.0, cosine=5.0)
    pairs = spark.createDataFrame([(9, 2), (102, 100), (201, 200)], "source_id long, target_id long")  # 100 is a copy of 0
    want = sorted((r.seed_id, r.member_id) for r in g.classify_all_groups(labels, pairs, model, 0.6).collect())
    found = g.classify_all_groups(labels, pairs, model, 0.6, every_copy=False).collect()
    of = {r.row_id: r.representative for r in m.class_table(labels).collect()}
    groups = [(r.seed_id, r.member_id) for r in found if r.relation == "group"]
    assert len(groups) == len(set(groups)) and {x for pair in groups for x in pair} <= set(of.values())
    assert {r.member_id: r.seed_id for r in found if r.relation == "copy"} == {i: r for i, r in of.items() if i != r}
    expanded = sorted((s, i) for s in (2, 100, 200) for i in of if (of[s], of[i]) in set(groups))
    assert expanded == want and len(found) < len(want) + len(of)
