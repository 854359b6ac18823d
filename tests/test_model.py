import numpy as np
import pytest
from pyspark.sql import functions as F

from labelweave.functions.similarity import jaro_winkler_arrays, unit_rows
from labelweave.operators import grouping as g
from labelweave.operators import model as mo
from labelweave.plans.classifier import train


@pytest.fixture(scope="module")
def labels(spark):
    rng = np.random.default_rng(11)
    names = ["red ring", "red rings", "blue bolt", "blue bolts", "old plate", "cold plate", "hot gear", "hot gears"]
    rows = [(i, names[i % 8] + (" x" if i > 23 else ""), [float(x) for x in
             np.eye(8)[i % 8 // 2] + 0.2 * rng.normal(size=8)]) for i in range(40)]
    return rows, spark.createDataFrame(rows, "row_id long, label string, embedding array<float>").cache()


MODELS = [mo.MergeModel(-6.0, 7.0, 4.0), mo.MergeModel(0.5, -2.0, 3.0), mo.MergeModel(60.0, 20.0, 20.0)]


def scores(model, left, right):
    u = unit_rows(np.array([r[2] for r in left], dtype=np.float32)) @ unit_rows(
        np.array([r[2] for r in right], dtype=np.float32)).T
    lex = np.array([jaro_winkler_arrays([a[1]] * len(right), [b[1] for b in right]) for a in left])
    return lex, u, model.logit(lex, u)


def test_negatives_exclude_positives_whichever_way_round(spark):
    labels = spark.createDataFrame([(i, "x") for i in range(4)], "row_id long, label string")
    pos = spark.createDataFrame([(1, 0)], "source_id long, target_id long")
    got = [(r.i, r.j) for r in mo.sample_negatives(labels, pos, 100).collect()]
    assert sorted(got) == [(0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]


def test_sample_is_exact_distinct_and_seeded_on_gapped_ids(spark):
    labels = spark.range(0, 3000, 7).withColumnRenamed("id", "row_id")
    pos = spark.createDataFrame([(14, 0), (21, 7)], "source_id long, target_id long")
    def draw(seed):
        return [(r.i, r.j) for r in mo.sample_negatives(labels, pos, 200, seed).collect()]
    a, b = draw(1), draw(2)
    assert len(set(a)) == 200 and a == draw(1) and set(a) != set(b)
    assert all(i < j and i % 7 == 0 and j % 7 == 0 for i, j in a) and not {(0, 14), (7, 21)} & set(a)
    # the first of a larger sample are the smaller sample
    more = [(r.i, r.j) for r in mo.sample_negatives(labels, pos, 3000, 1).collect()]
    assert more[:200] == a and len(set(more)) == 3000


def test_sample_takes_all_pairs_when_there_are_fewer(spark):
    labels = spark.createDataFrame([(3,), (10,), (11,), (500,)], "row_id long")
    pos = spark.createDataFrame([(10, 3)], "source_id long, target_id long")
    got = {(r.i, r.j) for r in mo.sample_negatives(labels, pos, 100).collect()}
    assert got == {(3, 11), (3, 500), (10, 11), (10, 500), (11, 500)}
    assert mo.sample_negatives(labels.limit(1), pos, 5).count() == 0


def test_split_keeps_class_shares(spark):
    df = spark.range(1000).select(F.col("id").alias("i"), (F.col("id") + 1).alias("j"),
                                  (F.col("id") % 10 == 0).cast("int").alias("label"))
    got = {(r.label, r.is_test): r.n for r in mo.stratified_split(df).groupBy("label", "is_test").agg(
        F.count("*").alias("n")).collect()}
    assert got == {(1, True): 20, (1, False): 80, (0, True): 180, (0, False): 720}


def test_training_separates_and_reports(spark, labels, folder):
    rows, df = labels
    pos = spark.createDataFrame([(j, i) for i in range(40) for j in range(i + 1, 40)
                                 if i % 8 // 2 == j % 8 // 2], "source_id long, target_id long")
    out = train(df, pos, 150)
    assert out.model.cosine > 0 and out.auc > 0.95
    report = {r["name"]: r for r in out.metrics.collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    from labelweave.sources.readers import load_model
    from labelweave.sources.writers import save_model
    save_model(out.pipeline, f"{folder}/model")
    assert mo.coefficients(load_model(f"{folder}/model")) == out.model


def test_metrics_and_auc(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.1)], "label int, probability double")
    assert abs(mo.roc_auc(df) - 0.875) < 1e-12
    pred = df.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    r = {x["name"]: x for x in mo.classification_metrics(pred).collect()}
    assert r["1"].precision == 1.0 and r["1"].recall == 0.5 and r["accuracy"].f1 == 0.75 and r["0"].support == 2


@pytest.mark.parametrize("model", MODELS)
def test_groups_match_brute_force_and_one_seed_agrees(spark, labels, model):
    rows, df = labels
    pairs = spark.createDataFrame([(9, 1), (12, 3), (30, 6)], "source_id long, target_id long")
    seeds = [rows[i] for i in (1, 3, 6)]
    _, _, z = scores(model, seeds, rows)
    p = 1 / (1 + np.exp(-z))
    want = sorted((seeds[i][0], rows[j][0], round(p[i, j], 9)) for i, j in zip(*np.nonzero(p >= 0.5)))
    got = g.classify_all_groups(df, pairs, model).collect()
    assert sorted((r.seed_id, r.member_id, round(r.merge_probability, 9)) for r in got) == want
    one = g.classify_group(df.where("row_id <> 0 or true"), "Blue BOLTS", model).collect()
    assert [(r.member_id, round(r.merge_probability, 9)) for r in one] == [
        (r.member_id, round(r.merge_probability, 9)) for r in got if r.seed_id == 3]


@pytest.mark.parametrize("model", MODELS)
def test_assignment_matches_brute_force(spark, labels, model):
    rows, df = labels
    rng = np.random.default_rng(5)
    recs = [(i, f"{rows[(i * 7) % 40][1]} no {i % 3}", [float(x) for x in rng.normal(size=8)]) for i in range(50)]
    records = spark.createDataFrame(recs, "row_id long, title string, embedding array<float>")
    _, _, z = scores(model, recs, rows)
    key = np.round(np.minimum(z, g.SATURATED_LOGIT), g.TIE_DIGITS)
    got = {r.row_id: r for r in g.assign_records(records, df, model).collect()}
    assert len(got) == 50
    for i in range(50):
        assert got[i].assigned_taxo_id == rows[int(np.argmax(key[i]))][0]
        assert abs(got[i].merge_probability - 1 / (1 + np.exp(-z[i].max()))) < 1e-9 or model.intercept > 50


def test_seed_rules(spark, labels):
    _, df = labels
    top = g.topic_group(df, "HOT gear", 0.5).collect()
    assert top[0].member_id == 6 and abs(top[0].similarity - 1) < 1e-9
    with pytest.raises(ValueError):
        g.topic_group(df, "absent")
    assert g.find_seed(df, "hot gea", nearest=True).label == "hot gear"
