import numpy as np
import pytest
from pyspark.sql import functions as F

from labelweave.operators import articles as a
from labelweave.operators import records as rec
from labelweave.operators import themes as th
from labelweave.operators.rules import summarize_rules
from queries.common import vectors
from conftest import SF


def test_keywords_and_stop_words(spark):
    df = spark.createDataFrame([(1, "même meme dans energie, energie"), (2, ""), (3, "aaaa bbbb aaaa cccc bbbb dddd"),
                                (4, "zzzz\nyyyy\tzzzzz zzzz. zzzz")], "article_id long, text string")
    got = {r.article_id: r.keywords for r in a.extract_keywords(df).collect()}
    assert got == {1: ["meme", "energie,", "energie"], 2: [], 3: ["aaaa", "bbbb", "cccc", "dddd"],
                   4: ["zzzz", "yyyy", "zzzzz", "zzzz."]}
    # filters on the result must not change it
    assert a.extract_keywords(df).where("size(keywords) > 3").count() == 2


def test_key_phrases(spark):
    text = ("Short. The solar energy plan needs energy storage! Nothing here to see at all, really nothing, so long "
            "that it must be cut? energy energy plan… ")
    got = a.extract_key_phrases(spark.createDataFrame([(1, text)], "article_id long, text string")).first().key_phrases
    # two sentences hold half as many keywords as words plus one; the earlier comes first
    assert got == ["The solar energy plan needs energy storage",
                   "Nothing here to see at all, really nothing, so long...", "energy energy plan…"]


def test_scores(spark):
    df = spark.createDataFrame([(0.2, 0.6, 0.5, 500)], "a double, m double, k double, n long")
    got = df.select(F.round(a.combined_score("a", "m", "k"), 9), F.round(a.combined_score("a", "m", "k", "n"), 9)).first()
    assert tuple(got) == (0.52, 0.57)


def test_category_statistics_agree(spark):
    v = vectors(spark, SF)
    art = v.where("row_id < 40").select(F.col("row_id").alias("article_id"), "embedding", F.array(F.lit("hot")).alias("keywords"))
    entries = v.select(F.concat(F.lit("c"), F.col("cluster").cast("string")).alias("category"), F.lit("hot").alias("name"),
                       F.col("row_id").alias("ord"), F.col("label").alias("entry"), "embedding")
    got = {(r.article_id, r.category): r for r in a.article_entry_similarity(art, entries).collect()}
    plain = {(r.article_id, r.category): r.max_similarity for r in a.similarity_stats(art, entries).collect()}
    rows = {r.row_id: r for r in v.collect()}
    unit = lambda r: np.array(r.embedding) / np.linalg.norm(r.embedding)
    assert len(got) == 40 * 10 and set(got) == set(plain)
    for (article, category), r in list(got.items())[::17]:
        group = [e for e in rows.values() if f"c{e.cluster}" == category]
        sims = sorted(((-round(float(unit(rows[article]) @ unit(e)), 12), e.row_id, e.label) for e in group))
        assert r.avg_similarity == pytest.approx(-np.mean([s[0] for s in sims])) and plain[article, category] == r.max_similarity
        assert r.max_similarity == pytest.approx(-sims[0][0]) and r.top_entries == ", ".join(s[2] for s in sims[:3])
        assert r.keyword_similarity == 1.0


def test_categories_over_many_blocks_give_the_same(spark):
    v = vectors(spark, SF)
    art = v.where("row_id < 12").select(F.col("row_id").alias("article_id"), "embedding", F.array(F.lit("hot"), F.lit("ring")).alias("keywords"))
    # one category with most rows, copies among them, and a small one
    entries = v.select(F.when(F.col("row_id") % 20 == 0, "small").otherwise("large").alias("category"), F.lit("hot").alias("name"),
                       F.col("row_id").alias("ord"), F.col("label").alias("entry"), "embedding").cache()
    entries = entries.unionByName(entries.where("ord < 60").withColumn("ord", F.col("ord") + 100_000))
    def got(n):
        return sorted((r.article_id, r.category, round(r.avg_similarity, 9), round(r.max_similarity, 9), r.top_entries, r.top_scores,
                       round(r.keyword_similarity, 9)) for r in a.article_entry_similarity(art, entries, block_rows=n).collect())
    want = got(8192)
    assert len(want) == 24 and got(64) == want and got(7) == want
    bare = a.similarity_stats(art, entries).collect()
    assert sorted((r.article_id, r.category, round(r.avg_similarity, 9)) for r in bare) == [w[:3] for w in want]


def test_articles_with_control_characters_repeats_and_no_text(spark):
    df = spark.createDataFrame([
        (1, "word " * 200_000), (2, "alpha\u0001beta gamma alpha\u0001beta gamma gamma"), (3, ""), (4, None),
        (5, "One sentence with a \u0001e mark in it. Another sentence without it!")], "article_id long, text string")
    got = {r.article_id: r.keywords for r in a.extract_keywords(df).collect()}
    assert got[1] == ["word"] and got[2] == ["gamma", "alpha\u0001beta"] and got[3] == got[4] == []
    phrases = {r.article_id: r.key_phrases for r in a.extract_key_phrases(df).collect()}
    assert set(phrases[5]) == {"One sentence with a \u0001e mark in it", "Another sentence without it"}
    entries = spark.createDataFrame([("x:\u0002\u0001y", "a", 0, "alpha beta")], "category string, name string, ord long, entry string")
    from labelweave.operators.embed import embed_text
    from labelweave.plans.articles import Categories, classify_articles
    entries = embed_text(entries, "entry")
    sizes = spark.createDataFrame([("x:\u0002\u0001y", "t", 5)], "category string, veille_type string, count long")
    out = {r.article_id: r for r in classify_articles(df, Categories(entries, entries, sizes)).result.collect()}
    assert set(out) == {1, 2, 3, 4, 5} and out[2].best_theme == "x:\u0002\u0001y" and out[2].best_veille_type == "t"
    assert out[3].best_theme is None and out[4].best_veille_type is None


def test_themes_that_share_31_characters_stay_apart(spark):
    long = "A theme whose name is rather long and ends in "
    df = spark.createDataFrame([(i, f"label {i}", long + "one" * (i % 2) + "two" * (1 - i % 2)) for i in range(8)],
                               "label_id long, label string, theme string")
    counts = a.theme_entries(df, n=3).groupBy("category").count().collect()
    assert {(r.category, r["count"]) for r in counts} == {(long + "one", 3), (long + "two", 3)}
    assert a.theme_entries(df, n=-1).count() == 8


def test_sorted_labels_are_in_order_as_a_whole(spark):
    df = spark.range(400).select(F.col("id").alias("label_id"), F.expr("concat('l', id % 37)").alias("label"),
                                 F.expr("concat('t', id % 3)").alias("theme")).repartition(8)
    rows = [(r.theme, r.label, r.label_id) for r in th.sort_labels(df).collect()]
    assert rows == sorted(rows)


def test_types(spark):
    rows = [(0, "Légale", "Qualité", "x"), (1, "LEGALE", "b", None), (2, None, "c", "d"), (3, " ", "e", "f"), (4, "autre", "b", "y")]
    df = spark.createDataFrame(rows, "row_id long, t string, d string, s string")
    got = [tuple(r) for r in rec.type_summary(df, "t", "d", "s").collect()]
    assert got == [("Légale", 2, "Yes"), ("unknown", 1, "No"), ("autre", 1, "No")]
    pairs = {tuple(r)[:4] for r in rec.type_domain_pairs(df, "t", "d", "s").collect()}
    assert pairs == {("Légale", "Qualité", "x", "Yes"), ("Légale", "b", "", "Yes"), ("unknown", "c", "d", "No"), ("autre", "b", "y", "No")}


def test_distribution_is_of_the_shown_rows(spark):
    df = spark.createDataFrame([("a", 50), ("b", 30), ("c", 20)], "Type string, Count long")
    got = [(r.Type, r.Percentage, r.OverallPercentage) for r in rec.distribution(df, 2).collect()]
    assert got == [("a", 62.5, 50.0), ("b", 37.5, 30.0)]
    assert rec.distribution(df, 3, min_share=0.25).count() == 2


def test_theme_names_clash_without_loss(spark):
    rows = [(i, label, c) for i, (label, c) in enumerate(
        [("red ring", 0), ("red ring", 0), ("ring redd", 0), ("redd ring", 1), ("go", 2), ("up", 2)])]
    df = spark.createDataFrame(rows, "row_id long, label string, cluster int")
    themed = th.theme_assignment(df)
    assert themed.count() == 6
    names = {r.cluster: r.theme for r in themed.collect()}
    assert names == {0: "Ring / redd", 1: "Redd / ring", 2: "Go"}
    twin = th.theme_assignment(df.withColumn("cluster", F.when(F.col("row_id") < 3, F.col("row_id")).otherwise(9)))
    names = {r.cluster: r.theme for r in twin.collect()}
    assert twin.count() == 6 and names[1] == names[0] + " (2)"


def test_rename_and_reassign(spark):
    themed = spark.createDataFrame([(1, "b", "A"), (7, "a", "A"), (3, "c", "B")], "label_id long, label string, theme string")
    moves = spark.createDataFrame([(7, "a", "A", "B")], "label_id long, label string, old_theme string, new_theme string")
    mapping = spark.createDataFrame([("A", "Alpha")], "old_theme string, new_theme string")
    got = sorted(map(tuple, th.reassign_entries(themed, moves, mapping).collect()))
    assert got == [(1, "b", "Alpha"), (3, "c", "B"), (7, "a", "B")]
    summary = {r.Theme: (r.Count, r.Examples) for r in th.theme_summary(th.reassign_entries(themed, moves)).collect()}
    assert summary == {"A": (1, "b"), "B": (2, "a, c")}


def test_clusters_are_total_and_repeatable(spark):
    v = vectors(spark, SF).drop("cluster").cache()
    one = {r.row_id: r.cluster for r in th.cluster_themes(v, 6).collect()}
    two = {r.row_id: r.cluster for r in th.cluster_themes(v, 6).collect()}
    assert one == two and len(one) == v.count() and set(one.values()) <= set(range(6))


def test_rules(spark):
    df = spark.createDataFrame([("r1", "bad", " d ", [("a", {"k": "v"}), ("b", {})], {"type": "merge", "into": "x"}),
                                ("r2", "-1", None, None, None)],
                               "id string, priority string, description string, "
                               "condition array<struct<tag:string,attrs:map<string,string>>>, action map<string,string>")
    got = [tuple(r) for r in summarize_rules(df).collect()]
    assert got == [("r2", -1, "", "", ""), ("r1", 0, "d", "a(k=v) & b", "merge(into=x)")]


def test_type_lookup(spark):
    summary = spark.createDataFrame([("Veille légale et sociale", 9), ("légale", 4)], "Type string, Count long")
    sheets = spark.createDataFrame([("légale",), ("sociale",), ("absent",)], "sheet string")
    got = {r.sheet: (r.veille_type, r["count"]) for r in a.type_lookup(sheets, summary).collect()}
    assert got == {"légale": ("Veille légale et sociale", 9), "sociale": ("Veille légale et sociale", 9), "absent": ("absent", 0)}
    # equal counts: the first in the summary's order
    tied = spark.createDataFrame([("b legal", 4, 1), ("z legal", 4, 0), ("a legal", 4, 2)], "Type string, Count long, first_row long")
    assert a.type_lookup(spark.createDataFrame([("legal",)], "sheet string"), tied).first().veille_type == "z legal"
    assert a.type_lookup(sheets, tied.limit(0)).count() == 3 and a.type_lookup(sheets.limit(0), tied).count() == 0
