import os

from pyspark.sql import functions as F

from conftest import SF
from labelweave.operators.embed import embed_text, register_encoder
from labelweave.operators.records import sort_by_match
from labelweave.operators.rules import summarize_rules
from labelweave.sources import readers as r
from labelweave.sources import writers as w
from queries.common import taxonomy, themed_input


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_taxonomy_sources_keep_order(spark, folder):
    one = put(folder, "one.csv", "Énergie,Solaire\nEau,\n")
    two = put(folder, "two.tsv", "A\tB\tC,D\nE\t\tnull\n")
    assert r.sniff_delimiter(spark, one) == "," and r.sniff_delimiter(spark, two) == "\t"
    got = [(x.row_id, x.source_ord, x.levels) for x in r.read_taxonomy(spark, [one, two]).orderBy("row_id").collect()]
    assert got == [(0, 0, ["Énergie", "Solaire", None]), (1, 0, ["Eau", "", None]), (2, 1, ["A", "B", "C,D"]),
                   (3, 1, ["E", "", "null"])]


def test_taxonomy_round_trip_over_many_splits(spark, folder):
    df = taxonomy(spark, SF)
    w.write_taxonomy(df, f"{folder}/t")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # many splits per file
    try:
        back = r.read_taxonomy(spark, [f"{folder}/t"])
        got = {x.row_id: x.levels for x in back.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {x.row_id: x.levels for x in df.collect()}
    assert got == want


def test_records(spark, folder):
    path = put(folder, "data.csv", 'titre,note,enr\n"a, b","line\nbreak","{""isMatch"": false}"\nc,,"isMatch: true"\n')
    df = r.read_records(spark, path)
    assert [tuple(x) for x in df.orderBy("row_id").collect()] == [
        (0, "a, b", "line\nbreak", '{"isMatch": false}'), (1, "c", None, "isMatch: true")]
    assert [x.titre for x in sort_by_match(df).collect()] == ["c", "a, b"]
    w.write_csv(df, f"{folder}/out", sep="\t")
    again = r.read_records(spark, f"{folder}/out", row_ids=False)
    assert again.count() == 2 and again.columns == df.columns


def test_pairs_embeddings_and_meta(spark, folder):
    w.write_csv(spark.createDataFrame([(3, 1)], "source_id long, target_id long"), f"{folder}/pairs")
    assert tuple(r.read_merge_pairs(spark, f"{folder}/pairs").first()) == (3, 1)
    labels = taxonomy(spark, SF).select("row_id", "label")
    w.write_embeddings(embed_text(labels), f"{folder}/emb", "part", "trigrams")
    back = r.read_embeddings(spark, f"{folder}/emb/vectors")
    r.check_aligned(labels, back)
    assert tuple(r.read_embeddings_meta(spark, f"{folder}/emb").first()) == ("part", "trigrams", 64, None)
    assert r.read_embeddings(spark, f"{folder}/emb/vectors", first=5).count() == 5


def test_custom_encoder(spark):
    import numpy as np
    register_encoder("lengths", lambda: lambda texts: np.array([[len(t), 1.0] for t in texts]))
    df = spark.createDataFrame([("abc",), (None,)], "label string")
    assert [x.embedding for x in embed_text(df, encoder="lengths").collect()] == [[3.0, 1.0], None]


def test_sheets(spark, folder):
    themed = themed_input(spark, SF)
    w.write_sheets(themed, f"{folder}/s", "theme", ["label", "label_id"],
                   themed.groupBy("theme").agg(F.count("*").alias("Count")))
    assert r.read_sheets(spark, f"{folder}/s").count() == themed.count()
    one = r.read_summary(spark, f"{folder}/s").first()
    key = themed.where(F.col("theme") == one.theme).select(w.sheet_key("theme")).first()[0]
    assert r.read_sheets(spark, f"{folder}/s", key).count() == one.Count


def test_articles_rules_and_audit(spark, folder):
    os.mkdir(f"{folder}/art")
    put(f"{folder}/art", "a.txt", "first\nline")
    put(f"{folder}/art", "b.txt", "second")
    assert sorted(x.text for x in r.read_articles(spark, f"{folder}/art").collect()) == ["first\nline", "second"]
    path = put(folder, "rules.xml", """<rules><cursorRule id="r9" priority="2"><description> Merge twins </description>
<condition><lexical min="0.8" algo='jw'/><cosine min="0.85"/><same/></condition><action type="merge" into="first"/></cursorRule>
<cursorRule id="r1" priority="1"><description>d</description><action type="flag"/></cursorRule></rules>""")
    got = [tuple(x) for x in summarize_rules(r.read_rules(spark, path)).collect()]
    assert got == [("r1", 1, "d", "", "flag"),
                   ("r9", 2, "Merge twins", "lexical(min=0.8, algo=jw) & cosine(min=0.85) & same", "merge(into=first)")]
    pairs = spark.createDataFrame([(2, 1, "dup-merge-5", "k", None, None), (3, 1, "sim-merge-1", None, 0.9, 0.95)],
                                  "source_id long, target_id long, rule string, norm_key string, jw double, cos double")
    w.write_audit(pairs, f"{folder}/audit")
    assert sorted(x.value for x in spark.read.text(f"{folder}/audit").collect()) == [
        "rule=dup-merge-5 src=2 tgt=1 norm='k'", "rule=sim-merge-1 src=3 tgt=1 jw=0.900, cos=0.950"]
