import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from labelweave.llm import bpe, hyperminhash, positional_index, quality, quotations, secrets
from labelweave.llm.sql import DECONTAMINATION_SQL, NEAR_DUPLICATES_SQL, QUOTATIONS_SQL

SCHEMA = "conv_id long, turn long, role string, text string, root string, hash string"
MESSAGES = [
    (1, 0, "user", "How do I  sort a list?\nIt has dates."),
    (1, 1, "assistant", "Use sorted().\n\nPass a key."),
    (1, 2, "user", "> how do i sort a list?\n> It has dates.\nNever mind that."),
    (1, 3, "user", "> > How do I sort a list?\n>> It has dates.\n> Never mind that.\nThen what?"),
    (1, 4, "user", "> use SORTED().\n> unknown words\nThanks"),
    (1, 5, "user", "> > Use sorted().\nonly deep"),
    (1, 6, "user", "> Then what?\n\n> Thanks\nboth"),
    (1, 7, "user", ">\n> \nno words quoted"),
    (1, 8, "user", "> no words quoted\n> Then what?\n> Thanks"),
    (2, 0, "user", "> Use sorted().\nanother conversation"),
    (2, 1, "user", None), (2, 2, "user", ""), (2, 3, None, "> another conversation"),
    (None, 1, "user", "> a\nb"), (2, None, "user", "c"),
    (3, 0, "user", "x\n" * 5_000), (3, 1, "user", "> x\n" * 5_000 + "y"), (3, 1, "user", "> x\n" * 5_000 + "y"),
]


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame([(*m, "clash", "clash") for m in MESSAGES], SCHEMA)


def test_replies_follow_what_they_quote(messages):
    rows = quotations.reply_order(messages).collect()
    got = {(r.conv_id, r.turn): (r.parent, r.root, r.depth, r.text) for r in rows}
    assert len(rows) == len(MESSAGES)
    assert got[1, 1] == (None, 1, 0, "Use sorted().\n\nPass a key.")
    assert got[1, 2] == (0, 0, 1, "Never mind that.")
    assert got[1, 3] == (2, 0, 2, "Then what?")
    assert got[1, 4] == (1, 1, 1, "Thanks")
    assert got[1, 5] == (1, 1, 1, "only deep")
    assert got[1, 6] == (4, 1, 2, "both")
    assert got[1, 7] == (None, 7, 0, "no words quoted")
    assert got[1, 8][0] == 7
    assert got[2, 0] == (None, 0, 0, "another conversation")
    assert got[2, 1] == (None, 1, 0, None) and got[2, 2] == (None, 2, 0, "")
    assert got[2, 3][:3] == (0, 0, 1)
    assert got[None, 1][:3] == (None, 1, 0) and got[2, None][:3] == (None, None, 0)
    assert got[3, 1] == (0, 0, 1, "y")


def same(spark_df, relation):
    columns = sorted(spark_df.columns)
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, spark_df.select(*columns).collect())) == order(relation.select(*columns).fetchall())


def test_quotation_sql(messages):
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", MESSAGES)
    same(quotations.reply_order(messages), con.sql(QUOTATIONS_SQL))


def test_threads_come_in_blocks_in_order(messages):
    rows = quotations.conversations(messages.filter("conv_id = 1")).collect()
    assert {(r.root, tuple(m.turn for m in r.messages)) for r in rows} == {
        (0, (0, 2, 3)), (1, (1, 4, 5, 6)), (7, (7, 8))}


def test_long_chains_and_empty_tables(spark, messages):
    chain = spark.createDataFrame([(1, k, k - 1) for k in range(1, 50)], "conv_id long, turn long, parent long")
    assert {(r.turn, r.root, r.depth) for r in quotations.threads(chain).collect()} == {(k, 0, k) for k in range(1, 50)}
    assert quotations.reply_order(messages.limit(0)).count() == 0


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    import random
    draw = random.Random(3)
    words = ["river", "stone", "garden", "letter", "window", "morning", "paper", "silver", "winter", "market", "road",
             "people", "under", "after", "because", "never", "story", "green", "little", "house", "walks", "before"]
    text = lambda n: " ".join(draw.choices(words, k=n))
    item = text(14)
    copied = text(80)
    rows = [(0, text(60)), (1, copied), (2, copied.upper()), (3, copied + " end"), (4, f"{text(30)} {item} {text(20)}"),
            (5, f"{text(20)} token = abcdef0123456789 {text(20)}"), (6, "word " * 60), (7, ""), (8, None), (9, text(400)),
            (10, text(50)), (10, text(50)), (None, text(70))]
    rows.append(rows[0])
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS).write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_every_stage_against_its_operator(spark, corpus, folder):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    ids = lambda df: sorted((r.doc_id is None, r.doc_id) for r in df.select("doc_id").collect())
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{folder}/{number}"
        stage(spark, docs, corpus).write.parquet(out)
        after = spark.read.parquet(out)
        if name == "quality_rules":
            assert ids(after) == ids(quality.quality_rules(docs).filter("kept"))
        elif name == "near_duplicates":
            assert ids(after) == ids(hyperminhash.near_duplicates(docs.dropDuplicates(["doc_id", "text"])).filter("kept"))
            assert {1, 2, 3} & {r.doc_id for r in after.collect()} == {1}
            assert [r.doc_id for r in after.collect()].count(0) == 1
        elif name == "decontamination":
            bench = spark.read.parquet(f"{corpus}/benchmark.parquet")
            gone = {r.doc_id for r in positional_index.decontaminate(docs, bench).filter("contaminated").collect()}
            assert gone == {4} and ids(after) == [i for i in ids(docs) if i[1] not in gone]
        elif name == "secret_scan":
            assert ids(after) == ids(docs)
            assert secrets.find_secrets(after).filter("spans <> ''").count() == 0
            assert after.filter("n_chars <> length(text)").count() == 0
            assert "[assign]" in after.filter("doc_id = 5").first().text
        if name != "byte_bpe":
            assert after.columns == docs.columns
        else:
            assert ids(after) == ids(docs)
            decoded = {bytes(r.decoded).decode() for r in bpe.decode_documents(after).collect()}
            assert decoded == {r.text for r in docs.collect()}
        docs = after


def test_run_equals_the_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus)
    same = lambda df: sorted((str(r.doc_id), r.ids_sha256) for r in df.select("doc_id", "ids_sha256").collect())
    assert same(corpus_pipeline.run(spark, corpus)) == same(docs)


@pytest.mark.parametrize("query, operator", [
    (NEAR_DUPLICATES_SQL, lambda s, d, b: hyperminhash.near_duplicates(d)),
    (DECONTAMINATION_SQL, lambda s, d, b: positional_index.decontaminate(d, b))])
def test_sql_at_the_smallest_size(spark, query, operator):
    base = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "benchmark"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet'")
    same(operator(spark, docs, bench), con.sql(query))


def test_stages_on_an_empty_table(spark, corpus):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus)
        assert docs.count() == 0 and (name == "byte_bpe" or docs.columns == corpus_pipeline.COLUMNS)


def test_stage_links_pairs_from_eighty_per_cent(spark):
    rows = []
    for k in range(12):
        words = [f"t{k}w{i}" for i in range(104)]  # 100 shingles; a changed end of m words leaves (100-m)/(100+m)
        rows += [(3 * k, " ".join(words)), (3 * k + 1, " ".join([*words[:-10], *(f"x{k}y{i}" for i in range(10))])),
                 (3 * k + 2, " ".join([*words[:-12], *(f"u{k}v{i}" for i in range(12))]))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    # 90 / 110 = 0.82 goes, 88 / 112 = 0.79 stays; the query's own threshold of 0.85 keeps all
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()}
    assert kept == {i for i, _ in rows if i % 3 != 1}
    assert hyperminhash.near_duplicates(docs).filter("kept").count() == len(rows)


def test_decontamination_stage_judges_every_row_by_its_text(spark, tmp_path):
    item = " ".join(f"w{k}" for k in range(12))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"some {item} more"), (None, "clean without an id"), (5, f"other {item}"), (5, "clean with a shared id"),
            (6, f"other {item}"), (7, None), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = {(r.doc_id, r.text) for r in corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path)).collect()}
    assert got == {(None, "clean without an id"), (5, "clean with a shared id"), (7, None), (7, "")}


def test_near_duplicate_stage_compares_rows_without_ids(spark):
    text = lambda name, n=60: " ".join(f"{name}{k}" for k in range(n))
    rows = [(None, text("a")), (None, text("a") + " end"), (None, text("a")),  # a group without ids
            (9, text("b")), (None, text("b") + " end"), (4, text("b")), (4, text("b")),  # copies of a document with ids
            (None, text("c")), (12, text("d")), (12, text("e")), (3, text("e") + " end"),  # an id with two texts
            (None, ""), (None, ""), (20, None), (21, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()
    first = [r for r in got if r.text and r.text.startswith("a0")]
    assert len(first) == 1 and first[0].doc_id is None
    rest = sorted((r.doc_id or 0, r.text or "") for r in got if r not in first)
    assert rest == sorted([(4, text("b")), (0, text("c")), (12, text("d")), (3, text("e") + " end"), (0, ""), (20, ""), (21, "")])


def test_stages_take_clashing_names(spark, corpus):
    names = ["row", "all", "least", "grouped", "gone_number", "number", "label", "kept", "stays", "times", "digest", "node", "base"]
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    same = lambda df: sorted((str(r.doc_id), r.text or "") for r in df.select("doc_id", "text").collect())
    for name, stage in corpus_pipeline.STAGES[:4]:
        more = docs.select("*", *(F.lit("x").alias(n) for n in names))
        after = stage(spark, more, corpus)
        assert after.columns == corpus_pipeline.COLUMNS and same(after) == same(stage(spark, docs, corpus)), name


def test_rows_keep_their_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", "x", 1), (2, "a b c d e f g", "y", 2), (None, None, None, 3)],
                                 "doc_id long, text string, row string, `all` long")
    assert sorted(map(str, hyperminhash.one_of_each(docs).collect())) == sorted(map(str, docs.filter("`all` <> 2").collect()))
    items = spark.createDataFrame([(1, "e f")], "item_id long, text string")
    assert [r["all"] for r in positional_index.without_contaminated(docs, items).collect()] == [3]
