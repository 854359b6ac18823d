"""Benchmark decontamination by a positional inverted index of the training tokens. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower_column, numbered, sized, stored, with_row

WINDOW = 10
#: Fixed by the contract: words are runs of ASCII letters and digits and of anything beyond ASCII.
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words of a text; none for null."""
    return F.array_remove(F.split(ascii_lower_column(F.coalesce(text, F.lit(""))), GAP), "")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often the *terms* occur in *docs* (doc_id, text); absent terms have no row."""
    return (docs.select(F.explode(words(F.col("text"))).alias("term")).join(sized(terms), "term", "left_semi")
            .groupBy("term").agg(F.count("*").alias("n")))


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Postings (term, doc_id, pos) of *docs* (doc_id, text), stored in the shared folder.

    With *terms* only their lists are kept: an index that serves a known set of queries needs no others. An id stands
    for one row.
    """
    postings = docs.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    if terms is not None:
        postings = postings.join(sized(terms), "term", "left_semi")
    return stored(postings.select("term", "doc_id", "pos"))


def rarest_terms(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """(phrase_id, n, first, first_at, second, second_at): the two rarest terms of each phrase and their places.

    Phrases (phrase_id, terms) with a term that never occurs cannot occur and are dropped. A phrase of one
    term has no second.
    """
    term = phrases.select("phrase_id", F.size("terms").alias("n"), F.posexplode("terms").alias("at", "term"))
    ranked = (term.join(counts.withColumnRenamed("n", "count"), "term").groupBy("phrase_id", "n")
              .agg(F.sort_array(F.collect_list(F.struct("count", "at", "term"))).alias("ranked")))
    first, second = F.col("ranked")[0], F.get("ranked", F.lit(1))
    return ranked.filter(F.size("ranked") == F.col("n")).select(
        "phrase_id", "n", first["term"].alias("first"), first["at"].alias("first_at"),
        second["term"].alias("second"), second["at"].alias("second_at"))


def intersected(index: DataFrame, rarest: DataFrame) -> DataFrame:
    """(doc_id, start, phrase_id) where the lists of the two rarest terms agree after adjusting their offsets."""
    first = index.join(rarest.withColumnRenamed("first", "term"), "term").select(
        "doc_id", (F.col("pos") - F.col("first_at")).alias("start"), "phrase_id", "n", "second", "second_at")
    first = first.filter("start >= 0")
    second = index.select("doc_id", F.col("term").alias("second"), F.col("pos").alias("second_pos"))
    both = first.filter("n > 1").withColumn("second_pos", F.col("start") + F.col("second_at")).join(
        second, ["doc_id", "second", "second_pos"], "left_semi")
    return both.select("doc_id", "start", "phrase_id").unionByName(
        first.filter("n = 1").select("doc_id", "start", "phrase_id"))


def phrase_matches(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """(doc_id, hits): where *phrases* (phrase_id, terms) occur in *docs* (doc_id, text), exactly.

    hits is an array of (start, n, phrase_id), one array per document with a match. Counts of the phrases' terms
    choose the two rarest of each; only their postings are indexed and intersected; what is left is compared
    word by word with the documents concerned. An id stands for one row.
    """
    terms = stored(phrases.select(F.explode("terms").alias("term")).distinct())
    rarest = stored(rarest_terms(phrases, stored(term_counts(docs, terms))))
    needed = stored(rarest.select(F.explode(F.array("first", "second")).alias("term")).filter("term IS NOT NULL")
                    .distinct())
    places = stored(intersected(build_index(docs, needed), rarest))
    text = phrases.select("phrase_id", F.size("terms").alias("n"), F.array_join("terms", " ").alias("phrase"))
    wanted = (places.join(text, "phrase_id")
              .groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "phrase_id", "phrase")).alias("wanted")))
    concerned = docs.join(sized(stored(places.select("doc_id").distinct())), "doc_id", "left_semi").select(
        "doc_id", words(F.col("text")).alias("words"))
    hits = F.filter("wanted", lambda w: F.array_join(F.slice("words", w["start"] + 1, w["n"]), " ") == w["phrase"])
    return (concerned.join(wanted, "doc_id").select("doc_id", F.transform(hits, lambda w: F.struct(
        w["start"].alias("start"), w["n"].alias("n"), w["phrase_id"].alias("phrase_id"))).alias("hits"))
        .filter(F.size("hits") > 0))


def proximity_matches(index: DataFrame, queries: DataFrame, slop: int) -> DataFrame:
    """(query_id, doc_id, pos): places of a query's rarest term with all its other terms within *slop* words.

    *queries* has (query_id, terms); repeated terms count once; a query with an absent term has no match. Lists
    meet by document and stretch of *slop* + 1 positions, a posting in its own and both adjoining stretches.
    """
    term = queries.select("query_id", F.explode(F.array_distinct("terms")).alias("term"))
    counts = index.groupBy("term").agg(F.count("*").alias("count"))
    ranked = term.join(counts, "term", "left").groupBy("query_id").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)), "term")).alias("rarest"), F.count("*").alias("n"))
    listed = term.join(index, "term").select("query_id", "term", "doc_id", "pos",
                                             F.expr(f"pos DIV {slop + 1}").alias("stretch"))
    start = listed.join(ranked, "query_id").filter(F.col("term") == F.col("rarest.term")).select(
        "query_id", "doc_id", F.col("pos").alias("at"), "n",
        F.explode(F.array(*(F.col("stretch") + k for k in (-1, 0, 1)))).alias("stretch"))
    near = start.join(listed, ["query_id", "doc_id", "stretch"]).filter(F.abs(F.col("pos") - F.col("at")) <= slop)
    return (near.groupBy("query_id", "doc_id", "at", "n").agg(F.count_distinct("term").alias("found"))
            .filter("found = n").select("query_id", "doc_id", F.col("at").alias("pos")))


def windows(items: DataFrame) -> DataFrame:
    """(item_id, terms): the windows of WINDOW words of items (item_id, text); shorter items are one window."""
    listed = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(1)))
    return listed.select("item_id", "w", F.explode(starts).alias("s")).select(
        "item_id", F.slice("w", F.col("s"), F.least(F.size("w"), F.lit(WINDOW))).alias("terms"))


def covered(hits: Column) -> Column:
    """Number of positions inside of any of the (start, n)."""
    spans = F.sort_array(F.transform(hits, lambda h: F.struct(h["start"].alias("start"),
                                                             (h["start"] + h["n"]).alias("end"))))
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end"))
    return F.aggregate(spans, zero, lambda acc, s: F.struct(
        (acc["hit"] + F.greatest(s["end"] - F.greatest(s["start"], acc["end"]), F.lit(0))).alias("hit"),
        F.greatest(acc["end"], s["end"]).alias("end")), lambda acc: acc["hit"])


def item_matches(rows: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, hits) of stored *rows* (row, text) with a window of *items* (item_id, text), and (phrase_id, item_id).

    Equal windows of different items are searched for once.
    """
    owned = stored(windows(items).distinct())
    phrases = stored(owned.select("terms").distinct().select(F.monotonically_increasing_id().alias("phrase_id"), "terms"))
    found = phrase_matches(rows.select(F.col("row").alias("doc_id"), "text"), phrases)
    return (stored(found.select(F.col("doc_id").alias("row"), "hits")),
            owned.join(phrases, "terms").select("phrase_id", "item_id"))


def benchmark_items(benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    return benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per input row.

    Rows are numbered as they are stored, and each is judged by its own text, whether its id is null, shared or
    neither. Null and empty texts have no words. An item without an id hits words but is not counted. Other
    columns are ignored.
    """
    rows = numbered(docs, id_col, text_col)
    found, owners = item_matches(rows, benchmark_items(benchmark, item_col, item_text_col))
    which = (found.select("row", F.explode(F.array_distinct(F.transform("hits", lambda h: h["phrase_id"])))
                          .alias("phrase_id"))
             .join(owners, "phrase_id").filter("item_id IS NOT NULL").groupBy("row")
             .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    none = F.array().cast("array<string>")
    result = found.select("row", covered(F.col("hits")).alias("n_hit")).join(which, "row", "left").select(
        "row", "n_hit", F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"))
    return (rows.select("row", "doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
            .join(sized(stored(result)), "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.array_join(none, ",").cast("binary"), 256)).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                         item_text_col: str = "text") -> DataFrame:
    """The rows of *docs*, with all their columns, that have no window of a benchmark item, whatever their ids."""
    rows = with_row(docs)
    found, _ = item_matches(rows.select("row", F.col("all")[text_col].alias("text")),
                            benchmark_items(benchmark, item_col, item_text_col))
    return rows.join(sized(stored(found.select("row"))), "row", "left_anti").select("all.*")
