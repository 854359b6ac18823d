"""Keywords, key phrases and category scores of articles.

Per-article text work is a column expression: it runs where the article is and
shuffles nothing. Only ids and vectors move when articles meet categories.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelweave.functions.similarity import blend, cosine_pairs, one_to_many
from labelweave.functions.text import (
    ANY_SPACE, LEVEL_SEPARATOR, blanks, let, normalize_text, pin, sheet_key, strip, words)
from labelweave.operators.blocks import BLOCK_ROWS, PAIR_SLICE, Side, block_join, parts_of_groups
from labelweave.operators.cells import _expanded
from labelweave.operators.embed import Encoder, embed_blend
from labelweave.operators.keyed import top_n_per_group
from labelweave.operators.records import plain_name
from labelweave.session import cut_lineage

# Extraction sizes, blend and score weights, sampling sizes.
KEYWORDS = 15
PHRASES = 5
PHRASE_WORDS = 10
MIN_SENTENCE = 11
SENTENCE_ENDS = ".!?"
BLEND = (0.4, 0.3, 0.3)
SCORE_WEIGHTS = (0.15, 0.65, 0.2)
SIZE_WEIGHT = 0.1
SIZE_FULL = 1000
THEME_SAMPLE = 50
TYPE_SAMPLE = 15
TYPE_COLUMNS = 2
TYPE_FALLBACK = 30
MIN_ENTRY = 6
TOP_ENTRIES = 3
PREVIEW = 500
_SLACK = 1e-4  # of similarities of single precision
SKIPPED_NAMES = ("id", "code", "date", "typedeveille")

# Stop words, as listed (tokens are accent-free, so the accented
# ones never match).
STOP_WORDS = (
    "le la les un une des et ou en de du au aux ce ces cette sur pour par dans que qui avec est "
    "sont ont sera plus leur leurs tous tout toute toutes a à se si son sa ses je tu il elle "
    "nous vous ils elles non oui mais car donc or ni ne pas aucun aucune autre autres même mêmes"
).split()


# --- extraction -------------------------------------------------------------

def add_keywords(df: DataFrame, text: str = "text", n: int = KEYWORDS, out: str = "keywords") -> DataFrame:
    """Add the *n* most frequent content words of each text, first seen first on ties.

    Sorting (word, position) makes repeats adjacent: a word's count is the distance between the places where
    the sorted words change, and its first position stands at the earlier one. Steps are pinned, separate
    projections so that none is evaluated twice; their cost is that of the sort, however often a word repeats.
    """
    stop = [w for w in STOP_WORDS if len(w) > 3]
    plain = normalize_text(F.col(text), "empty")
    tokens = F.filter(words(plain), lambda w: (F.char_length(w) > 3) & ~w.isin(stop))
    placed = F.transform(tokens, lambda w, i: F.struct(w.alias("w"), i.alias("at")))
    step = df.withColumn("_sorted", pin(F.sort_array(placed)))
    last = F.get("_sorted", F.size("_sorted") - 1)
    change = F.filter(F.transform("_sorted", lambda x, i: i), lambda i: (i == 0) | (
        F.get("_sorted", i)["w"] != F.get("_sorted", F.greatest(i - 1, F.lit(0)))["w"]))
    step = step.withColumn("_starts", pin(F.when(last.isNull(), F.array().cast("array<int>")).otherwise(change)))
    runs = F.transform("_starts", lambda at, k: F.struct(
        (at - F.coalesce(F.get("_starts", k + 1), F.size("_sorted"))).alias("neg"),
        F.get("_sorted", at)["at"].alias("at"), F.get("_sorted", at)["w"].alias("w")))
    step = step.withColumn("_ranked", pin(F.slice(F.sort_array(runs), 1, n)))
    return step.withColumn(out, pin(F.transform("_ranked", lambda x: x["w"]))).drop("_sorted", "_starts", "_ranked")


# Sentence ends travel through the normalisation, which leaves control characters and a-z alone, as a
# control character and a letter; the same character in a text is written with another letter meanwhile.
_MARK, _END, _ITSELF = "\u0001", "\u0001e", "\u0001i"


def _marked(col: Column) -> Column:
    col = F.replace(col, F.lit(_MARK), F.lit(_ITSELF))
    for char in SENTENCE_ENDS:
        col = F.replace(col, F.lit(char), F.lit(_END))
    return col


def _unmarked(sentence: Column) -> Column:
    return F.replace(sentence, F.lit(_ITSELF), F.lit(_MARK))


def add_key_phrases(df: DataFrame, text: str = "text", keywords: str = "keywords", n: int = PHRASES,
                    max_words: int = PHRASE_WORDS, out: str = "key_phrases") -> DataFrame:
    """Add the *n* sentences densest in keywords, cut to *max_words* words.

    The text is normalised once; its sentences stay aligned with the raw ones.
    """
    raw = _marked(F.coalesce(F.col(text), F.lit("")))
    density = F.transform(F.split(blanks(normalize_text(raw)), _END), lambda s: let(
        F.array_remove(F.split(_unmarked(s), " "), ""),
        lambda t: -F.size(F.array_intersect(F.col(keywords), t)) / (F.size(t) + 1)))
    step = df.withColumn("_density", pin(density)).withColumn("_sentences", F.transform(F.split(raw, _END), lambda s: strip(_unmarked(s))))
    paired = F.zip_with("_density", "_sentences", lambda d, s: F.struct(d.alias("d"), s.alias("s")))
    ranked = F.filter(F.transform(paired, lambda x, i: F.struct(x["d"].alias("d"), i.alias("i"), x["s"].alias("s"))),
                      lambda x: F.char_length(x["s"]) >= MIN_SENTENCE)

    def cut(s):
        return F.when(F.size(words(s, ANY_SPACE)) > max_words, F.concat(
            F.array_join(F.slice(words(s, ANY_SPACE), 1, max_words), " "), F.lit("..."))).otherwise(s)
    return step.withColumn(out, pin(F.transform(F.slice(F.sort_array(ranked), 1, n), lambda x: cut(x["s"])))).drop(
        "_density", "_sentences")


def extract_keywords(articles: DataFrame, n: int = KEYWORDS) -> DataFrame:
    return add_keywords(articles.select("article_id", "text"), n=n).select("article_id", "keywords")


def extract_key_phrases(articles: DataFrame, n: int = PHRASES, max_words: int = PHRASE_WORDS) -> DataFrame:
    found = add_keywords(articles.select("article_id", "text"))
    return add_key_phrases(found, n=n, max_words=max_words).select("article_id", "key_phrases")


def describe_articles(articles: DataFrame, encoder: str | Encoder = "trigrams") -> DataFrame:
    """article_id, preview, keywords, key_phrases and the blended vector. Narrow.

    An empty or null text has no keywords, phrases or vector; its row stays.
    """
    found = add_key_phrases(add_keywords(articles))
    parts = (F.col("text"), F.array_join("keywords", " "), F.array_join("key_phrases", " "))
    return found.select("article_id", preview("text").alias("article_text"), "keywords", "key_phrases",
                        F.when(F.coalesce("text", F.lit("")) != "", embed_blend(list(zip(BLEND, parts)), encoder))
                        .alias("embedding"))


def composite_embedding(full: Column | str, by_keywords: Column | str, by_phrases: Column | str) -> Column:
    """Weighted sum of three stored vectors."""
    cols = [F.col(c) if isinstance(c, str) else c for c in (full, by_keywords, by_phrases)]
    return blend(list(zip(BLEND, cols)))


def preview(text: Column | str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.when(F.char_length(c) > PREVIEW, F.concat(F.substring(c, 1, PREVIEW), F.lit("..."))).otherwise(c)


# --- category samples -------------------------------------------------------

def sample_head(df: DataFrame, keys: list[str], order: list, n: int, rank_col: str = "rank") -> DataFrame:
    """First *n* stored rows per key."""
    return top_n_per_group(df, keys, order, n, rank_col)


def theme_entries(themed: DataFrame, n: int = THEME_SAMPLE) -> DataFrame:
    """(category, name, ord, entry): the first *n* labels of each theme in label order; -1 takes all.

    Themes are told apart by their whole name.
    """
    rows = themed.select(F.col("theme").alias("category"), "label", "label_id")
    n = 2 ** 31 - 1 if n < 0 else n
    head = sample_head(rows, ["category"], [F.col("label"), F.col("label_id")], n)
    return head.select("category", F.col("category").alias("name"), (F.col("rank") - 1).alias("ord"),
                       F.col("label").alias("entry"))


def every_entry(themed: DataFrame) -> DataFrame:
    """(category, name, ord, entry, label_id): all labels of each theme, with a number that grows in the order of
    :func:`theme_entries`. Labels are numbered where a sort by ranges lays them, so no theme meets in one task."""
    order = ["label", "label_id"]
    laid = themed.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(laid.select(F.col("theme").alias("category"), F.col("theme").alias("name"),
                                   F.monotonically_increasing_id().alias("ord"), F.col("label").alias("entry"), "label_id"))


def text_columns(columns: list[str]) -> list[str]:
    """Columns whose names do not look like ids or metadata."""
    return [c for c in columns if not any(skip in plain_name(c) for skip in SKIPPED_NAMES)]


def type_entries(sheets: DataFrame, columns: list[str], order: list, category: str = "type",
                 sample: int = TYPE_SAMPLE, text_limit: int = TYPE_COLUMNS, fallback_sample: int = TYPE_FALLBACK) -> DataFrame:
    """(category, ord, entry): sampled cells of the text columns of each type sheet.

    A column counts as text for a type when the type's first value is long
    enough. The first *text_limit* text columns give up to *sample* values each; a type
    without any gives up to *fallback_sample* of its second column.
    """
    usable = text_columns(columns)
    head = sample_head(sheets.select(category, *columns, *[o for o in order if isinstance(o, str) and o not in columns]),
                       [category], order, max(sample, fallback_sample))
    cells = F.array(*[F.col(c).cast("string") for c in usable]) if usable else F.array().cast("array<string>")
    is_text = F.filter(F.transform(cells, lambda v, i: F.struct(i.alias("i"), v.alias("v"))),
                       lambda x: F.char_length(x["v"]) >= MIN_ENTRY)
    picked = F.slice(F.transform(is_text, lambda x: x["i"]), 1, text_limit)
    # a bounded number of rows per type is left here
    first = F.first("_picked").over(Window.partitionBy(category).orderBy("rank"))
    known = head.withColumn("_cells", cells).withColumn("_picked", picked).withColumn("_use", first)
    fallback = F.col(columns[1]).cast("string") if len(columns) > 1 else F.lit(None).cast("string")
    chosen = F.when(F.size("_use") > 0, F.when(F.col("rank") <= sample, F.transform(
        "_use", lambda i, n: F.struct((n * max(1000, sample) + F.col("rank")).alias("ord"), F.get("_cells", i).alias("entry"))
    ))).otherwise(F.when(F.col("rank") <= fallback_sample, F.array(
        F.struct(F.col("rank").alias("ord"), fallback.alias("entry")))))
    out = known.select(F.col(category).alias("category"), F.explode(chosen).alias("e"))
    return out.select("category", F.col("e.ord").alias("ord"), F.col("e.entry").alias("entry")).where(
        F.char_length("entry") >= MIN_ENTRY)


def type_lookup(sheets: DataFrame, summary: DataFrame, sheet: str = "sheet", order: str | None = None) -> DataFrame:
    """(sheet, veille_type, count): the first summary type whose name contains the sheet name.

    The summary's order is that of :func:`type_summary`: largest first, then by *order* (default: its column
    ``first_row`` if there is one, else the name). Containment is met by equality on the substrings of the type
    name that are as long as some sheet name, so no nested loop is needed.
    """
    order = order or ("first_row" if "first_row" in summary.columns else "Type")
    names = sheets.select(sheet).distinct()
    lengths = [r[0] for r in names.select(F.char_length(sheet).alias("n")).where("n > 0").distinct().orderBy("n").collect()]
    length = F.char_length("Type")
    at = F.sequence(F.lit(1), F.greatest(length, F.lit(1)))

    def cut(n: int) -> Column:
        starts = F.filter(at, lambda p: p + (n - 1) <= length)
        return F.transform(starts, lambda p: F.substr(F.col("Type"), p, F.lit(n)))
    parts = F.array_distinct(F.flatten(F.array(*(cut(n) for n in lengths))))
    rank = F.struct(-F.col("Count"), F.col(order))
    if not lengths:
        parts = F.array().cast("array<string>")
    best = summary.select("Type", "Count", rank.alias("_rank"), F.explode(parts).alias("_part")).groupBy("_part").agg(
        F.min_by(F.struct("Type", "Count"), "_rank").alias("_hit"))
    return names.join(best, F.col(sheet) == F.col("_part"), "left").select(
        F.col(sheet), F.coalesce("_hit.Type", sheet).alias("veille_type"),
        F.coalesce("_hit.Count", F.lit(0)).alias("count"))


# --- similarity and scores --------------------------------------------------

def similarity_stats(articles: DataFrame, entries: DataFrame) -> DataFrame:
    """Mean, maximum and the best entries per (article, category)."""
    bare = articles.select("article_id", "embedding", F.array().cast("array<string>").alias("keywords"))
    return article_entry_similarity(bare, entries, lexical=False)


class _Kinds:
    """The entries of a part of a category by their vectors: equal ones are compared once and count as often as there are.

    Single precision tells which can be among the best; those are scored as the stored vectors have it. The sum of all
    similarities is one product with the sum of the unit vectors.
    """

    def __init__(self, right: Side, rows: np.ndarray):
        raw = np.ascontiguousarray(right.raw[rows])
        _, first, kind, self.n = np.unique(raw.view(np.dtype((np.void, raw.dtype.itemsize * raw.shape[1]))).ravel(),
                                           return_index=True, return_inverse=True, return_counts=True)
        self.at = np.argsort(kind, kind="stable")  # positions, kind by kind
        self.start = np.cumsum(self.n) - self.n
        self.raw, self.square = raw[first], right.square[rows][first]
        self.near = np.nan_to_num(right.unit[rows][first]).astype(np.float32)
        weight = np.divide(self.n, np.sqrt(self.square), out=np.zeros(len(first)), where=self.square > 0)
        self.sum = weight @ self.raw.astype(np.float64)
        self.shown = min(TOP_ENTRIES, len(rows))

    def best(self, left: Side, near: np.ndarray, rows: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions and similarities of the best entries of some left rows, level ones in their order, and the maximum."""
        rough = near[rows] @ self.near.T
        k = rough.shape[1] - min(TOP_ENTRIES, rough.shape[1])
        i, j = np.nonzero(rough >= np.partition(rough, k, axis=1)[:, k, None] - _SLACK)
        at = i + rows.start
        cos = np.concatenate([cosine_pairs(left.raw[at[s:s + PAIR_SLICE]], left.square[at[s:s + PAIR_SLICE]],
                                           self.raw[j[s:s + PAIR_SLICE]], self.square[j[s:s + PAIR_SLICE]])
                              for s in range(0, len(at), PAIR_SLICE)])
        most = np.maximum.reduceat(cos, np.searchsorted(i, np.arange(len(rough))))
        pair, step = _expanded(np.minimum(self.n[j], TOP_ENTRIES))
        position, i, cos = self.at[self.start[j[pair]] + step], i[pair], cos[pair]
        order = np.lexsort((position, -np.round(cos, 12), i))
        ranked = order[np.arange(len(order)) - np.searchsorted(i, i[order]) < self.shown]
        return position[ranked].reshape(-1, self.shown), cos[ranked], most


_PARTIAL = ("article_id bigint, grp string, category string, total double, n bigint, max_similarity double, "
            "scores array<double>, ords array<bigint>, entries array<string>, shown array<string>")


def article_entry_similarity(articles: DataFrame, entries: DataFrame, lexical: bool = True,
                             block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean, maximum and the best entries per (article, category), and the lexical similarity of the
    article's keywords to the category name, reduced where the product is made.

    One row per article and part of a category leaves a task: sum, count, maximum and the best entries with their
    positions. A category of more than ``block_rows`` entries has several parts, which are merged; without such a category
    nothing is shuffled again. Equal similarities show the lowest position first. Articles without a vector have no row.
    """
    def score(left: Side, right: Side, diagonal: bool):
        order = np.lexsort((right.ids, right.group))
        group, entry, ids = right.group[order], right.text[order], right.ids[order]
        edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
        names = [json.loads(group[a]) for a in edge[:-1]]
        kinds = [_Kinds(right, order[a:b]) for a, b in zip(edge[:-1], edge[1:])]
        near, length = np.nan_to_num(left.unit).astype(np.float32), np.sqrt(left.square)
        for rows in left.chunks(right):
            texts, which = np.unique(left.text[rows].astype(str), return_inverse=True)
            for (category, name), a, b, kind in zip(names, edge[:-1], edge[1:], kinds):
                top, best, most = kind.best(left, near, rows)
                n, at = len(top), a + top.ravel()
                total = np.divide(left.raw[rows].astype(np.float64) @ kind.sum, length[rows], out=np.zeros(n), where=length[rows] > 0)
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * top.shape[1])
                out = {
                    "article_id": left.ids[rows], "grp": pa.array([group[a]] * n), "category": pa.array([category] * n, pa.string()),
                    "total": total, "n": np.full(n, b - a), "max_similarity": most,
                    "scores": pa.ListArray.from_arrays(ends, pa.array(np.round(best, 12))),
                    "ords": pa.ListArray.from_arrays(ends, pa.array(ids[at], pa.int64())),
                    "entries": pa.ListArray.from_arrays(ends, pa.array(entry[at], pa.string())),
                    "shown": pa.ListArray.from_arrays(ends, pa.array([f"{s:.3f}" for s in best], pa.string()))}
                if lexical:
                    out["keyword_similarity"] = one_to_many(name or "", texts)[which]
                yield out
    lhs = articles.where(F.col("embedding").isNotNull()).select(
        F.col("article_id").alias("id"), F.array_join("keywords", " ").alias("text"), F.col("embedding").alias("vec"))
    key = F.to_json(F.array(F.col("category"), normalize_text("name")), {"ignoreNullFields": "false"})
    rhs, parts = parts_of_groups(entries.select(F.col("ord").alias("id"), F.col("entry").alias("text"),
                                                F.col("embedding").alias("vec"), key.alias("grp")), block_rows)
    found = block_join(lhs, rhs, score, _PARTIAL + (", keyword_similarity double" if lexical else ""),
                       block_rows=block_rows, whole_groups=True)
    best = {"entries": F.col("entries"), "shown": F.col("shown")}
    if parts > 1:
        ranked = F.transform(
            F.arrays_zip("scores", "ords", "entries", "shown"),
            lambda e: F.struct((-e["scores"]).alias("below"), e["ords"].alias("ord"), e["entries"].alias("entries"), e["shown"].alias("shown")))
        # as many partials as a category has parts, of TOP_ENTRIES entries each
        first = F.slice(F.array_sort(F.flatten(F.collect_list(ranked))), 1, TOP_ENTRIES)
        found = found.groupBy("article_id", "grp").agg(
            F.first("category").alias("category"), F.sum("total").alias("total"), F.sum("n").alias("n"),
            F.max("max_similarity").alias("max_similarity"), first.alias("best"),
            *([F.first("keyword_similarity").alias("keyword_similarity")] if lexical else []))
        best = F.col("best")
    return found.select(
        "article_id", "category", (F.col("total") / F.col("n")).alias("avg_similarity"), "max_similarity",
        F.array_join(best["entries"], ", ").alias("top_entries"), F.array_join(best["shown"], ", ").alias("top_scores"),
        *(["keyword_similarity"] if lexical else []))


def combined_score(avg: Column | str, top: Column | str, kw: Column | str,
                   size: Column | str | None = None) -> Column:
    """Weighted category score; types add a little for their size."""
    avg, top, kw = (F.col(c) if isinstance(c, str) else c for c in (avg, top, kw))
    a, m, k = SCORE_WEIGHTS
    score = F.lit(a) * avg + F.lit(m) * top + F.lit(k) * kw
    if size is None:
        return score
    size = F.col(size) if isinstance(size, str) else size
    return score + F.least(F.lit(1.0), size / F.lit(float(SIZE_FULL))) * F.lit(SIZE_WEIGHT)


def best_category(scores: DataFrame, name: str, out: str, score_out: str) -> DataFrame:
    """Best scored category per article; equal scores go to the first name."""
    best = F.min_by(F.struct(F.col(name).alias("n"), F.col("score").alias("s")),
                    F.struct(-F.round("score", 12), F.col(name)))
    return scores.groupBy("article_id").agg(best.alias("b")).select(
        "article_id", F.col("b.n").alias(out), F.col("b.s").alias(score_out))


def article_result(described: DataFrame, theme_scores: DataFrame, type_scores: DataFrame) -> DataFrame:
    """One report row per article with its best theme and type."""
    return (described.select("article_id", "article_text", F.array_join("keywords", ", ").alias("keywords"),
                             F.array_join("key_phrases", LEVEL_SEPARATOR).alias("key_phrases"))
            .join(best_category(theme_scores, "theme", "best_theme", "theme_score"), "article_id", "left")
            .join(best_category(type_scores, "veille_type", "best_veille_type", "veille_score"),
                  "article_id", "left"))
