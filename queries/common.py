"""Shared inputs: the provided tables seen as taxonomies, records and articles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelweave.functions.text import hierarchy_label, normalize_text
from labelweave.operators.embed import DEFAULT_DIM, TRIGRAM_MODULUS, TRIGRAM_WEIGHTS, embed
from labelweave.operators.matching import representatives
from labelweave.operators.model import MergeModel
from labelweave.session import cut_lineage, spread, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

MODEL = MergeModel(intercept=-6.0, lexical=7.0, cosine=5.0)
COS_MIN, JW_MIN = 0.25, 0.80  # the provided vectors are nearly orthogonal


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


# --- Spark inputs -----------------------------------------------------------

def documents(spark, d) -> DataFrame:
    """(row_id, label): whole document texts."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("label"))
    return spread(docs, "row_id")


def articles(spark, d) -> DataFrame:
    return spread(table(spark, d, "documents").select(F.col("doc_id").alias("article_id"), "text"), "article_id")


def taxonomy(spark, d) -> DataFrame:
    """(row_id, levels, label): part as a three-level taxonomy."""
    levels = F.array("p_type", "p_brand", "p_name")
    return table(spark, d, "part").select(F.col("p_partkey").alias("row_id"), levels.alias("levels"),
                                          hierarchy_label(levels).alias("label"))


def vectors(spark, d) -> DataFrame:
    """(row_id, label, embedding, cluster): all part names with the provided vectors, else those of the default
    encoder, which are as wide, and a cluster by id."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("label"))
    emb = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("row_id"), "embedding", F.col("label").alias("cluster"))
    return part.join(emb, "row_id", "left").select(
        "row_id", "label", F.coalesce("embedding", embed(F.when(F.col("embedding").isNull(), F.col("label")))).alias("embedding"),
        F.coalesce("cluster", (F.col("row_id") % 10).cast("int")).alias("cluster"))


def stored_vectors(spark, d) -> DataFrame:
    """vectors() encoded once, for queries that read them several times."""
    return cut_lineage(vectors(spark, d))


def distinct_labels(spark, d) -> DataFrame:
    """vectors() without copies, as similarity is computed."""
    return representatives(vectors(spark, d))


def titles(spark, d) -> DataFrame:
    """(row_id, title): normalised page titles."""
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    return table(spark, d, "pages").select(F.col("page_id").alias("row_id"), normalize_text(title).alias("title"))


def records(spark, d) -> DataFrame:
    """part as records with a type, a domain and a subdomain."""
    return table(spark, d, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_type").alias("typedeveille"),
                                          F.col("p_brand").alias("DOMAINE"), F.col("p_name").alias("SOUSDOMAINE"))


def neighbours(spark, d) -> DataFrame:
    """Pairs of consecutive texts: taxonomy labels, and turns of a conversation."""
    tax = taxonomy(spark, d).select(F.col("row_id").alias("a"), normalize_text("label").alias("s1"))
    nxt = tax.select((F.col("a") - 1).alias("a"), F.col("s1").alias("s2"))
    turns = table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("a"), normalize_text("text").alias("s1"))
    after = turns.select((F.col("a") - 1).alias("a"), F.col("s1").alias("s2"))
    return tax.join(nxt, "a").select(F.lit("part").alias("kind"), "a", "s1", "s2").unionByName(
        turns.join(after, "a").select(F.lit("turn").alias("kind"), "a", "s1", "s2"))


# --- SQL inputs -------------------------------------------------------------

def norm(x: str) -> str:
    return f"lower(replace(strip_accents({x}), 'ß', 'ss'))"


LABEL_SQL = "concat_ws(' | ', p_type, p_brand, p_name)"
TITLE_SQL = norm("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")
COS = "list_cosine_similarity({a}::DOUBLE[], {b}::DOUBLE[])"
def logit_sql(lex: str, cos: str) -> str:
    return f"({MODEL.intercept} + {MODEL.lexical} * {lex} + {MODEL.cosine} * {cos})"


def probability_sql(lex: str, cos: str) -> str:
    return f"(1.0 / (1.0 + exp(-{logit_sql(lex, cos)})))"


def trigram_sql(name: str, source: str, key: str, text: str) -> str:
    """CTEs ending in *name* (id, vec): the default encoder as SQL."""
    w1, w2, w3 = TRIGRAM_WEIGHTS
    return f"""
{name}_u AS (SELECT {key} AS id, [unicode(x)::BIGINT FOR x IN string_split({text}, '')] AS u FROM {source}),
{name}_g AS (SELECT id, unnest([(u[i] * {w1} + u[i+1] * {w2} + u[i+2] * {w3}) % {TRIGRAM_MODULUS} % {DEFAULT_DIM}
                               FOR i IN range(1, len(u) - 1)]) AS b FROM {name}_u WHERE len(u) > 2),
{name}_c AS (SELECT id, b, count(*) AS n FROM {name}_g GROUP BY id, b),
{name}_n AS (SELECT id, sqrt(sum(n * n)) AS norm FROM {name}_c GROUP BY id),
{name} AS (SELECT k.id, list((coalesce(c.n / x.norm, 0.0))::FLOAT::DOUBLE ORDER BY k.b) AS vec
           FROM (SELECT id, unnest(range({DEFAULT_DIM})) AS b FROM {name}_u) k
           LEFT JOIN {name}_c c ON c.id = k.id AND c.b = k.b LEFT JOIN {name}_n x ON x.id = k.id
           GROUP BY k.id)"""


V_SQL = f"""vn AS (SELECT DISTINCT p_name FROM part), {trigram_sql('vt', 'vn', 'p_name', 'p_name')},
v AS (SELECT p_partkey AS row_id, p_name AS label, coalesce(e.embedding::DOUBLE[], vt.vec) AS embedding,
             coalesce(e.label, (p_partkey % 10)::INTEGER) AS cluster
      FROM part LEFT JOIN embeddings e ON p_partkey = vec_id LEFT JOIN vt ON vt.id = p_name)"""
PAIRS_SQL = V_SQL + f""",
reps AS (SELECT min(row_id) AS row_id, label, embedding FROM v GROUP BY label, embedding),
scored AS (SELECT b.row_id AS source_id, a.row_id AS target_id, jaro_winkler_similarity(a.label, b.label) AS jw,
                  {COS.format(a='a.embedding', b='b.embedding')} AS cos
           FROM reps a JOIN reps b ON a.row_id < b.row_id),
rsim AS (SELECT * FROM scored WHERE cos >= {COS_MIN} AND jw >= {JW_MIN}),
sim AS (SELECT * FROM rsim UNION ALL
        SELECT v.row_id, r.row_id, jaro_winkler_similarity(v.label, r.label), {COS.format(a='v.embedding', b='r.embedding')}
        FROM v JOIN reps r ON v.label = r.label AND v.embedding = r.embedding AND v.row_id > r.row_id),
keyed AS (SELECT row_id AS source_id, {norm('label')} AS norm_key,
                 min(row_id) OVER (PARTITION BY {norm('label')}) AS target_id FROM v),
dup AS (SELECT source_id, target_id, norm_key FROM keyed WHERE source_id > target_id),
pairs AS (SELECT source_id, target_id, 'dup-merge-5' AS rule, norm_key, NULL::DOUBLE AS jw, NULL::DOUBLE AS cos FROM dup
          UNION ALL SELECT source_id, target_id, 'sim-merge-1', NULL, jw, cos FROM sim)"""
NEIGHBOURS_SQL = f"""
tax AS (SELECT p_partkey AS a, {norm(LABEL_SQL)} AS s FROM part),
turns AS (SELECT conv_id * 1000 + turn AS a, {norm('text')} AS s FROM conversations),
near AS (SELECT 'part' AS kind, x.a AS a, x.s AS s1, y.s AS s2 FROM tax x JOIN tax y ON y.a = x.a + 1
         UNION ALL SELECT 'turn', x.a, x.s, y.s FROM turns x JOIN turns y ON y.a = x.a + 1)"""


def r6(col, name: str | None = None):
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, 6).alias(name or (col if isinstance(col, str) else "value"))


def themed_input(spark, d) -> DataFrame:
    """(label_id, label, theme): the given clusters as themes."""
    return vectors(spark, d).select(F.col("row_id").alias("label_id"), "label",
                                    F.concat(F.lit("Theme "), F.col("cluster").cast("string")).alias("theme"))
