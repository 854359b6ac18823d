"""Text and label operators, exact duplicates, merges and their reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelweave.functions.similarity import cosine, jaro_winkler, l2_normalize
from labelweave.functions.text import char_overlap, hierarchy_label, normalize_table, normalize_text
from labelweave.operators.embed import embed_text
from labelweave.operators.keyed import cap_rows
from labelweave.operators import matching as m
from labelweave.operators.matching import match_key
from labelweave.operators.ids import dense_row_ids
from labelweave.plans.alignment import align
from labelweave.session import table
from labelweave.sources.readers import union_sources
from queries.common import (
    COS, COS_MIN, JW_MIN, LABEL_SQL, NEIGHBOURS_SQL, PAIRS_SQL, TITLE_SQL, V_SQL, distinct_labels, documents, neighbours, norm, query,
    r6, stored_vectors, taxonomy, titles, trigram_sql, vectors)


@query("normalize_text", f"SELECT doc_id, {norm('text')} AS norm FROM documents")
def _(spark, d):
    return documents(spark, d).select(F.col("row_id").alias("doc_id"), normalize_text("label").alias("norm"))


@query("normalize_table", f"SELECT page_id, {norm('url')} AS url, {norm('html')} AS html FROM pages")
def _(spark, d):
    return normalize_table(table(spark, d, "pages"))


_LEVELS = "[p_type, CASE WHEN p_size > 30 THEN '  ' WHEN p_size < 10 THEN NULL ELSE p_brand END, p_name]"


@query("hierarchy_label", f"""
WITH l AS (SELECT p_partkey AS row_id, {_LEVELS} AS levels FROM part)
SELECT row_id, array_to_string([x FOR x IN levels IF trim(x) <> ''], ' | ') AS joined,
       array_to_string([coalesce(x, 'nan') FOR x IN levels], ' | ') AS joined_all, levels[1] AS first FROM l""")
def _(spark, d):
    brand = F.when(F.col("p_size") > 30, "  ").when(F.col("p_size") < 10, F.lit(None)).otherwise(F.col("p_brand"))
    df = table(spark, d, "part").select(F.col("p_partkey").alias("row_id"), F.array(
        F.col("p_type"), brand, F.col("p_name")).alias("levels"))
    return df.select("row_id", *[hierarchy_label("levels", x).alias(x) for x in ("joined", "joined_all", "first")])


@query("filter_labels", f"""SELECT p_partkey AS row_id, {LABEL_SQL} AS label FROM part
WHERE regexp_matches({LABEL_SQL}, 'promo.*(ring|BOLT)$', 'i')""")
def _(spark, d):
    return m.filter_labels(taxonomy(spark, d).select("row_id", "label"), "promo.*(ring|BOLT)$")


@query("cap_rows", f"SELECT p_partkey AS row_id, {LABEL_SQL} AS label FROM part WHERE p_partkey < 100")
def _(spark, d):
    return cap_rows(taxonomy(spark, d).select("row_id", "label"), 100)


@query("union_sources", """
SELECT 0 AS source_ord, p_type AS level_0, p_brand AS level_1, p_name AS level_2 FROM part
UNION ALL SELECT 1, r_name, n_name, NULL FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 2, s_name, NULL, NULL FROM supplier""")
def _(spark, d):
    part = table(spark, d, "part").select(F.lit(0).alias("source_ord"), F.col("p_type").alias("level_0"),
                                          F.col("p_brand").alias("level_1"), F.col("p_name").alias("level_2"))
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.expr("n_regionkey = r_regionkey")).select(
        F.lit(1).alias("source_ord"), F.col("r_name").alias("level_0"), F.col("n_name").alias("level_1"))
    makers = table(spark, d, "supplier").select(F.lit(2).alias("source_ord"), F.col("s_name").alias("level_0"))
    return union_sources([part, places, makers])


@query("dense_row_ids", """
SELECT p_partkey, row_number() OVER (ORDER BY p_type, p_partkey) - 1 AS row_id FROM part""")
def _(spark, d):
    # a partitioned, locally sorted layout stands in for files read in order
    laid = table(spark, d, "part").repartition("p_type").sortWithinPartitions("p_type", "p_partkey")
    return dense_row_ids(laid, ["p_type"]).select("p_partkey", "row_id")


@query("jaro_winkler", f"""WITH {NEIGHBOURS_SQL}
SELECT kind, a, round(jaro_winkler_similarity(s1, s2), 6) AS jw FROM near""")
def _(spark, d):
    return neighbours(spark, d).select("kind", "a", r6(jaro_winkler("s1", "s2"), "jw"))


@query("char_overlap", f"""WITH {NEIGHBOURS_SQL}, sets AS (
SELECT kind, a, list_distinct(string_split(s1, '')) AS x, list_distinct(string_split(s2, '')) AS y FROM near)
SELECT kind, a, round(len(list_intersect(x, y)) / greatest(len(list_distinct(list_concat(x, y))), 1), 6) AS overlap
FROM sets""")
def _(spark, d):
    return neighbours(spark, d).select("kind", "a", r6(char_overlap("s1", "s2"), "overlap"))


@query("cosine", f"""SELECT x.vec_id, round({COS.format(a='x.embedding', b='y.embedding')}, 6) AS cos
FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1""")
def _(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", r6(cosine("embedding", "other"), "cos"))


@query("l2_normalize", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_sum([x * x FOR x IN embedding::DOUBLE[]])) AS n FROM embeddings)
SELECT vec_id, unnest(range(len(v)))::INTEGER AS pos, round(unnest(v) * 3.0 / greatest(n * 3.0, 1e-12), 6) AS value FROM e""")
def _(spark, d):
    scaled = F.transform("embedding", lambda x: x.cast("double") * 3.0)
    unit = table(spark, d, "embeddings").select("vec_id", F.posexplode(l2_normalize(scaled)).alias("pos", "x"))
    return unit.select("vec_id", "pos", r6("x", "value"))


@query("embed_text", f"""WITH {trigram_sql('t', 'documents', 'doc_id', 'text')}
SELECT id AS row_id, unnest(range(64))::INTEGER AS pos, round(unnest(vec), 5) AS value FROM t""")
def _(spark, d):
    e = embed_text(documents(spark, d), "label").select("row_id", F.posexplode("embedding").alias("pos", "x"))
    return e.select("row_id", "pos", F.round(F.col("x").cast("double"), 5).alias("value"))


# --- exact duplicates over whole documents ---------------------------------

_DOCS = f"""d AS (SELECT doc_id AS row_id, text, {norm('text')} AS k FROM documents),
w AS (SELECT *, min(row_id) OVER (PARTITION BY k) AS first_id FROM d),
p AS (SELECT row_id AS source_id, first_id AS target_id FROM w WHERE row_id > first_id)"""


@query("exact_duplicates", f"WITH {_DOCS} SELECT source_id, target_id FROM p")
def _(spark, d):
    return m.exact_duplicates(documents(spark, d), with_key=False)


@query("first_occurrence", f"WITH {_DOCS} SELECT row_id, text FROM w WHERE row_id = first_id")
def _(spark, d):
    keyed = documents(spark, d).withColumn("k", match_key(normalize_text("label")))
    return m.first_occurrence(keyed, "k").select("row_id", F.col("label").alias("text"))


@query("first_value_per_key", "SELECT source, min(doc_id) AS first_id, arg_min(lang, doc_id) AS first_lang "
                              "FROM documents GROUP BY source")
def _(spark, d):
    docs = table(spark, d, "documents").select("source", "doc_id", "lang")
    first = m.first_occurrence(docs, "source", "doc_id")
    return first.select("source", F.col("doc_id").alias("first_id"), F.col("lang").alias("first_lang"))


@query("merge_metrics", f"""WITH {_DOCS},
a AS (SELECT count(*) AS original FROM documents), b AS (SELECT count(*) AS pairs, count(DISTINCT source_id) AS u FROM p)
SELECT original, pairs, u AS unique_sources, original - u AS aligned, u AS reduction,
       round(u * 100.0 / original, 6) AS reduction_pct FROM a, b""")
def _(spark, d):
    docs = documents(spark, d)
    out = m.merge_metrics(docs, m.exact_duplicates(docs, with_key=False))
    return out.withColumn("reduction_pct", F.round("reduction_pct", 6))


@query("export_aligned", f"WITH {_DOCS} SELECT row_id, text FROM d WHERE row_id NOT IN (SELECT source_id FROM p)")
def _(spark, d):
    docs = documents(spark, d)
    return m.export_aligned(docs, m.exact_duplicates(docs, with_key=False)).select("row_id", F.col("label").alias("text"))


# --- similar labels with the provided vectors ------------------------------

def pairs_of(spark, d):
    v = stored_vectors(spark, d)
    return m.union_rules(m.exact_duplicates(v), m.similar_classes(v, cos_min=COS_MIN, jw_min=JW_MIN))


@query("similar_pairs", f"""WITH {PAIRS_SQL}
SELECT source_id, target_id, round(jw, 6) AS jw, round(cos, 6) AS cos FROM sim""")
def _(spark, d):
    out = m.similar_classes(stored_vectors(spark, d), cos_min=COS_MIN, jw_min=JW_MIN)
    return out.select("source_id", "target_id", r6("jw"), r6("cos"))


@query("similar_pairs_topk", f"""WITH {V_SQL},
near AS (SELECT a.row_id AS a, b.row_id AS b, a.label AS la, b.label AS lb, {COS.format(a='a.embedding', b='b.embedding')} AS cos
         FROM v a JOIN v b ON a.row_id <> b.row_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(cos, 12) DESC, b) AS r FROM near WHERE cos >= {COS_MIN}),
top AS (SELECT *, jaro_winkler_similarity(la, lb) AS jw FROM ranked WHERE r <= 7 AND b > a)
SELECT b AS source_id, a AS target_id, round(jw, 6) AS jw, round(cos, 6) AS cos FROM top WHERE jw >= {JW_MIN}""")
def _(spark, d):
    out = m.similar_pairs_topk(stored_vectors(spark, d), k=8, cos_min=COS_MIN, jw_min=JW_MIN)
    return out.select("source_id", "target_id", r6("jw"), r6("cos"))


@query("union_rules", f"""WITH {PAIRS_SQL}
SELECT source_id, target_id, rule, norm_key, round(jw, 6) AS jw, round(cos, 6) AS cos FROM pairs""")
def _(spark, d):
    return pairs_of(spark, d).withColumn("jw", F.round("jw", 6)).withColumn("cos", F.round("cos", 6))


@query("sort_pairs", f"WITH {PAIRS_SQL} SELECT source_id, target_id, rule FROM pairs ORDER BY target_id, source_id")
def _(spark, d):
    return m.sort_pairs(pairs_of(spark, d).select("source_id", "target_id", "rule"))


@query("rule_metrics", f"""WITH {PAIRS_SQL}
SELECT rule, count(*) AS pairs, (SELECT count(*) FROM pairs) AS total,
       round((SELECT count(*) FROM pairs) * 100.0 / (SELECT count(*) FROM v), 6) AS pct_of_labels
FROM pairs GROUP BY rule""")
def _(spark, d):
    out = m.rule_metrics(pairs_of(spark, d), vectors(spark, d))
    return out.withColumn("pct_of_labels", F.round("pct_of_labels", 6))


@query("merge_audit", f"""WITH {PAIRS_SQL}
SELECT rule, source_id, target_id,
       'rule=' || rule || ' src=' || source_id || ' tgt=' || target_id || CASE WHEN rule = 'dup-merge-5'
       THEN ' norm=''' || norm_key || '''' ELSE format(' jw={{:.3f}}, cos={{:.3f}}', jw, cos) END AS line FROM pairs""")
def _(spark, d):
    return m.merge_audit(pairs_of(spark, d)).select("rule", "source_id", "target_id", "line")


@query("label_pairs", f"""WITH {PAIRS_SQL}
SELECT source_id, target_id, s.label AS source_label, t.label AS target_label
FROM sim JOIN v s ON s.row_id = source_id JOIN v t ON t.row_id = target_id""")
def _(spark, d):
    v = stored_vectors(spark, d)
    sim = m.similar_classes(v, cos_min=COS_MIN, jw_min=JW_MIN).select("source_id", "target_id")
    return m.label_pairs(sim, v)


@query("compartments", f"""WITH {PAIRS_SQL}, e AS (
SELECT DISTINCT target_id AS c, source_id AS x FROM pairs UNION SELECT DISTINCT target_id, target_id FROM pairs)
SELECT c AS canonical_id, a.label AS canonical_label, x AS member_id, b.label AS member_label
FROM e JOIN v a ON a.row_id = c JOIN v b ON b.row_id = x""")
def _(spark, d):
    return m.compartments(pairs_of(spark, d), vectors(spark, d))


@query("distinct_seeds", f"WITH {PAIRS_SQL} SELECT DISTINCT target_id AS seed_id FROM pairs")
def _(spark, d):
    return m.distinct_seeds(pairs_of(spark, d))


@query("merge_prompts", f"""WITH {PAIRS_SQL}
SELECT source_id, target_id, 'Should ''' || s.label || ''' be merged into ''' || t.label ||
       '''? Answer ''Yes'' or ''No''.' AS prompt
FROM sim JOIN v s ON s.row_id = source_id JOIN v t ON t.row_id = target_id""")
def _(spark, d):
    v = stored_vectors(spark, d)
    return m.merge_prompts(m.similar_classes(v, cos_min=COS_MIN, jw_min=JW_MIN), v)


_YES = "starts_with(lower(ltrim(text, chr(10) || chr(9) || chr(13) || ' ')), 'yes')"


@query("score_responses", f"""SELECT conv_id, turn,
CASE WHEN {_YES} = (role = 'assistant') THEN 1.0 ELSE -1.0 END::DOUBLE AS reward FROM conversations""")
def _(spark, d):
    turns = table(spark, d, "conversations")
    return m.score_responses(turns, "text", F.col("role") == "assistant").select("conv_id", "turn", "reward")


@query("mean_reward", f"""SELECT conv_id,
round(avg(CASE WHEN {_YES} = (role = 'assistant') THEN 1.0 ELSE -1.0 END::DOUBLE), 6) AS mean_reward
FROM conversations GROUP BY conv_id""")
def _(spark, d):
    scored = m.score_responses(table(spark, d, "conversations"), "text", F.col("role") == "assistant")
    return m.mean_reward(scored, "conv_id").select("conv_id", r6("mean_reward"))


# --- the whole alignment, on page titles embedded by the default encoder ----

_TITLE_PAIRS = f"""{trigram_sql('e', 'pages', 'page_id', TITLE_SQL)},
v AS (SELECT page_id AS row_id, {TITLE_SQL} AS label, vec FROM pages JOIN e ON id = page_id),
w AS (SELECT *, min(row_id) OVER (PARTITION BY label) AS first_id FROM v),
reps AS (SELECT * FROM w WHERE row_id = first_id),
p AS (SELECT row_id AS source_id, first_id AS target_id FROM w WHERE row_id > first_id
      UNION ALL SELECT row_id, first_id FROM w WHERE row_id > first_id AND list_max(vec) > 0  -- copies, by similarity
      UNION ALL SELECT b.row_id, a.row_id FROM reps a JOIN reps b ON a.row_id < b.row_id
      WHERE list_cosine_similarity(a.vec, b.vec) >= 0.85 AND jaro_winkler_similarity(a.label, b.label) >= 0.80)"""


def align_titles(spark, d):
    t = titles(spark, d).select("row_id", F.col("title").alias("label"))
    return align(embed_text(t, "label"))


@query("align_pairs", f"WITH {_TITLE_PAIRS} SELECT source_id, target_id FROM p")
def _(spark, d):
    return align_titles(spark, d).pairs.select("source_id", "target_id")


@query("align_metrics", f"""WITH {_TITLE_PAIRS},
a AS (SELECT count(*) AS original FROM v), b AS (SELECT count(*) AS pairs, count(DISTINCT source_id) AS u FROM p)
SELECT original, pairs, u AS unique_sources, original - u AS aligned, u AS reduction,
       round(u * 100.0 / original, 6) AS reduction_pct FROM a, b""")
def _(spark, d):
    return align_titles(spark, d).metrics.withColumn("reduction_pct", F.round("reduction_pct", 6))


@query("align_export", f"WITH {_TITLE_PAIRS} SELECT row_id, label FROM v WHERE row_id NOT IN (SELECT source_id FROM p)")
def _(spark, d):
    return align_titles(spark, d).aligned.select("row_id", "label")


@query("representatives", f"""WITH {V_SQL}
SELECT min(row_id) AS row_id, label, count(*) AS copies FROM v GROUP BY label, embedding""")
def _(spark, d):
    return m.representatives(vectors(spark, d)).select("row_id", "label", "copies")
