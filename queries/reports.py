"""Record, type and theme operators, and the rule catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelweave.functions.text import normalize_text, sheet_key
from labelweave.operators import records as rec
from labelweave.operators import themes as th
from labelweave.operators.keyed import share_of_total
from labelweave.operators.rules import summarize_rules
from labelweave.session import spread, table
from queries.common import V_SQL, norm, query, r6, records, vectors

TERMS = ("red", "#7")
TYPE_ARGS = ("typedeveille", "DOMAINE", "SOUSDOMAINE")

# --- enrichment flags: event properties recast into the shapes cells come in --

_CELL = """CASE event_type
WHEN 'click' THEN '{"isMatch": ' || CASE WHEN value > 20 THEN 'true' ELSE 'false' END || '}'
WHEN 'view' THEN CASE WHEN value > 20 THEN '{"a": 1, "a": NaN, "isMatch": false, "isMatch": ' ELSE '{"isMatch": ' END || (CASE WHEN value < 10 THEN 0 ELSE 1 END) || ', "p": ' || props || '}'
WHEN 'error' THEN 'broken {isMatch : ' || CASE WHEN value > 15 THEN 'TRUE' ELSE 'False' END || ', ' || props
WHEN 'purchase' THEN CASE WHEN value > 30 THEN '{"isMatch": "false"}' WHEN value > 20 THEN '{"isMatch": ""}'
     WHEN value > 10 THEN '[1]' ELSE '{"isMatch": []}' END
ELSE CASE WHEN value > 20 THEN props WHEN value > 10 THEN '{"isMatch": null}' ELSE NULL END END"""
_FLAG = """CASE event_type WHEN 'click' THEN value > 20 WHEN 'view' THEN value >= 10 WHEN 'error' THEN value > 15
WHEN 'purchase' THEN value > 30 ELSE false END"""


def enriched(spark, d):
    return table(spark, d, "events").select(F.col("event_id").alias("row_id"), F.expr(_CELL).alias("enrichment"))


@query("extract_is_match", f"SELECT event_id AS row_id, {_FLAG} AS is_match FROM events")
def _(spark, d):
    return enriched(spark, d).select("row_id", rec.extract_is_match("enrichment").alias("is_match"))


@query("sort_by_match", f"""SELECT event_id AS row_id, {_CELL} AS enrichment, {_FLAG} AS "isMatch" FROM events
ORDER BY "isMatch" DESC, row_id""")
def _(spark, d):
    return rec.sort_by_match(enriched(spark, d))


# --- types ------------------------------------------------------------------

_REC = f"""r AS (SELECT p_partkey AS row_id, coalesce(p_type, 'unknown') AS raw, {norm("coalesce(p_type, 'unknown')")} AS tn,
coalesce(p_brand, '') AS domain, coalesce(p_name, '') AS subdomain,
contains({norm('p_brand')}, 'red') OR contains({norm('p_brand')}, '#7') OR contains({norm('p_name')}, 'red')
OR contains({norm('p_name')}, '#7') AS qse FROM part),
summary AS (SELECT arg_min(raw, row_id) AS "Type", count(*) AS "Count",
CASE WHEN bool_or(qse) THEN 'Yes' ELSE 'No' END AS "QSE", min(row_id) AS first_row, tn FROM r WHERE trim(tn) <> '' GROUP BY tn)"""


@query("type_summary", f'WITH {_REC} SELECT "Type", "Count", "QSE" FROM summary')
def _(spark, d):
    return rec.type_summary(records(spark, d), *TYPE_ARGS, terms=TERMS)


@query("type_domain_pairs", f"""WITH {_REC}
SELECT DISTINCT "Type" AS type, domain, subdomain, s."QSE" FROM r JOIN summary s ON s.tn = r.tn""")
def _(spark, d):
    return rec.type_domain_pairs(records(spark, d), *TYPE_ARGS, terms=TERMS).drop("first_row")


@query("distinct_types", f"WITH {_REC} SELECT DISTINCT tn AS type FROM r")
def _(spark, d):
    return rec.distinct_types(records(spark, d), "typedeveille")


@query("qse_flag", f"""SELECT doc_id, contains(n, 'tion') OR contains(n, 'securite') OR contains(n, 'ement') AS qse
FROM (SELECT doc_id, {norm('text')} AS n FROM documents)""")
def _(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", rec.qse_flag("text", terms=("tion", "securite", "ement")).alias("qse"))


_BRANDS = 's AS (SELECT p_brand AS "Type", count(*) AS "Count" FROM part GROUP BY p_brand)'


def brand_sizes(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_brand").alias("Type")).agg(F.count(F.lit(1)).alias("Count"))


@query("distribution", f"""WITH {_BRANDS}, t AS (SELECT * FROM s ORDER BY "Count" DESC, "Type" LIMIT 15)
SELECT "Type", "Count", round("Count" * 100.0 / (SELECT sum("Count") FROM t), 6) AS "Percentage",
       round("Count" * 100.0 / (SELECT sum("Count") FROM s), 6) AS "OverallPercentage" FROM t""")
def _(spark, d):
    out = rec.distribution(brand_sizes(spark, d), 15)
    return out.select("Type", "Count", r6("Percentage"), r6("OverallPercentage"))


@query("top_summary", f'WITH {_BRANDS} SELECT "Type", "Count" FROM s ORDER BY "Count" DESC, "Type" LIMIT 20')
def _(spark, d):
    return rec.top_summary(brand_sizes(spark, d), 20)


@query("share_of_total", f"""WITH {_BRANDS}
SELECT "Type", "Count", round("Count" * 100.0 / (SELECT sum("Count") FROM s), 6) AS share FROM s""")
def _(spark, d):
    return share_of_total(brand_sizes(spark, d), "Count", "share").select("Type", "Count", r6("share"))


@query("sheet_key", """SELECT page_id, coalesce(nullif(trim(regexp_replace(substr(url, 1, 31), '[^\\p{L}\\p{N} _]', '', 'g')), ''),
'Sheet_' || page_id) AS sheet_key FROM pages""")
def _(spark, d):
    fallback = F.concat(F.lit("Sheet_"), F.col("page_id").cast("string"))
    return table(spark, d, "pages").select("page_id", sheet_key("url", fallback).alias("sheet_key"))


# --- themes over the given clusters ----------------------------------------

_WORDS = f"""{V_SQL}, tok AS (SELECT cluster, row_id, unnest(w) AS word, unnest(range(len(w))) AS pos
FROM (SELECT cluster, row_id, [x FOR x IN string_split_regex({norm('label')}, '\\s+') IF x <> ''] AS w FROM v)),
cnt AS (SELECT cluster, word, count(*) AS n, min(row_id * 1000000 + pos) AS seen FROM tok WHERE len(word) > 3 GROUP BY 1, 2),
kw AS (SELECT cluster, word, n AS count, (row_number() OVER (PARTITION BY cluster ORDER BY n DESC, seen))::INTEGER AS rank FROM cnt
       QUALIFY rank <= 5)"""
_NAMES = f"""{_WORDS},
base AS (SELECT cluster, (SELECT list(word ORDER BY rank) FROM kw WHERE kw.cluster = c.cluster) AS w,
                (SELECT arg_min(label, row_id) FROM v WHERE v.cluster = c.cluster) AS lead
         FROM (SELECT DISTINCT cluster FROM v) c),
named AS (SELECT cluster, CASE WHEN len(w) >= 2 THEN w[1] || ' / ' || w[2] ELSE lead END AS n FROM base),
cap AS (SELECT cluster, upper(n[1]) || lower(n[2:]) AS n FROM named),
dup AS (SELECT cluster, n, row_number() OVER (PARTITION BY n ORDER BY cluster) AS k FROM cap),
names AS (SELECT cluster, CASE WHEN k = 1 THEN n ELSE n || ' (' || k || ')' END AS theme FROM dup),
themed AS (SELECT row_id AS label_id, label, theme, v.cluster FROM v JOIN names ON v.cluster = names.cluster)"""


def themed(spark, d):
    return th.theme_assignment(vectors(spark, d))


@query("cluster_keywords", f"WITH {_WORDS} SELECT cluster, word, count, rank FROM kw")
def _(spark, d):
    return th.cluster_keywords(vectors(spark, d))


_DOC_WORDS = f"""tok AS (SELECT source, doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos
FROM (SELECT source, doc_id, [x FOR x IN string_split_regex({norm('text')}, '\\s+') IF x <> ''] AS w FROM documents)),
cnt AS (SELECT source, word, count(*) AS n, min(doc_id * 1000000 + pos) AS seen FROM tok WHERE len(word) > 3 GROUP BY 1, 2)"""


@query("cluster_keywords_texts", f"""WITH {_DOC_WORDS}
SELECT source AS cluster, word, n AS count, (row_number() OVER (PARTITION BY source ORDER BY n DESC, seen))::INTEGER AS rank
FROM cnt QUALIFY rank <= 5""")
def _(spark, d):
    docs = table(spark, d, "documents").select(
        F.col("source").alias("cluster"), F.col("doc_id").alias("row_id"), F.col("text").alias("label"))
    return th.cluster_keywords(spread(docs, "row_id"))


@query("name_clusters", f"WITH {_NAMES} SELECT cluster, theme FROM names")
def _(spark, d):
    v = vectors(spark, d)
    return th.name_clusters(th.cluster_keywords(v), v)


@query("theme_assignment", f"WITH {_NAMES} SELECT label_id, label, theme, cluster FROM themed")
def _(spark, d):
    return themed(spark, d)


@query("theme_summary", f"""WITH {_NAMES}
SELECT theme AS "Theme", count(*) AS "Count", array_to_string(list(label ORDER BY label, label_id)[1:3], ', ') AS "Examples"
FROM themed GROUP BY theme""")
def _(spark, d):
    return th.theme_summary(themed(spark, d))


@query("sort_labels", f"WITH {_NAMES} SELECT label_id, label, theme FROM themed ORDER BY theme, label, label_id")
def _(spark, d):
    return th.sort_labels(themed(spark, d).select("label_id", "label", "theme"))


# renames and moves derived from the clusters themselves: even clusters get a
# new name, and every label with "red" moves to one new theme
_EDITS = f"""{_NAMES},
mapping AS (SELECT theme AS old_theme, 'Group ' || cluster AS new_theme FROM names WHERE cluster < 5),
moves AS (SELECT label_id, label, theme AS old_theme, 'Red things' AS new_theme FROM themed WHERE contains(label, 'red'))"""


def mapping(spark, d, t):
    return t.where("cluster < 5").select(F.col("theme").alias("old_theme"), F.concat(
        F.lit("Group "), F.col("cluster").cast("string")).alias("new_theme")).distinct()


def moves(t):
    return t.where(F.contains("label", F.lit("red"))).select(
        "label_id", "label", F.col("theme").alias("old_theme"), F.lit("Red things").alias("new_theme"))


@query("rename_themes", f"""WITH {_EDITS}
SELECT label_id, label, coalesce(new_theme, theme) AS theme FROM themed LEFT JOIN mapping ON old_theme = theme""")
def _(spark, d):
    t = themed(spark, d)
    return th.rename_themes(t.select("label_id", "label", "theme"), mapping(spark, d, t))


@query("reassign_entries", f"""WITH {_EDITS}
SELECT label_id, label, coalesce(new_theme, theme) AS theme FROM themed t LEFT JOIN mapping ON old_theme = theme
WHERE NOT EXISTS (SELECT 1 FROM moves m WHERE m.label_id = t.label_id AND m.old_theme = t.theme)
UNION ALL SELECT label_id, label, new_theme FROM moves""")
def _(spark, d):
    t = themed(spark, d)
    return th.reassign_entries(t, moves(t), mapping(spark, d, t))


@query("cluster_themes")
def _(spark, d):
    return th.cluster_themes(vectors(spark, d).drop("cluster")).select("row_id", "label", "cluster")


@query("cluster_theme_report")
def _(spark, d):
    clustered = th.cluster_themes(vectors(spark, d).drop("cluster"))
    return th.theme_summary(th.theme_assignment(clustered))


@query("cluster_themes_check", f"""WITH {V_SQL}
SELECT count(*) AS rows_covered, 0::BIGINT AS nearer_elsewhere, {th.THEMES}::BIGINT AS themes, count(*) AS in_themes FROM v""")
def _(spark, d):
    """What any right clustering fulfils: all rows covered, none nearer to another fitted centre, as many themes as asked
    for, theme sizes that add up."""
    points = th.theme_points(vectors(spark, d).drop("cluster"))
    model = th.fit_themes(points)
    clustered = model.transform(points).drop("_features")
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in centre]) for centre in model.clusterCenters()])

    def distance(mean):
        return F.aggregate(F.zip_with("embedding", mean, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    away = clustered.withColumn("away", F.transform(centres, distance))
    checked = away.agg(F.count(F.lit(1)).alias("rows_covered"),
                       F.count(F.when(F.get("away", "cluster") > F.array_min("away") + 1e-6, 1)).alias("nearer_elsewhere"),
                       F.countDistinct("cluster").alias("themes"))
    sizes = th.theme_summary(th.theme_assignment(clustered)).agg(F.sum("Count").alias("in_themes"))
    return checked.crossJoin(F.broadcast(sizes))


# --- rule catalogue: one rule per part -------------------------------------

@query("summarize_rules", """
SELECT 'rule-' || p_partkey AS id, CASE WHEN p_size > 40 THEN 0 ELSE p_size END AS priority, p_name AS description,
       CASE WHEN p_size > 25 THEN p_type || '(brand=' || p_brand || ', size=' || p_size || ') & same_parent'
            ELSE 'same_parent' END AS condition,
       CASE WHEN p_size < 10 THEN 'merge' ELSE 'merge(into=' || p_name || ')' END AS action FROM part""")
def _(spark, d):
    size = F.col("p_size").cast("string")
    no_attrs = F.create_map().cast("map<string,string>")
    plain = F.struct(F.lit("same_parent").alias("tag"), no_attrs.alias("attrs"))
    typed = F.struct(F.col("p_type").alias("tag"), F.create_map(
        F.lit("brand"), F.col("p_brand"), F.lit("size"), size).alias("attrs"))
    rules = table(spark, d, "part").select(
        F.concat(F.lit(" rule-"), F.col("p_partkey").cast("string")).alias("id"),
        F.when(F.col("p_size") > 40, F.lit("bad")).otherwise(size).alias("priority"),
        F.col("p_name").alias("description"),
        F.when(F.col("p_size") > 25, F.array(typed, plain)).otherwise(F.array(plain)).alias("condition"),
        F.when(F.col("p_size") < 10, F.create_map(F.lit("type"), F.lit("merge"))).otherwise(F.create_map(
            F.lit("type"), F.lit("merge"), F.lit("into"), F.col("p_name"))).alias("action"))
    return summarize_rules(rules)
