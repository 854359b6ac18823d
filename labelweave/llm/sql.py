"""SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from .common import LOWER, UPPER

_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

DECONTAMINATION_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item AS (SELECT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
                FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS phrase FROM b WHERE len(w) > 0),
size AS (SELECT DISTINCT n FROM item),
cut AS (SELECT doc_id, n, unnest([{{'k': i, 'phrase': array_to_string(w[i:i + n - 1], ' ')}}
               FOR i IN range(1, len(w) - n + 2)]) AS c FROM d, size WHERE len(w) >= n),
hit AS (SELECT doc_id, c.k AS k, item.n AS n, item_id FROM cut JOIN item ON c.phrase = item.phrase AND cut.n = item.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)"""

NEAR_DUPLICATES_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + least(len(w), 5) - 1], ' ')
             FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS g FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
                               FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
         JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
LEFT JOIN n USING (doc_id)"""

_MARKS = r"^[\x20\t]*((?:>[\x20\t]?)*)"
_SAID = (f"trim(regexp_replace(translate(regexp_replace(x, '{_MARKS}', ''), '{UPPER}', '{LOWER}'), "
         r"'[\x20\x09-\x0D]+', ' ', 'g'))")

QUOTATIONS_SQL = rf"""
WITH RECURSIVE lined AS (SELECT DISTINCT conv_id, turn, string_split(coalesce(text, ''), chr(10)) AS l FROM conversations
                         WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
line AS (SELECT conv_id, turn, l, i, x, length(replace(replace(regexp_extract(x, '{_MARKS}', 1), ' ', ''), chr(9), '')) AS level,
                {_SAID} AS said
         FROM (SELECT conv_id, turn, l, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS x FROM lined)),
mark AS (SELECT *, CASE WHEN level = lag(level) OVER w AND (said = '') = (lag(said) OVER w = '') THEN 0 ELSE 1 END AS new
         FROM line WINDOW w AS (PARTITION BY conv_id, turn, l ORDER BY i)),
run AS (SELECT *, sum(new) OVER (PARTITION BY conv_id, turn, l ORDER BY i) AS run FROM mark),
unit AS (SELECT conv_id, turn, level, said FROM run WHERE said <> ''
         UNION ALL SELECT conv_id, turn, any_value(level), string_agg(said, ' ' ORDER BY i) FROM run WHERE said <> ''
         GROUP BY conv_id, turn, l, run),
own AS (SELECT conv_id, said, min(turn) AS original FROM unit WHERE level = 0 GROUP BY conv_id, said),
link AS (SELECT q.conv_id, q.turn, q.level, o.original, count(*) AS n
         FROM (SELECT DISTINCT conv_id, turn, level, said FROM unit WHERE level > 0) q JOIN own o USING (conv_id, said)
         WHERE o.original < q.turn GROUP BY ALL),
parent AS (SELECT conv_id, turn, arg_max(original, (-level, n, original)) AS parent, sum(n) AS n_quoted FROM link
           GROUP BY conv_id, turn),
up AS (SELECT conv_id, turn, parent AS root, 1 AS depth FROM parent
       UNION ALL SELECT up.conv_id, up.turn, p.parent, up.depth + 1 FROM up JOIN parent p
       ON p.conv_id = up.conv_id AND p.turn = up.root),
top AS (SELECT conv_id, turn, arg_max(root, depth) AS root, max(depth) AS depth FROM up GROUP BY conv_id, turn)
SELECT c.conv_id, c.turn, c.role, p.parent, coalesce(t.root, c.turn) AS root, coalesce(t.depth, 0)::BIGINT AS depth,
       coalesce(p.n_quoted, 0)::BIGINT AS n_quoted,
       trim(array_to_string([x FOR x IN string_split(c.text, chr(10)) IF NOT regexp_matches(x, '^[\x20\t]*>')], chr(10)), ' ' || chr(10)) AS text
FROM conversations c LEFT JOIN parent p ON p.conv_id = c.conv_id AND p.turn = c.turn
LEFT JOIN top t ON t.conv_id = c.conv_id AND t.turn = c.turn"""

_CRC_STEPS = ("list_reduce(list_concat([4294967295::BIGINT], flatten([[unicode(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0] "
              "FOR x IN string_split(doc_id::VARCHAR, '')])), "
              "lambda c, e: xor(xor(c, e) >> 1, 3988292384::BIGINT * (xor(c, e) & 1)))")


def _leaf_sql(text: str) -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


MERKLE_SQL = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, '=' || source AS s, {_leaf_sql('text')} AS leaf,
         CASE WHEN xor({_CRC_STEPS}, 4294967295) & 1 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql('text')} END AS changed
  FROM documents),
numbered AS (SELECT *, coalesce(s, '') AS src, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaf),
tree AS (SELECT src, 0 AS lv, i, leaf AS h, count(*) OVER (PARTITION BY src) AS n FROM numbered
         UNION ALL SELECT src, lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM tree WHERE n > 1
         GROUP BY src, lv, i // 3, n),
sub AS (SELECT src, h, row_number() OVER (ORDER BY src) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (SELECT 0 AS lv, i, h, n FROM sub
        UNION ALL SELECT lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY lv, i // 3, n),
height AS (SELECT src, max(lv) AS lv FROM tree GROUP BY src),
node AS (SELECT src, lv, i, h, n FROM tree WHERE n > 1
         UNION ALL SELECT s.src, t.lv + e.lv, t.i, t.h, t.n FROM top t, sub s JOIN height e USING (src) WHERE t.n > 1),
run AS (SELECT src, lv, i // 3 AS up, list({{'i': i, 'h': h}} ORDER BY i) AS kids FROM node GROUP BY src, lv, i // 3),
climb AS (SELECT a.src, a.doc_id, a.i AS leaf_i, 0 AS lv, a.i, a.changed AS folded, '' AS proof, e.lv AS height, s.i AS si
          FROM numbered a JOIN height e USING (src) JOIN sub s USING (src)
          UNION ALL SELECT c.src, c.doc_id, c.leaf_i, c.lv + 1, w.at // 3,
                 sha256(array_to_string([CASE WHEN k.i = w.at THEN c.folded ELSE k.h END FOR k IN r.kids], '')),
                 c.proof || array_to_string([k.h FOR k IN r.kids IF k.i <> w.at], ''), c.height, c.si
          FROM climb c, LATERAL (SELECT CASE WHEN c.lv = c.height THEN c.si ELSE c.i END AS at) w
          JOIN run r ON r.src = c.src AND r.lv = c.lv AND r.up = w.at // 3),
last AS (SELECT src, leaf_i, arg_max(folded, lv) AS folded, arg_max(proof, lv) AS proof FROM climb GROUP BY src, leaf_i)
SELECT a.doc_id, a.leaf, s.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(l.proof) AS proof_sha256,
       l.folded AS folded_root, l.folded = (SELECT h FROM top WHERE n = 1) AS verified
FROM numbered a JOIN sub s USING (src) JOIN last l ON l.src = a.src AND l.leaf_i = a.i"""
