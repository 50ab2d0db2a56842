"""DuckDB SQL of the queries that SQL can express on whole tables."""

OP8 = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)])
                        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS s
    FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (
    SELECT doc_id, doc_id AS other FROM sets
    UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON s.doc_id = r.doc_id
"""

OP9 = """
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
           md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(md5(text), '')) AS k
    FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight FROM s),
f AS (
    SELECT *, coalesce(sum(source_size) OVER b, 0) * CAST(2 AS DOUBLE) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS free,
           sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS shared
    FROM w WINDOW b AS (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (shared - capped) / free AS level, source_size * CAST(2 AS DOUBLE) AS cap FROM f),
m AS (SELECT max(level) AS level FROM l WHERE level * weight <= cap),
t AS (SELECT l.source, l.source_size, least(l.cap, coalesce(m.level * l.weight, l.cap)) AS target FROM l, m),
x AS (SELECT *, CAST(greatest(1, least(ceil(sum(target) OVER () / 1048576), floor(target / 4096))) AS BIGINT) AS block FROM t),
u AS (SELECT *, sum(target / block) OVER (ORDER BY source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM x),
v AS (SELECT *, max(upto) OVER () AS total FROM u),
y AS (SELECT *, CAST(ceil(source_size / block) AS BIGINT) AS blocks, CAST(floor(total) AS BIGINT) AS n_slots,
             CAST(floor(upto / total * 4294967296) AS BIGINT) AS hi FROM v),
z AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY source IS NULL, source), 0) AS lo FROM y WHERE target > 0),
slots AS (SELECT i AS slot, (i * 2654435769) % 4294967296 AS p FROM range(0, (SELECT max(n_slots) FROM y)) AS q(i)),
placed AS (SELECT z.source, z.blocks, row_number() OVER (PARTITION BY z.source ORDER BY slot) - 1 AS turn FROM slots JOIN z ON p >= z.lo AND p < z.hi),
times AS (SELECT source, turn % blocks AS nth, count(*) AS times FROM placed WHERE turn < blocks * 2 GROUP BY source, turn % blocks),
e AS (SELECT d.*, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begins FROM d),
pieces AS (
    SELECT e.r, e.source, e.size, e.begins, y.block, unnest(range(e.begins // y.block, (e.begins + e.size - 1) // y.block + 1)) AS nth
    FROM e JOIN y ON e.source IS NOT DISTINCT FROM y.source WHERE e.size > 0),
taken AS (
    SELECT p.r, sum((least(p.begins + p.size, (p.nth + 1) * p.block) - greatest(p.begins, p.nth * p.block)) * t.times) AS taken
    FROM pieces p JOIN times t ON p.nth = t.nth AND p.source IS NOT DISTINCT FROM t.source GROUP BY p.r)
SELECT d.doc_id, d.size, y.source_size, y.target, CAST(coalesce(taken.taken, 0) AS BIGINT) AS taken
FROM d JOIN y ON d.source IS NOT DISTINCT FROM y.source LEFT JOIN taken ON d.r = taken.r
"""

OP11 = """
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws
    FROM documents),
wanted AS (
    SELECT i, item_id, term, count(*) AS q FROM (
        SELECT row_number() OVER () AS i, item_id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM benchmark) GROUP BY i, item_id, term),
total AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM words WHERE len(ws) > 0),
tf AS (SELECT r, doc_id, len(ws)::BIGINT AS n, term, count(*) AS tf FROM (SELECT r, doc_id, ws, unnest(ws) AS term FROM words) GROUP BY r, doc_id, ws, term),
known AS (SELECT * FROM tf WHERE term IN (SELECT term FROM wanted)),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM known GROUP BY term), total),
scored AS (
    SELECT i, item_id, r, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_terms)))))::BIGINT AS score
    FROM wanted JOIN known USING (term) JOIN weights USING (term), total GROUP BY i, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""

OP12 = """
WITH RECURSIVE crc_table AS (
    SELECT list(c ORDER BY i) AS tab FROM (
        SELECT i, list_reduce(list_prepend(i, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) AS g(i))),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(list_prepend(4294967295, [ord(x)::BIGINT FOR x IN string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]),
                           lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS code
    FROM conversations, crc_table),
damaged AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
    FROM keyed WHERE code <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
faults AS (
    SELECT *, CASE WHEN rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') = '' THEN 'b'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                   WHEN right(rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
           lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair
    FROM placed),
told AS (
    SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
           count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
           list({'role': role, 'x': substr(role, 1, 1), 'gone': fault IN ('b', 'd'), 'cut': CASE WHEN fault = 't' THEN 3 ELSE 0 END, 'text': text} ORDER BY i) AS steps
    FROM faults GROUP BY conv_id),
walk AS (
    SELECT conv_id, steps, 0::BIGINT AS i, [{'c': 0::BIGINT, 'a': '', 't': ''}, {'c': 1000000000000, 'a': '', 't': ''},
           {'c': 3, 'a': 'I', 't': chr(10) || 'user:'}, {'c': 6, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}] AS s
    FROM told
    UNION ALL
    SELECT conv_id, steps, i, [s[1], s[2], y, list_min([s[4], {'c': y.c + 3, 'a': y.a || 'I', 't': y.t || chr(10) || 'assistant:'}])] FROM (
        SELECT conv_id, steps, i, s, list_min([s[3], {'c': s[1].c + 3, 'a': s[1].a || 'I', 't': s[1].t || chr(10) || 'user:'},
               {'c': s[2].c + 3, 'a': s[2].a || 'I', 't': s[2].t || chr(10) || 'user:'}, {'c': s[4].c + 3, 'a': s[4].a || 'I', 't': s[4].t || chr(10) || 'user:'}]) AS y FROM (
            SELECT conv_id, steps, i, [
                d[1],
                list_min([d[2], CASE WHEN NOT e.gone AND e.x = 's' THEN {'c': s[1].c + e.cut, 'a': s[1].a || 'K', 't': s[1].t || chr(10) || e.role || ':' || e.text} ELSE d[2] END]),
                list_min(list_concat([d[3]], CASE WHEN e.gone THEN [] ELSE list_concat(
                    [{'c': z.c + e.cut + 3, 'a': z.a || 'R', 't': z.t || chr(10) || 'user:' || e.text} FOR z IN [s[1], s[2], s[4]]],
                    CASE WHEN e.x = 'u' THEN [{'c': z.c + e.cut, 'a': z.a || 'K', 't': z.t || chr(10) || e.role || ':' || e.text} FOR z IN [s[1], s[2], s[4]]] ELSE [] END) END)),
                list_min(list_concat([d[4]], CASE WHEN e.gone THEN [] ELSE list_concat(
                    [{'c': s[3].c + e.cut + 3, 'a': s[3].a || 'R', 't': s[3].t || chr(10) || 'assistant:' || e.text}],
                    CASE WHEN e.x = 'a' THEN [{'c': s[3].c + e.cut, 'a': s[3].a || 'K', 't': s[3].t || chr(10) || e.role || ':' || e.text}] ELSE [] END) END))] AS s
            FROM (SELECT conv_id, steps, i + 1 AS i, s, steps[i + 1] AS e, [{'c': z.c + 4, 'a': z.a || 'D', 't': z.t} FOR z IN s] AS d FROM walk WHERE i < len(steps))))),
ended AS (SELECT conv_id, list_min([s[1], s[4]]) AS e FROM walk WHERE i = len(steps))
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.a, '') AS audit, sha256(substr(coalesce(e.t, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN told ON o.conv_id IS NOT DISTINCT FROM told.conv_id LEFT JOIN ended ON o.conv_id IS NOT DISTINCT FROM ended.conv_id
"""

OP13 = """
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
valid AS (
    SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM rows
    WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.r AS x, b.r AS y FROM valid a JOIN valid b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach AS (SELECT r, r AS other FROM rows UNION SELECT reach.r, links.y FROM reach JOIN links ON reach.other = links.x)
SELECT rows.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, rows.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM rows LEFT JOIN (SELECT x, count(*) AS n_links FROM links GROUP BY x) n ON rows.r = n.x
JOIN (SELECT reach.r, min(o.vec_id) AS component_id FROM reach JOIN rows o ON reach.other = o.r GROUP BY reach.r) c ON rows.r = c.r
"""

ORACLE_SQL = {"op8_jaccard_rtree": OP8, "op9_mixing": OP9, "op11_fptree_search": OP11, "op12_conversation_repair": OP12, "op13_flat_graph": OP13}
