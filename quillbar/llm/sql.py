"""DuckDB SQL for the queries of this folder that SQL can express."""

CHAT_SQL = r"""
WITH rows AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos FROM rows),
said AS (SELECT *, coalesce(role, chr(1)) || chr(2) || coalesce(text, chr(1)) || chr(3) AS turn_text FROM n),
pre AS (SELECT conv_id, pos, sha256(string_agg(turn_text, '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos)) AS h,
        count(*) OVER (PARTITION BY conv_id) AS len FROM said),
whole AS (SELECT h, len AS n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM pre WHERE pos = len GROUP BY h, len),
kept AS (SELECT * FROM whole w WHERE NOT EXISTS (SELECT 1 FROM pre p WHERE p.pos < p.len AND p.pos = w.n_turns AND p.h = w.h))
SELECT n.conv_id, CAST(floor((n.pos - 1) / 1024) AS BIGINT) AS part, any_value(k.n_turns) AS n_turns, any_value(k.n_copies) AS n_copies,
       string_agg('<|' || coalesce(n.role, 'unknown') || '|>' || chr(10) || coalesce(n.text, '') || chr(10), '' ORDER BY n.pos) AS text
FROM n JOIN kept k ON n.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY 1, 2"""

MIXING_SQL = r"""
WITH docs AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
              (CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents),
liked AS (SELECT *, CASE WHEN size >= 500 THEN 3.0::DOUBLE WHEN size >= 50 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS x FROM docs),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w, source_size * 2.0::DOUBLE AS cap FROM per),
lev AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0.0::DOUBLE)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0.0::DOUBLE)) AS level
  FROM w WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fill AS (SELECT *, w * level >= cap AS is_full FROM lev),
tgt AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE w * (SELECT first(level ORDER BY cap / w, source NULLS LAST) FROM fill WHERE NOT is_full) END AS target FROM fill),
levels AS (SELECT source, x, CAST(sum(size) AS DOUBLE) AS s FROM liked GROUP BY source, x),
rated AS (SELECT l.source, l.x, (t.target - 2.0::DOUBLE * coalesce(sum(l.s) OVER above, 0.0::DOUBLE))
    / nullif(sum(l.s * l.x) OVER (PARTITION BY l.source) - coalesce(sum(l.s * l.x) OVER above, 0.0::DOUBLE), 0) AS rate
  FROM levels l JOIN tgt t ON l.source IS NOT DISTINCT FROM t.source WINDOW above AS (PARTITION BY l.source ORDER BY l.x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
factor AS (SELECT source, coalesce(arg_max(rate, x) FILTER (WHERE rate * x < 2), 1e300::DOUBLE) AS per FROM rated GROUP BY source),
e AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size = 0 THEN 0.0::DOUBLE ELSE least(2.0::DOUBLE, f.per * d.x) END AS e
  FROM liked d JOIN tgt t ON d.source IS NOT DISTINCT FROM t.source JOIN factor f ON d.source IS NOT DISTINCT FROM f.source),
q AS (SELECT *, CAST(floor(e) AS BIGINT) AS sure, e - floor(e) AS p FROM e),
r AS (SELECT *, CASE WHEN sure >= 2 THEN NULL WHEN p > 0 THEN u / (1 - u) * (1 - p) / p ELSE 1e300 * u END AS q,
  target - sum(size * sure) OVER (PARTITION BY source) AS rest FROM q),
s AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, q IS NULL ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM r)
SELECT doc_id, size, source_size, target,
  CAST(size * (sure + CASE WHEN q IS NULL OR size = 0 THEN 0 WHEN done + size / 2.0::DOUBLE < rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM s"""

TOP_K_SQL = """
WITH v AS (
    SELECT vec_id, row_number() OVER () AS place, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.place, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.place <> c.place WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

PHRASE_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (SELECT lang, array_to_string(unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i : i + m - 1])), ' ') AS phrase
          FROM w CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
f AS (SELECT lang, phrase, count(*) AS a FROM grams GROUP BY lang, phrase HAVING count(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE contains(phrase, ' ')),
cuts AS (SELECT lang, phrase, a, w, unnest(range(1, len(w))) AS k FROM c),
scored AS (
    SELECT t.lang, t.phrase, t.a, t.k, x.a AS l, y.a AS r, CAST(2000000::HUGEINT * t.a // (x.a::HUGEINT + y.a) AS BIGINT) AS score
    FROM cuts t JOIN f x ON x.lang = t.lang AND x.phrase = array_to_string(t.w[1 : t.k], ' ')
    JOIN f y ON y.lang = t.lang AND y.phrase = array_to_string(t.w[t.k + 1 : len(t.w)], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (SELECT lang, a, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM (SELECT *, unnest(range(2, len(w))) AS m FROM c)),
longer AS (SELECT lang, array_to_string(w[s : s + m - 1], ' ') AS phrase, max(a) AS longer FROM spans GROUP BY 1, 2),
ranked AS (
    SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, b.l, b.r, b.score
    FROM best b LEFT JOIN longer USING (lang, phrase) WHERE longer.longer IS NULL OR 100::HUGEINT * longer.longer < 80::HUGEINT * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
