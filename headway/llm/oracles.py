"""DuckDB SQL of the operators that SQL can express on whole tables, without their methods' short cuts."""

from __future__ import annotations

from .quality import BOILERPLATE, BOILERPLATE_CHARS, KEEP_SHARE, MAX_REPEAT, MIN_WORDS, SENTENCE_MARK, SEPARATORS, SYMBOL_SHARE, SYMBOLS

WS = r"[\x20\x09-\x0D]+"
SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS = "list_filter(string_split_regex({0}, '" + WS + "'), lambda w: w <> '')"
_LINE_PASSES = f"""regexp_matches(x, '{SENTENCE_MARK}')
 AND (length(x) - length(regexp_replace(x, '{SYMBOLS}', '', 'g')) < 3 OR length(x) - length(regexp_replace(x, '{SYMBOLS}', '', 'g')) <= length(x) * {SYMBOL_SHARE}e0)
 AND NOT (length(x) >= 20 AND upper(x) = x AND lower(x) <> x)
 AND NOT (len(string_split_regex(x, '{SEPARATORS}')) >= 4 AND (len(string_split_regex(x, '{SEPARATORS}')) - 1) * 5 >= len({WORDS.format('x')}))
 AND NOT (length(x) <= {BOILERPLATE_CHARS} AND regexp_matches(x, '{BOILERPLATE}'))"""

QUALITY = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {WORDS.format('t')} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
f AS (SELECT *, list_filter(ls, lambda x: NOT ({_LINE_PASSES})) AS failed FROM w),
p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
k AS (SELECT doc_id, i, concat_ws(chr(31), word, {', '.join(f'lead(word, {j}) OVER o' for j in range(1, 8))}) AS key, lead(word, 7) OVER o AS last FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, key) AS c FROM k WHERE last IS NOT NULL) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM again) GROUP BY 1),
counts AS (SELECT f.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, CAST(len(failed) AS BIGINT) AS n_lines_failed,
  coalesce(list_sum(list_transform(failed, lambda x: len({WORDS.format('x')}))), 0) AS lost FROM f LEFT JOIN covered USING (doc_id)),
base AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines_failed, base_failed, NOT base_failed AND n_words - lost >= n_words * {KEEP_SHARE}e0 AS kept FROM base"""

LINES = f"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, {SPACE}), '{UPPER}', '{UPPER.lower()}') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY 1),
m AS (SELECT k.doc_id, pos, line, coalesce(owner < k.doc_id, false) AS gone FROM k LEFT JOIN o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY 1"""

TOP_K = """WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""

NEAR = f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')")} AS ws FROM documents),
p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM w),
k AS (SELECT doc_id, i, n, concat_ws(chr(31), word, {', '.join(f'lead(word, {j}) OVER o' for j in range(1, 5))}) AS key FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
t AS MATERIALIZED (SELECT DISTINCT doc_id, hash(key) AS key FROM k WHERE i = 1 OR i + 4 <= n),
c AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM t GROUP BY 1),
shared AS (SELECT doc_id, key FROM (SELECT *, count(*) OVER (PARTITION BY key) AS df FROM t) WHERE df > 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM shared a JOIN shared b ON a.key = b.key AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM pairs JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
r(a, b) AS (SELECT a, b FROM (SELECT a, b FROM e UNION SELECT b, a FROM e) UNION SELECT r.a, x.b FROM r JOIN (SELECT a, b FROM e UNION SELECT b, a FROM e) x ON x.a = r.b)
SELECT w.doc_id, coalesce(max(c.n), 0) AS n_shingles, least(w.doc_id, coalesce(min(r.b), w.doc_id)) AS component_id FROM w LEFT JOIN c ON c.doc_id = w.doc_id LEFT JOIN r ON r.a = w.doc_id GROUP BY w.doc_id"""

FILTER_ORDERS = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part, {WORDS.format("coalesce(text, '')")} AS ws FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, len(ws) < 200 AS A, 100 * len(list_distinct(ws)) < 50 * len(ws) AS B,
  100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) AS C, regexp_matches(t, '[#$%&*|]') AS D,
  coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS E FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
m AS (SELECT part, good, toxic, CASE WHEN A THEN 'A' ELSE '' END || CASE WHEN B THEN 'B' ELSE '' END || CASE WHEN C THEN 'C' ELSE '' END || CASE WHEN D THEN 'D' ELSE '' END || CASE WHEN E THEN 'E' ELSE '' END AS fails FROM f),
c AS (SELECT part, good, toxic, fails, count(*) AS n FROM m GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step:step] AS filter, filter_order[1:step - 1] AS earlier FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
e AS (SELECT part, filter_order, step, filter, n, good, toxic, contains(fails, filter) AS now, fails = filter AS alone, translate(earlier, fails, '') <> earlier AS gone FROM s, c),
r AS (SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (NOT gone AND NOT now), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND now), 0) AS removed, coalesce(sum(n) FILTER (gone AND now), 0) AS redundant,
  coalesce(sum(n) FILTER (alone), 0) AS unique_fails, coalesce(sum(n) FILTER (NOT gone AND now AND good = 1), 0) AS good_lost, coalesce(sum(n) FILTER (NOT gone AND now AND toxic = 1), 0) AS toxic_lost FROM e GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM r"""

COPIES = """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, row_number() OVER (w ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""

DIVERGENCE = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS whole FROM k GROUP BY 1),
w AS (SELECT lang, source, sum(n) AS whole FROM c GROUP BY 1, 2),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(w.whole, 0) + 2 * v.v) AS HUGEINT) AS p,
  CAST(1 + (1000000000::HUGEINT * (k.n + 2)) // (v.whole + 2 * v.v) AS HUGEINT) AS q
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term LEFT JOIN w ON w.lang = g.lang AND w.source = g.source),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""

DIVERGENCE = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS whole FROM k GROUP BY 1),
w AS (SELECT lang, source, sum(n) AS whole FROM c GROUP BY 1, 2),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(w.whole, 0) + 2 * v.v) AS HUGEINT) AS p,
  CAST(1 + (1000000000::HUGEINT * (k.n + 2)) // (v.whole + 2 * v.v) AS HUGEINT) AS q
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term LEFT JOIN w ON w.lang = g.lang AND w.source = g.source),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""
