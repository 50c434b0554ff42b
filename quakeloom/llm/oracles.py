"""SQL (DuckDB) that answers the queries where SQL can: plain grouping, sorting and self-joins."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

EXACT_DEDUP = """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

#: Targets by the closed form of the capped shares, thresholds by sorting on the hash.
MIXING = f"""WITH d AS (SELECT doc_id, source, len({_WORDS}) AS size, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
    FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, [3e0, 1e0, 2e0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 2e0 * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER r AS i, coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS full_before,
    sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w WINDOW r AS (ORDER BY cap / weight, source NULLS LAST)),
v AS (SELECT *, (1.5e0 * (SELECT sum(source_size) FROM s) - full_before) / rest AS level FROM o),
l AS (SELECT arg_min(level, i) AS level FROM v WHERE weight * level < cap),
t AS (SELECT source, source_size, least(cap, weight * (SELECT level FROM l)) AS target FROM w),
b AS (SELECT d.*, source_size, target, floor(target / greatest(source_size, 1)) AS passes, target - floor(target / greatest(source_size, 1)) * source_size
    AS budget, sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY d.source, h) AS own
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(least(passes + CASE WHEN upto <= budget OR (upto - own <= budget AND 2 * (budget - (upto - own)) >= own)
    THEN 1 ELSE 0 END, 2) * size AS BIGINT) AS taken FROM b"""

_ESCAPED = r"""regexp_replace({0}, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE\]|TURN\]|END\])', '\1\\\2\3', 'g')"""
CHAT = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
    SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, lag(role) OVER o IS DISTINCT FROM role AS first, lead(role) OVER o IS DISTINCT FROM role AS last,
    CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 11 ELSE 18 + length({_ESCAPED.format('role')}) END AS marks
    FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length({_ESCAPED.format('text')}) + CASE WHEN first THEN marks ELSE 6 END) AS BIGINT) AS formatted_chars FROM n GROUP BY conv_id"""

SUBSTRINGS = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p, len(w) AS n FROM d),
x AS (SELECT *, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS run FROM t),
g AS (SELECT run FROM x WHERE p <= n - 34 GROUP BY run HAVING count(*) > 1),
k AS (SELECT x.*, x.p <= x.n - 34 AND g.run IS NOT NULL AS again FROM x LEFT JOIN g ON x.run = g.run),
c AS (SELECT r, p, word, p - coalesce(max(CASE WHEN again THEN p END) OVER (PARTITION BY r ORDER BY p), -99) < 35 AS gone FROM k),
e AS (SELECT r, count(*) AS n, count(*) FILTER (gone) AS m, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept FROM c GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(m, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN e USING (r)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
JACCARD = rf"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p, len(w) AS n FROM d),
x AS (SELECT r, p, n, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS run FROM t),
s AS (SELECT DISTINCT r, run FROM x WHERE p <= greatest(n - 3, 1)),
z AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS common FROM s a JOIN s b ON a.run = b.run AND a.r < b.r GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN z y ON y.r = a JOIN z q ON q.r = b WHERE 100 * common >= 85 * (y.n + q.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c AS (SELECT r AS a, r AS b FROM d UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a),
m AS (SELECT c.a AS r, min(doc_id) AS component_id FROM c JOIN d ON d.r = c.b GROUP BY 1)
SELECT doc_id, coalesce(z.n, 0) AS n_shingles, component_id FROM d JOIN m USING (r) LEFT JOIN z USING (r)"""

ORACLES = {
    "op3_exact_dedup": EXACT_DEDUP,
    "op5_mixing": MIXING,
    "op7_chat": CHAT,
    "op9_substrings": SUBSTRINGS,
    "op10_jaccard": JACCARD,
}
