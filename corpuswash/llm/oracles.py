"""DuckDB restatements of the dealt queries that SQL can express."""

from __future__ import annotations

from corpuswash.llm.chat import CONTROL

_A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _escaped_chars(text: str) -> str:
    """Length of the escaped text: one more character per backslash and per control string."""
    more = [f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in ("\\", *CONTROL)]
    return f"length({text}) + " + " + ".join(more)


OP5 = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(20 + {_escaped_chars("role")} + {_escaped_chars("text")}) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

OP6 = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, length(regexp_replace(' ' || coalesce(text, ''), '[\\x20\\x09-\\x0D]+[^\\x20\\x09-\\x0D]+', chr(1), 'g'))
           - length(replace(regexp_replace(' ' || coalesce(text, ''), '[\\x20\\x09-\\x0D]+[^\\x20\\x09-\\x0D]+', chr(1), 'g'), chr(1), '')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':17:' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0 * sum(size) AS cap,
         [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY source
), total AS (SELECT 1.5 * sum(source_size) AS budget FROM per),
fill(level, round) AS (
  SELECT CAST(0 AS DOUBLE), 0
  UNION ALL
  SELECT n.level, f.round + 1 FROM fill f, LATERAL (
    SELECT CAST(((SELECT budget FROM total) - sum(CASE WHEN w * f.level >= cap THEN cap ELSE 0 END)) AS DOUBLE)
           / nullif(CAST(sum(CASE WHEN w * f.level >= cap THEN 0 ELSE w END) AS DOUBLE), 0) AS level FROM per
  ) n WHERE n.level > f.level
), aimed AS (
  SELECT source, source_size, CAST(least(cap, w * (SELECT max(level) FROM fill)) AS DOUBLE) AS target FROM per
), split AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM aimed
), r0 AS (
  SELECT d.doc_id, d.size, d.h, p.source, p.source_size, p.target, p.whole, target - whole * source_size AS rest0, false AS t0
  FROM sized d JOIN split p ON d.source IS NOT DISTINCT FROM p.source
), s1 AS (
  SELECT *, CASE WHEN t0 OR size > rest0 THEN NULL ELSE sum(size) FILTER (NOT t0 AND size <= rest0) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS upto1 FROM r0
), r1 AS (
  SELECT * , rest0 - coalesce(sum(size) FILTER (t1) OVER (PARTITION BY source), 0) AS rest1 FROM (SELECT *, t0 OR coalesce(upto1 <= rest0, false) AS t1 FROM s1) x
), s2 AS (
  SELECT *, CASE WHEN t1 OR size > rest1 THEN NULL ELSE sum(size) FILTER (NOT t1 AND size <= rest1) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS upto2 FROM r1
), r2 AS (
  SELECT * , rest0 - coalesce(sum(size) FILTER (t2) OVER (PARTITION BY source), 0) AS rest2 FROM (SELECT *, t1 OR coalesce(upto2 <= rest1, false) AS t2 FROM s2) x
), s3 AS (
  SELECT *, CASE WHEN t2 OR size > rest2 THEN NULL ELSE sum(size) FILTER (NOT t2 AND size <= rest2) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS upto3 FROM r2
), r3 AS (
  SELECT * , rest0 - coalesce(sum(size) FILTER (t3) OVER (PARTITION BY source), 0) AS rest3 FROM (SELECT *, t2 OR coalesce(upto3 <= rest2, false) AS t3 FROM s3) x
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN t3 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r3
"""

OP10 = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_A_Z}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), {_A_Z}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n
), found AS (
  SELECT p.doc_id, p.i, p.n, v.item FROM places p JOIN windows v ON v.n = p.n AND v.win = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id
), told AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit ON hit.doc_id = words.doc_id LEFT JOIN told ON told.doc_id = words.doc_id
"""


OP11 = f"""
WITH pieces AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), {_A_Z}), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
), counts AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) ks(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 10
), sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
cuts AS (
  SELECT lang, k, phrase, f AS a, j, array_to_string(w[:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM counts WHERE k > 1)
), scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, l.f AS l, r.f AS r, CAST(a AS HUGEINT) * a * 1000000 // (CAST(l.f AS HUGEINT) * r.f) AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY CAST(a AS HUGEINT) * a * 1000000 // (CAST(l.f AS HUGEINT) * r.f), j) AS best
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.head JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest
), inside AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, f, array_to_string(string_split(phrase, ' ')[i:i + 1], ' ') AS phrase FROM counts, (VALUES (1), (2)) v(i) WHERE k = 3)
  GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE best = 1 AND (longer IS NULL OR 100 * longer < 50 * a)
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_chat": OP5, "op6_mixing": OP6, "op10_decontam": OP10, "op11_phrases": OP11}
