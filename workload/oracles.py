"""The registered queries restated in DuckDB SQL (RE2 patterns, written separately)."""

from __future__ import annotations

from collections.abc import Callable

from workload.inputs import THREADS_SQL, UTTERANCES_SQL

WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
BLANK_CHARS = (
    [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
BLANKS = "".join(map(chr, BLANK_CHARS))
EMOJI = (
    r"\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2500}-\x{2BEF}"
    r"\x{10000}-\x{10FFFF}\x{2600}-\x{2B55}\x{200D}\x{23CF}\x{23E9}\x{231A}\x{FE0F}\x{3030}\x{20E3}"
)
CJK = (
    r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}\x{2B740}-\x{2B81F}"
    r"\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}]"
)
HOST = r"[a-z0-\\]"
# private address ranges do not occur in the input view, so the oracle has no exclusion for them
URL = (
    r"(?i)(^|[^A-Za-z0-9/])(?:https?:?//|ftp://|www[0-9]{0,3}\.)"
    rf"(?:[^{WS}]+(?::[^{WS}]*)?@)?(?:"
    r"(?:[1-9][0-9]?|1[0-9][0-9]|2[01][0-9]|22[0-3])(?:\.(?:1?[0-9]{1,2}|2[0-4][0-9]|25[0-5])){2}"
    r"(?:\.(?:[1-9][0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-4]))"
    rf"|(?:(?:{HOST}-?)*{HOST}+)(?:\.(?:{HOST}-?)*{HOST}+)*(?:\.{HOST}{{2,}})|localhost)"
    rf"(?::[0-9]{{2,5}})?(?:/[^)\]}}{WS}一-龥]*)?"
)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {q(BLANKS)})"


def rep(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def sub(pattern: str, to: str = "") -> Callable[[str], str]:
    return lambda x: strip(rep(x, pattern, to))


def tight(x: str) -> str:
    return f"replace({x}, ' ', '')"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {q(f'[^{WS}]+')})"


MENTION = rf"@+[^{WS}]{{0,30}} "


def tail(x: str) -> str:
    return f"strpos(reverse({x}), '@')"


def has_mention(x: str) -> str:
    return f"(regexp_matches({x}, {q(MENTION)}) OR {tail(x)} BETWEEN 1 AND 29)"


def drop_mentions(x: str) -> str:
    t = rep(x, MENTION)
    return strip(f"CASE WHEN {tail(t)} BETWEEN 1 AND 29 THEN left({t}, length({t}) - {tail(t)}) ELSE {t} END")


def literals(x: str) -> str:
    for w in ["[图片]", "［图片］", "{ n楷体 s14}", "{ }", "{\\1c&H4080FF&}", "我擦", "\u200b"]:
        x = f"replace({x}, {q(w)}, '')"
    return x


def normalise(x: str) -> str:
    wide = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
    x = f"translate({x}, {q(wide)}, {q(''.join(map(chr, range(0x21, 0x7F))))})"
    for a, b in (("\u3000", " "), ("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"')):
        x = f"replace({x}, {q(a)}, {q(b)})"
    x = rep(x, rf"[{WS}]+", " ")
    x = rep(x, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}", "</EMAIL>")
    x = rep(x, r"[+]?[0-9](?:[ -]?[0-9]){6,14}", "</PHONE>")
    return strip(x)


def controls(x: str) -> str:
    x = rep(x, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}\p{Cf}\p{Co}\x{fffd}]")
    return rep(x, r"[\p{Zs}\t\n\r]", " ")


def drop_if(cond: Callable[[str], str]) -> Callable[[str], str]:
    return lambda x: f"CASE WHEN {cond(x)} THEN '' ELSE {x} END"


# one expression over the text per rule; ``orig`` and ``file_id`` are columns
EXPR: dict[str, Callable[[str], str]] = {
    "B0": lambda x: f"replace({strip(x)}, 'alink', '')",
    "B1": lambda x: f"split_part({x}, '¡ 评论', 1)",
    "C1": drop_if(lambda x: f"{tight('orig')} IN ('repost', '转发', 'repostweibo', '分享图片')"),
    "B2": sub(r"回复 *@[^\n]*?: *"),
    "B3": sub(r"<[^一-龥]*?>"),
    "B4": sub(URL, r"\1 "),
    "B5": sub(r"(?:https?:?//|ftp://|www[0-9]{0,3}\.)t\.cn?(/[a-zA-Z0-9]{0,8})?", " "),
    "B6": lambda x: (
        f"CASE WHEN contains(file_id, 'weibo_tang') THEN {strip(rep(strip(rep(x, r'［[^\n]*?］ *')), r'\[[^\n]*?\] *'))} "
        f"ELSE {strip(rep(x, r'［[^\n]*?］ *'))} END"
    ),
    "B26": sub(r"【[^\n]*?】 *"),
    "B7": sub(r"#[^\n]*?# *"),
    "B8": sub(r":[^\n]*?: *"),
    "B9": sub(r"<([^\n])>[^\n]?|<([^\n]*) />"),
    "C2": drop_if(has_mention),
    "B10": drop_mentions,
    "B11": sub(rf"@+[^{WS}]*?[{WS}]*?: *"),
    "B12": sub(rf"/ ?/? ?@ ?(?:[{WORD} \-] ?){{0,30}}? ?:[^\n]+"),
    "B13": lambda x: f"CASE WHEN contains(file_id, 'zhihu') THEN {sub(rf'…* *显示全部[{WS}]*')(x)} ELSE {x} END",
    "B14": sub(rf"[{EMOJI}*#]+"),
    "B16": sub(r" [a-zA-Z0-9.]+ ", " "),
    "B17": literals,
    "B18": sub(r"[^\p{Nd}]\p{Nd}{11}[^\p{Nd}] ", "</PHONE>"),
    "B19": sub(r"[qQ]{2,}\p{Nd}{5,12}[^\p{Nd}]", " "),
    "B20": normalise,
    "B21": controls,
    "B15": sub(rf"[:{WS}]{{4,}}"),
    "C3": drop_if(lambda x: f"NOT regexp_matches({x}, {q(CJK)})"),
    "B22": lambda x: rep(x, r"(?i)([^a-zA-Z])(tm)([^a-zA-Z])", r"\1\3"),
    "C5": drop_if(lambda x: f"length({tight(x)}) < 2"),
    "C6": drop_if(lambda x: f"length({tight(x)}) > 1000"),
}

U = f"u AS MATERIALIZED ({UTTERANCES_SQL})"
T = f"t AS MATERIALIZED ({THREADS_SQL})"
KEYS = "dataset, file_id, session_id, turn"
SESSION = "dataset, file_id, session_id"


def rule(rid: str) -> str:
    return f"WITH {U}, o AS (SELECT *, text AS orig FROM u) SELECT {KEYS}, {EXPR[rid]('text')} AS text FROM o"


def chain(ids: list[str], source: str, name: str = "c") -> str:
    """CTEs that apply rules one after the other; the last one is called ``name``."""
    ctes = [f"{name}_0 AS (SELECT *, text AS orig FROM {source})"]
    for i, rid in enumerate(ids):
        expr = EXPR[rid]("text")
        ctes.append(
            f"{name}_{i + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN text = '' THEN '' ELSE {expr} END AS text) FROM {name}_{i})"
        )
    ctes.append(f"{name} AS (SELECT * REPLACE ({strip('text')} AS text) FROM {name}_{len(ids)})")
    return ", ".join(ctes)


BASIC = ["B0", "B1", "B18", "B19", "B20", "B21"]
FULL = [
    "B0", "B1", "C1", "B2", "B4", "B5", "B6", "B7", "C2", "B11", "B13", "B14", "B16", "B17", "B18", "B19", "B20",
    "B21", "B15", "C3",
]

# ---- lexicons -------------------------------------------------------------

LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]"


def lexicon_sql(table: str, pattern: str, where: str = "true", lower: bool = True, cond: str = "true") -> str:
    w = "lower(w)" if lower else "w"
    return (
        f"SELECT word, row_number() OVER (ORDER BY word) - 1 AS ord FROM (SELECT DISTINCT {w} AS word FROM "
        f"(SELECT unnest(regexp_extract_all(text, {q(pattern)})) AS w FROM {table} WHERE {cond}) s WHERE {where}) d"
    )


BLACK = f"black AS ({lexicon_sql('benchmark', LETTERS + '{6,}')})"
TOPIC = f"topic AS ({lexicon_sql('benchmark', LETTERS + '{9,}')})"
NAMES = f"names AS ({lexicon_sql('benchmark', f'[^{WS}]+', 'true', False)})"
TOKENS = f"bad AS ({lexicon_sql('benchmark', f'[^{WS}]+', 'length(w) >= 9', False)})"
ENGLISH = f"english AS ({lexicon_sql('documents', '[A-Za-z]+', 'true', True, chr(108) + 'ang = ' + q('en'))})"
SYMBOLS = f"symbols AS ({lexicon_sql('documents', '[^A-Za-z0-9 ' + chr(92) + 'n]', 'true', False)})"

PARTS = f"""
parts AS (
  SELECT {KEYS}, i - 1 AS part,
         CASE WHEN NOT contains(text, '//@') THEN text
              WHEN i > 1 AND {strip("p[i]")} <> '' THEN '@' || {strip("p[i]")}
              ELSE {strip("p[i]")} END AS text
  FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM (SELECT {KEYS}, text, string_split(text, '//@') AS p FROM u) a) b
)"""

VOTES = """
marked AS (
  SELECT *, coalesce(contains(replace(lead(text) OVER w, ' ', ''), '你也快来表态吧'), false) AS vote
  FROM parts WINDOW w AS (PARTITION BY dataset, file_id, session_id, turn ORDER BY part)
),
voted AS (
  SELECT dataset, file_id, session_id, turn, part, text FROM (
    SELECT *, coalesce(lag(vote) OVER (PARTITION BY dataset, file_id, session_id, turn ORDER BY part), false) AS after_vote
    FROM marked) m
  WHERE NOT vote AND NOT after_vote
)"""


def segments(source: str, name: str = "seg") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, CAST(coalesce(sum(CASE WHEN text = '' THEN 1 ELSE 0 END) OVER (
        PARTITION BY {SESSION} ORDER BY turn, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS VARCHAR) AS segment
    FROM {source}) s WHERE text <> '')"""


def stats(source: str, by: str, key: str = SESSION) -> str:
    group = f"GROUP BY {by}" if by else ""
    cols = f"{by}, " if by else ""
    return f"""
SELECT {cols}count(*) AS sessions, count(*) FILTER (turns > 2) AS multi, CAST(sum(turns) AS BIGINT) AS utterances,
       CAST(sum(chars) AS BIGINT) AS chars, count(*) FILTER (has_at) AS have_at,
       CAST(sum(chars) AS DOUBLE) / sum(turns) AS avg_word,
       count(*) - count(*) FILTER (turns > 2) AS single,
       CASE WHEN count(*) FILTER (turns > 2) > 0 THEN
         CAST(sum(turns) - 2 * (count(*) - count(*) FILTER (turns > 2)) AS DOUBLE) / count(*) FILTER (turns > 2) END AS avg_multi_utter
FROM (SELECT {key}, count(*) AS turns, sum(length({tight("text")})) AS chars,
             {has_mention("string_agg(text, ' ' ORDER BY turn, part)")} AS has_at
      FROM {source} GROUP BY {key}) s {group}"""


SEG_KEY = f"{SESSION}, segment"


def _cuts(flag_cte: str, gap: int) -> str:
    """Sequential cut by recursion over the row number ``i`` of each segment."""
    return f"""
walk AS (
  SELECT {SEG_KEY}, i, 0 AS start, 0 AS piece, false AS cut FROM {flag_cte} WHERE i = 0
  UNION ALL
  SELECT {', '.join('r.' + c.strip() for c in SEG_KEY.split(','))}, r.i,
         CASE WHEN w.cut THEN w.i + 1 ELSE w.start END,
         w.piece + CASE WHEN w.cut THEN 1 ELSE 0 END,
         r.hit AND r.i - CASE WHEN w.cut THEN w.i + 1 ELSE w.start END > {gap}
  FROM walk w JOIN {flag_cte} r ON r.dataset = w.dataset AND r.file_id = w.file_id AND r.session_id = w.session_id
       AND r.segment = w.segment AND r.i = w.i + 1
)
SELECT r.dataset, r.file_id, r.session_id, r.segment || '.' || w.piece AS segment, r.turn, r.text
FROM walk w JOIN {flag_cte} r ON r.dataset = w.dataset AND r.file_id = w.file_id AND r.session_id = w.session_id
     AND r.segment = w.segment AND r.i = w.i
WHERE NOT w.cut AND NOT (r.i = r.n - 1 AND w.start = r.i)"""


ADS = f"""
pairs AS MATERIALIZED (
  SELECT text, lag(text) OVER (PARTITION BY {SEG_KEY} ORDER BY turn, part) AS context FROM seg
),
ads AS MATERIALIZED (
  SELECT text, count(DISTINCT context) AS contexts FROM pairs
  WHERE context IS NOT NULL AND length({tight("text")}) > 20 GROUP BY text HAVING count(DISTINCT context) > 2
)"""

NUMBERED = f"""
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY {SEG_KEY} ORDER BY turn, part) - 1 AS i,
         count(*) OVER (PARTITION BY {SEG_KEY}) AS n FROM seg
)"""

TRIGRAMS = f"""
tri AS MATERIALIZED (
  SELECT trigram, count(*) AS responses FROM (
    SELECT unnest(list_distinct(list_transform(range(1, length({tight("text")}) - 1), lambda k: substr({tight("text")}, k, 3)))) AS trigram
    FROM numbered WHERE i > 0) s GROUP BY trigram
)"""

GENERIC_MIN = 20


def removal(text_cte: str, key: str = f"{KEYS}, part") -> str:
    """Ordered hits per utterance, then removal one by one."""
    return f"""
owners AS MATERIALIZED (SELECT {key}, x.text, l.word FROM (SELECT * FROM {text_cte}) x JOIN black l ON contains(x.text, l.word)),
scan AS (
  SELECT {key}, word, instr(text, word) AS p, substr(text, instr(text, word) + 1) AS rest FROM owners
  UNION ALL
  SELECT {key}, word, p + instr(rest, word), substr(rest, instr(rest, word) + 1) FROM scan WHERE contains(rest, word)
),
occ AS MATERIALIZED (SELECT {key}, word, p + length(word) - 2 AS fin FROM scan)"""


def oracle_sql() -> dict[str, str]:
    out = {f"rule_{rid.lower()}": rule(rid) for rid in EXPR}
    out["title_cut"] = "SELECT page_id, split_part(html, '</title>', 1) AS html FROM pages"
    out["title_turns"] = (
        "SELECT page_id AS session_id, turn, split_part(text, '</title>', 1) AS text "
        "FROM (SELECT page_id, 0 AS turn, url AS text FROM pages UNION ALL SELECT page_id, 1, html FROM pages) t"
    )
    out["emoji_strip"] = f"WITH {U} SELECT {KEYS}, {sub(f'[{EMOJI}]+')('text')} AS text FROM u"
    out["emoji_first"] = (
        f"WITH {U} SELECT {KEYS}, emoji FROM (SELECT *, regexp_extract(text, {q(f'[{EMOJI}]')}) AS emoji FROM u) s WHERE emoji <> ''"
    )
    out["repost_split"] = f"WITH {U}, {PARTS} SELECT {KEYS}, CAST(part AS INTEGER) AS part, text FROM parts"
    out["vote_drop"] = f"WITH {U}, {PARTS}, {VOTES} SELECT {KEYS}, CAST(part AS INTEGER) AS part, text FROM voted"
    out["uniform_sessions"] = f"WITH {U} SELECT {SESSION} FROM u GROUP BY {SESSION} HAVING count(DISTINCT text) < 2"
    out["uniform_drop"] = (
        f"WITH {U} SELECT {KEYS}, text FROM u SEMI JOIN (SELECT {SESSION} FROM u GROUP BY {SESSION} "
        f"HAVING count(DISTINCT text) >= 2) k USING ({SESSION})"
    )
    # lexicons
    out["lexicon_load"] = f"WITH {BLACK} SELECT word, ord FROM black"
    out["lexicon_first_n"] = f"WITH {BLACK} SELECT word, ord FROM black WHERE ord < 25"
    out["special_topic"] = (
        f"WITH {U}, {TOPIC} SELECT {KEYS}, min_by(word, ord) AS topic FROM u JOIN topic ON contains({tight('text')}, word) GROUP BY {KEYS}"
    )
    out["substring_first"] = (
        f"WITH {U}, {BLACK} SELECT {KEYS}, min_by(word, ord) AS word FROM u JOIN black ON contains(text, word) GROUP BY {KEYS}"
    )
    out["substring_set"] = (
        f"WITH {U}, {BLACK} SELECT {KEYS}, string_agg(word, '|' ORDER BY ord) AS words FROM u JOIN black ON contains(text, word) GROUP BY {KEYS}"
    )
    out["alternation_last"] = (
        f"WITH {U}, {TOPIC}, alt AS (SELECT string_agg(word, '|' ORDER BY ord) AS p FROM topic) "
        f"SELECT {KEYS}, hits[-1] AS word FROM (SELECT {KEYS}, regexp_extract_all(text, (SELECT p FROM alt)) AS hits FROM u) s WHERE len(hits) > 0"
    )
    out["substring_hits"] = (
        f"WITH RECURSIVE {U}, {BLACK}, {removal('u')} SELECT {KEYS}, CAST(fin AS INTEGER) AS fin, word FROM occ"
    )
    out["large_lexicon"] = (
        f"WITH {U}, big AS MATERIALIZED ({lexicon_sql('documents', LETTERS + '{9,}')}), "
        f"places AS (SELECT {KEYS}, unnest(list_transform(range(1, length(text) - 7), lambda i: substr(text, i, 64))) AS ahead FROM u), "
        f"found AS (SELECT {KEYS}, word FROM places JOIN big ON left(ahead, 9) = left(word, 9) AND starts_with(ahead, word)) "
        f"SELECT {KEYS}, count(*) AS hits, count(DISTINCT word) AS words, min(lpad(CAST(1000 - length(word) AS VARCHAR), 4, '0') || word)[5:] AS longest FROM found GROUP BY {KEYS}"
    )
    out["unspaced_words"] = f"""
WITH RECURSIVE tokens AS (SELECT unnest({tokens("text")}) AS word FROM conversations),
counted AS (SELECT word, count(*) AS n, sum(count(*)) OVER () AS total FROM tokens GROUP BY word),
dict AS MATERIALIZED (SELECT word, length(word) AS size, CAST(round(ln(CAST(total AS DOUBLE) / n) * 1000) AS BIGINT) AS cost FROM counted),
unseen AS (SELECT CAST(round(ln(CAST(10 * count(*) AS DOUBLE)) * 1000) AS BIGINT) AS cost FROM tokens),
texts AS MATERIALIZED (SELECT conv_id, turn, {tight("text")} AS t FROM conversations),
runs AS (SELECT conv_id, turn, unnest(string_split_regex(t, '\\s+')) AS run, generate_subscripts(string_split_regex(t, '\\s+'), 1) AS k FROM texts),
edges AS MATERIALIZED (
  SELECT DISTINCT run, i + size - 1 AS fin, size, cost
  FROM (SELECT run, i, unnest(range(1, least((SELECT max(size) FROM dict), length(run) - i + 1) + 1)) AS size0, substr(run, i, size0) AS word
        FROM (SELECT run, unnest(range(1, length(run) + 1)) AS i FROM (SELECT DISTINCT run FROM runs) d) p) s JOIN dict USING (word)
  UNION ALL
  SELECT DISTINCT run, unnest(range(1, length(run) + 1)), 1, (SELECT cost FROM unseen) FROM runs
),
walk AS (
  SELECT DISTINCT run, 0 AS i, [[0, 0, 0]::BIGINT[]] AS best FROM runs
  UNION ALL
  SELECT w.run, w.i + 1, list_append(any_value(w.best), min([w.best[w.i + 2 - e.size][1] + e.cost, w.best[w.i + 2 - e.size][2] + 1, -e.size]))
  FROM walk w JOIN edges e ON e.run = w.run AND e.fin = w.i + 1 GROUP BY w.run, w.i
),
paths AS MATERIALIZED (SELECT run, i, best FROM walk WHERE i = length(run)),
back AS (
  SELECT run, best, i AS fin, i + best[i + 1][3] AS start FROM paths WHERE i > 0
  UNION ALL
  SELECT run, best, start, start + best[start + 1][3] FROM back WHERE start > 0
),
cut AS (SELECT run, string_agg(substr(run, start + 1, fin - start), '|' ORDER BY fin) AS words FROM back GROUP BY run)
SELECT conv_id, turn, coalesce(string_agg(words, '|' ORDER BY k), '') AS words FROM runs LEFT JOIN cut USING (run) GROUP BY conv_id, turn"""
    listed = f"SELECT {KEYS}, list(word ORDER BY fin, -length(word)) AS words FROM occ GROUP BY {KEYS}"
    out["substring_remove"] = (
        f"WITH RECURSIVE {U}, {BLACK}, {removal('u')}, l AS MATERIALIZED ({listed}) "
        f"SELECT u.dataset, u.file_id, u.session_id, u.turn, list_reduce(words, lambda a, w: replace(a, w, ''), text) AS text, "
        f"words[-1] AS black_word FROM u JOIN l USING ({KEYS}) "
        f"UNION ALL SELECT u.dataset, u.file_id, u.session_id, u.turn, text, NULL FROM u ANTI JOIN l USING ({KEYS})"
    )
    out["word_blacklist"] = (
        f"WITH {U}, {TOKENS}, w AS (SELECT {KEYS}, unnest(tk) AS word, unnest(range(len(tk))) AS pos FROM (SELECT {KEYS}, {tokens('text')} AS tk FROM u) s) "
        f"SELECT {KEYS}, min_by(word, pos) AS word FROM w SEMI JOIN bad USING (word) GROUP BY {KEYS}"
    )
    # fixed values: tokens that are tolerated without being English words
    tolerated = ["l", ".", "W", "t", "o", "z", "k", "C", "B", "y", "/", "w", "a", "s", "h", "x", "_", "n", "g", "i", "d", "e"]
    extra = ", ".join(map(q, tolerated))
    out["alpha_noise"] = (
        f"WITH {U}, {ENGLISH}, w AS (SELECT {KEYS}, unnest(tk) AS word, unnest(range(len(tk))) AS pos FROM (SELECT {KEYS}, {tokens('text')} AS tk FROM u) s) "
        f"SELECT {KEYS}, min_by(w.word, pos) AS word FROM w ANTI JOIN english e ON lower(w.word) = e.word "
        f"WHERE regexp_full_match(w.word, '[A-Za-z]+') AND w.word NOT IN ({extra}) GROUP BY {KEYS}"
    )
    out["confused_word"] = (
        f"WITH {U}, {TOPIC}, w AS (SELECT {KEYS}, unnest(tk) AS word, unnest(range(len(tk))) AS pos FROM (SELECT {KEYS}, {tokens('text')} AS tk FROM u) s) "
        f"SELECT {KEYS}, min_by(w.word, pos) AS word FROM w JOIN topic c ON contains(w.word, c.word) GROUP BY {KEYS}"
    )
    out["word_repetition"] = f"""
WITH {U}, w AS (SELECT {KEYS}, unnest({tokens("text")}) AS word FROM u),
f AS (SELECT {KEYS}, word, count(*) AS n FROM w GROUP BY {KEYS}, word),
r AS (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY n DESC) AS rn FROM f),
g AS (SELECT {KEYS}, sum(n) AS total, count(*) AS d, sum(n) FILTER (rn <= 3) AS top3 FROM r GROUP BY {KEYS})
SELECT {KEYS} FROM g WHERE d * 3 <= total OR (d > 3 AND d < total AND top3 * 4 > total * 3)"""
    out["tokenised"] = f"WITH {U} SELECT {KEYS}, array_to_string({tokens('text')}, ' ') AS text FROM u"
    # sessions
    out["segment_sessions"] = f"WITH {T}, {segments('t')} SELECT {SEG_KEY}, turn, text FROM seg"
    out["segment_lines"] = (
        f"WITH {T}, {segments('t')} SELECT {SEG_KEY}, string_agg(regexp_replace(text, '[\\n\\r]', ' ', 'g'), chr(9) || chr(9) ORDER BY turn) AS line FROM seg GROUP BY {SEG_KEY}"
    )
    placed = f"SELECT *, row_number() OVER (PARTITION BY {SEG_KEY} ORDER BY turn, part) - 1 AS place, count(*) OVER (PARTITION BY {SEG_KEY}) AS n, regexp_replace(text, '[\\n\\r]', ' ', 'g') AS flat FROM seg"
    out["cleaned_files"] = (
        f"WITH {T}, {segments('t')} SELECT CASE WHEN n > 6 THEN turn ELSE place END AS turn, CASE WHEN n > 6 THEN text ELSE flat END AS text, count(*) AS lines FROM ({placed}) s GROUP BY ALL"
    )
    out["jsonl_files"] = (
        f"WITH {T}, {segments('t')} SELECT 'dataset=' || dataset AS dataset, place AS turn, flat AS text, count(*) AS lines FROM ({placed}) s GROUP BY ALL"
    )
    out["dialogue_files"] = (
        "SELECT CASE conv_id % 2 WHEN 0 THEN 'even' ELSE 'odd' END AS dataset, place AS turn, text, count(*) AS lines "
        "FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS place FROM conversations) s GROUP BY ALL"
    )
    out["instances_files"] = (
        f"SELECT place AS session_id, {strip('text')} AS text FROM (SELECT text, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id, text) - 1 AS place FROM documents) s WHERE {strip('text')} <> ''"
    )
    out["multi_turn_segments"] = (
        f"WITH {T}, {segments('t')} SELECT {SEG_KEY}, turn, text FROM (SELECT *, count(*) OVER (PARTITION BY {SEG_KEY}) AS n FROM seg) s WHERE n > 1"
    )
    out["short_response_trim"] = f"""
WITH {T}, {segments("t")},
ok AS (SELECT {SEG_KEY}, max(turn) AS last_ok FROM seg WHERE length({tight("text")}) >= 2 GROUP BY {SEG_KEY})
SELECT s.dataset, s.file_id, s.session_id, s.segment, s.turn, s.text FROM seg s JOIN ok USING ({SEG_KEY}) WHERE s.turn <= ok.last_ok"""
    out["rename_names"] = f"""
WITH {U}, {NAMES},
w AS (SELECT {KEYS}, unnest(tk) AS word, unnest(range(len(tk))) AS pos FROM (SELECT {KEYS}, {tokens("text")} AS tk FROM u) s),
f AS (SELECT {SESSION}, word, min((turn, pos)) AS first FROM w SEMI JOIN names USING (word) GROUP BY {SESSION}, word),
k AS (SELECT *, row_number() OVER (PARTITION BY {SESSION} ORDER BY first) AS k FROM f),
j AS (SELECT w.*, k.k FROM w LEFT JOIN k USING (dataset, file_id, session_id, word))
SELECT u.dataset, u.file_id, u.session_id, u.turn, coalesce(x.text, '') AS text
FROM u LEFT JOIN (SELECT {KEYS}, string_agg(CASE WHEN k IS NULL THEN word ELSE '<NAME' || k || '>' END, ' ' ORDER BY pos) AS text FROM j GROUP BY {KEYS}) x USING ({KEYS})"""
    # corpus
    seg = f"{T}, {segments('t')}"
    out["ad_responses"] = f"WITH {seg}, {ADS} SELECT text, contexts FROM ads"
    out["ad_ranking"] = (
        f"WITH {seg}, {ADS} SELECT text, contexts FROM ads ORDER BY contexts DESC, text"
    )
    flagged_ads = "flagged AS MATERIALIZED (SELECT n.*, a.text IS NOT NULL AS hit FROM numbered n LEFT JOIN ads a ON n.text = a.text)"
    out["ad_cut"] = f"WITH RECURSIVE {seg}, {ADS}, {NUMBERED}, {flagged_ads}, {_cuts('flagged', 2)}"
    out["trigram_counts"] = f"WITH {seg}, {NUMBERED}, {TRIGRAMS} SELECT trigram, responses FROM tri"
    out["generic_trigrams"] = (
        f"WITH {seg}, {NUMBERED}, {TRIGRAMS} SELECT trigram, responses FROM tri WHERE responses > {GENERIC_MIN}"
    )
    generic = f"""
own AS MATERIALIZED (SELECT {SEG_KEY}, i, trigram, len, count(*) AS c FROM (
  SELECT {SEG_KEY}, i, length({tight("text")}) AS len,
         unnest(list_transform(range(1, length({tight("text")}) - 1), lambda k: substr({tight("text")}, k, 3))) AS trigram FROM numbered) s GROUP BY ALL),
gen AS MATERIALIZED (SELECT DISTINCT {SEG_KEY}, i FROM own SEMI JOIN (SELECT trigram FROM tri WHERE responses > {GENERIC_MIN}) g USING (trigram) WHERE c * 3 * 10 > 9 * len),
flagged AS MATERIALIZED (SELECT n.*, g.i IS NOT NULL AS hit FROM numbered n LEFT JOIN gen g USING ({SEG_KEY}, i))"""
    out["generic_cut"] = f"WITH RECURSIVE {seg}, {NUMBERED}, {TRIGRAMS}, {generic}, {_cuts('flagged', 1)}"
    # audit
    out.update(_audit_oracles())
    # statistics
    out["corpus_statistics"] = f"WITH {U} {stats('u', 'dataset')}"
    out["raw_statistics"] = (
        "WITH c AS (SELECT 'chats' AS dataset, 'chats' AS file_id, conv_id AS session_id, turn, 0 AS part, text FROM conversations) "
        + stats("c", "")
    )
    out["mention_sessions"] = (
        f"WITH {U} SELECT {SESSION} FROM (SELECT {SESSION}, string_agg(text, ' ' ORDER BY turn, part) AS s FROM u GROUP BY {SESSION}) x WHERE {has_mention('s')}"
    )
    out["symbol_census"] = f"""
WITH {U}, {SYMBOLS},
s AS (SELECT {SESSION}, string_agg(text, chr(9) || chr(9) ORDER BY turn, part) AS text FROM u GROUP BY {SESSION}),
r AS (SELECT *, regexp_matches(text, '[\\x{{2E80}}-\\x{{2FFF}}]') AS radical FROM s),
c AS (SELECT {SESSION}, radical, unnest(regexp_extract_all(text, '(?s).')) AS word, unnest(range(length(text))) AS pos FROM r),
f AS (SELECT {SESSION}, min_by(word, pos) AS symbol FROM c SEMI JOIN symbols USING (word) GROUP BY {SESSION})
SELECT symbol, count(*) AS sessions FROM (
  SELECT CASE WHEN r.radical THEN 'no_emoji' ELSE f.symbol END AS symbol FROM r LEFT JOIN f USING ({SESSION})) z
WHERE symbol IS NOT NULL GROUP BY symbol"""
    out["reconcile"] = """
SELECT 'not_in_result' AS status, doc_id FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) a
UNION ALL SELECT 'not_in_raw', doc_id FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents) b"""
    out["label_counts"] = "SELECT CAST(toxic AS DOUBLE) AS label, count(*) AS texts FROM documents JOIN labels USING (doc_id) GROUP BY toxic"
    out["offensive_by_counts"] = f"""
WITH tok AS MATERIALIZED (SELECT doc_id, toxic, unnest(regexp_extract_all(text, {q(LETTERS + '+')})) AS token
  FROM documents LEFT JOIN labels USING (doc_id)),
w AS MATERIALIZED (SELECT token, count(*) FILTER (toxic = 0) AS c0, count(*) FILTER (toxic = 1) AS c1 FROM tok WHERE toxic IS NOT NULL GROUP BY token),
z AS (SELECT sum(c0) + count(*) AS r0, sum(c1) + count(*) AS r1 FROM w),
odds AS (SELECT ln(count(*) FILTER (toxic = 1) / count(*) FILTER (toxic = 0)) AS o FROM documents JOIN labels USING (doc_id)),
total AS (SELECT doc_id, sum(ln((coalesce(c1, 0) + 1) / r1) - ln((coalesce(c0, 0) + 1) / r0)) AS s FROM tok LEFT JOIN w USING (token), z GROUP BY doc_id)
SELECT doc_id, round(coalesce(s, 0) + o, 6) > 0 AS offensive FROM documents LEFT JOIN total USING (doc_id), odds"""
    # whole job
    basic = f"{U}, {chain(BASIC, 'u')}, {segments('c')}"
    out["clean_basic"] = f"WITH {basic} SELECT {SEG_KEY}, turn, text FROM seg"
    out["clean_basic_statistics"] = f"WITH {basic} {stats('seg', 'dataset', SEG_KEY)}"
    hit_list = f"SELECT {KEYS}, part, list(word ORDER BY fin, -length(word)) AS words FROM occ GROUP BY {KEYS}, part"
    shorter = strip("list_reduce(words, lambda a, w: replace(a, w, ''), text)")
    out["clean_basic_words"] = (
        f"WITH RECURSIVE {U}, {BLACK}, {chain([*BASIC, 'B22'], 'u')}, {removal('c')}, l AS MATERIALIZED ({hit_list}), "
        f"removed AS (SELECT {KEYS}, part, {shorter} AS text FROM c JOIN l USING ({KEYS}, part) "
        f"UNION ALL SELECT {KEYS}, part, text FROM c ANTI JOIN l USING ({KEYS}, part)), {segments('removed')} "
        f"SELECT {SEG_KEY}, turn, text FROM seg"
    )
    # the vote and split steps come first, then the row rules, then segmentation
    full = f"{U}, {PARTS}, {VOTES}, {chain(FULL, 'voted')}, {segments('c')}"
    out["clean_full"] = f"WITH {full} SELECT {SEG_KEY}, turn, CAST(part AS INTEGER) AS part, text FROM seg"
    return out


def _audit_oracles() -> dict[str, str]:
    """Audit of a few rules of each kind, in chain order."""
    ids = ["B0", "B1", "C1", "B7", "B9", "C2", "B14", "B18", "B19", "B20", "C5"]
    names = {
        "B1": ("other", "¡ 评论", "orig"), "C1": ("other", "specific_utter", "orig"), "B7": ("emoji", "hashtag", "orig"),
        "B9": ("emoji", "html", "pair"), "C2": ("other", "mention", "orig"), "B14": ("emoji", "emoji", "emoji"),
        "B18": ("other", "de_phone", "pair"), "B19": ("other", "de_qq", "pair"), "B20": ("other", "cleantext", "pair"),
        "C5": ("other", "short", "orig"),
    }
    parts = []
    for i, rid in enumerate(ids):
        if rid not in names:
            continue
        category, reason, kind = names[rid]
        before, after = "a.orig", "CAST(NULL AS VARCHAR)"
        if kind == "pair":
            before, after = "a.text", "b.text"
        if kind == "emoji":
            before = f"regexp_extract(a.text, {q(f'[{EMOJI}*#]+')}) || ': ' || a.orig"
        parts.append(
            f"SELECT a.dataset, a.file_id, a.session_id, a.turn, {q(category)} AS category, {q(reason)} AS reason, "
            f"{before} AS before, {after} AS after FROM c_{i} a JOIN c_{i + 1} b USING ({KEYS}) WHERE length(b.text) < length(a.text)"
        )
    base = f"WITH {U}, {chain(ids, 'u')}, audit AS ({' UNION ALL '.join(parts)})"
    return {
        "audit_entries": f"{base} SELECT {KEYS}, category, reason, before, after FROM audit",
        "audit_files": f"{base} SELECT category, reason, count(*) AS entries FROM (SELECT DISTINCT dataset, file_id, category, reason, before, after FROM audit) d GROUP BY category, reason",
        "audit_counts": f"{base} SELECT category, reason, count(*) AS utterances FROM (SELECT DISTINCT category, reason, before, after FROM audit) d GROUP BY category, reason",
        "audit_deltas": f"{base} SELECT {KEYS}, category, reason, length(before) AS len_before, length(after) AS len_after, length(before) - length(after) AS removed FROM audit WHERE after IS NOT NULL",
        "word_counts": (
            f"WITH RECURSIVE {U}, {BLACK}, {removal('u')}, l AS MATERIALIZED (SELECT {KEYS}, max_by(word, fin * 1000 - length(word)) AS word FROM occ GROUP BY {KEYS}) "
            f"SELECT word, count(DISTINCT text) AS utterances FROM l JOIN u USING ({KEYS}) GROUP BY word"
        ),
        "word_utterances": (
            f"WITH RECURSIVE {U}, {BLACK}, {removal('u')}, l AS MATERIALIZED (SELECT {KEYS}, max_by(word, fin * 1000 - length(word)) AS word FROM occ GROUP BY {KEYS}) "
            f"SELECT DISTINCT dataset, file_id, word, text AS utterance FROM l JOIN u USING ({KEYS})"
        ),
    }
