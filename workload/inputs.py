"""Input views of the registered queries.

The test tables hold few of the things the rules look for, so every utterance gets a trigger by
its position.  Both engines evaluate the same SQL text for the *input*; rule logic is never
shared.  All rows of ``conversations`` and ``documents`` take part, whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuswash.plans.scale import spread

# (prefix, suffix) per trigger; None replaces the text
_TRIGGERS: list[tuple[str, str] | str] = [
    ("回复 @bob: ", ""),
    ("", " http://a.example.com/x?y=1 ok"),
    ("#tag# ", ""),
    ("x13800138000y ", ""),
    ("QQ12345678, ", ""),
    "转发",
    ("胶片，很珍贵！🐹", ""),
    ("哈哈哈哈哈哈哈", ""),
    ("", "//@Ann: 也快//@Tom: 你也快来表态吧"),
    "a",
    ("谁tM跟你", " TM "),
    ("［酷］ [doge] ", ""),
    (":smile: ", ""),
    ("<b>x ", " <br />"),
    ("@amy hi ", ""),
    ("", " @short"),
    ("一@@bob ann : ", ""),
    ("", " //@Bob Lee-x : 算我一个"),
    ("", "… 显示全部 "),
    ("哈哈 sda83daj.jp 哈哈", ""),
    ("[图片]", "{ }我擦\u200b"),
    ("", " http://t.cn/AbC123 "),
    ("alink", "¡ 评论 12"),
    ("", "ok :::  : fine"),
    ("a\tb\u00a0c\u0007d\ufffd", ""),
    ("mail me foo.bar@mail.example.com or +86 138-0013-8000 “now” ", ""),
    ("<angle tag> ", " <中文>"),
    "to to to to to to be or to to to",
    ("", " 【广告】"),
    "repost weibo",
    ("(www.suzastampin.com)卡尔 ", ""),
    "  ",
    "你好吗",
    "abcabcabcabcabc  ababababab",
    "one two two two two two three three four",
]
_CYCLE = len(_TRIGGERS) + 5


def _inject(k: str, text: str) -> str:
    cases = []
    for i, t in enumerate(_TRIGGERS):
        value = f"'{t}'" if isinstance(t, str) else f"concat('{t[0]}', {text}, '{t[1]}')"
        cases.append(f"WHEN {i} THEN {value}")
    return f"CASE ({k}) % {_CYCLE} {' '.join(cases)} ELSE {text} END"


# chats: one session per conversation; docs: threads of ten documents
UTTERANCES_SQL = f"""
SELECT 'chats' AS dataset,
       CASE conv_id % 3 WHEN 0 THEN 'weibo_tang_chats' WHEN 1 THEN 'zhihu_chats' ELSE 'forum_chats' END AS file_id,
       conv_id AS session_id, turn AS turn, 0 AS part,
       CASE WHEN conv_id % 9 = 4 THEN 'the same words in every turn' ELSE {_inject("conv_id * 8 + turn", "text")} END AS text
FROM conversations
UNION ALL
SELECT 'docs' AS dataset,
       CASE (doc_id - doc_id % 10) % 30 WHEN 0 THEN 'weibo_tang_docs' WHEN 10 THEN 'zhihu_docs' ELSE 'forum_docs' END AS file_id,
       doc_id - doc_id % 10 AS session_id, doc_id % 10 AS turn, 0 AS part,
       {_inject("doc_id", "text")} AS text
FROM documents
"""

AD_TEXT = "Buy two garden hoses now and get the third one free of charge"
GENERIC_TEXT = "lol lol lol lol lol"

# sessions with an advertisement in turns 1 and 3 of every fifth session, a generic reply in
# turn 2 of every fourth, and emptied turns every seventh position
THREADS_SQL = f"""
SELECT dataset, file_id, session_id, turn, part,
       CASE WHEN (session_id + turn) % 7 = 6 THEN ''
            WHEN session_id % 5 = 0 AND turn IN (1, 3, 6, 7) THEN '{AD_TEXT}'
            WHEN session_id % 4 = 0 AND turn IN (2, 5) THEN '{GENERIC_TEXT}'
            WHEN (session_id + turn) % 11 = 3 THEN 'x'
            ELSE text END AS text
FROM (
  SELECT 'chats' AS dataset, 'chats' AS file_id, conv_id AS session_id, turn AS turn, 0 AS part, text FROM conversations
  UNION ALL
  SELECT 'docs' AS dataset, 'docs' AS file_id, (doc_id - doc_id % 10) / 10 AS session_id, doc_id % 10 AS turn, 0 AS part, text
  FROM documents
) src
"""
THREADS_SQL = THREADS_SQL.replace("(doc_id - doc_id % 10) / 10 AS", "CAST((doc_id - doc_id % 10) / 10 AS BIGINT) AS")



_KEYS = {"conversations": ["conv_id", "turn"], "documents": ["doc_id"]}


def register(spark: SparkSession, sf_dir: str) -> None:
    for table, key in _KEYS.items():
        path = f"{sf_dir}/{table}.parquet"
        spread(spark.read.parquet(path), path, key).createOrReplaceTempView(table)


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(UTTERANCES_SQL)


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(THREADS_SQL)
