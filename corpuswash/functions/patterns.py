"""Fixed values of the cleaning rules, written as Java regular expressions.

Conventions that keep the Java engine on the rules' meaning:

* ``(?d)`` makes ``.`` stop at LF only;
* ``WS`` is Unicode white space, spelled out because Java's ``\\s`` is ASCII;
* ``\\p{Nd}`` is a decimal digit and ``[\\p{L}\\p{N}_]`` a word character;
* where the natural spelling backtracks without bound, an equivalent linear
  spelling stands here and the comment says why both match the same texts.
"""

# ---- fixed values ---------------------------------------------------------

# characters removed by strip(), as text and as the inside of a regex class
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = r"\p{L}\p{N}_"

NO_SPECIFIC = ("repost", "转发", "repostweibo", "分享图片")
DE_SPECIFIC = ("[图片]", "［图片］", "{ n楷体 s14}", "{ }", "{\\1c&H4080FF&}", "我擦", "\u200b")
LINK_MARK = "alink"
COMMENT_MARK = "¡ 评论"
VOTE_MARK = "你也快来表态吧"
REPOST_MARK = "//@"
TITLE_END = "</title>"
SHOWALL_SOURCES = ("zhihu",)
BRACKET_SOURCES = ("weibo_tang",)
ENGLISH_EXTRA = (
    "l", ".", "W", "t", "o", "z", "k", "C", "B", "y", "/", "w", "a", "s", "h", "x", "_", "n", "g", "i", "d", "e",
)
PHONE_MASK = "</PHONE>"
EMAIL_MASK = "</EMAIL>"
MENTION_TAIL = 30
SHORT_LEN = 2
LONG_LEN = 1000
AD_MIN_LEN = 20
AD_MIN_CONTEXTS = 2
GENERIC_MIN_COUNT = 1000
GENERIC_COVER = 0.9

ALPHA_NUM = r" [a-zA-Z0-9.]+ "
HASHTAG = r"(?d)#.*?# *"
EMOTION = r"(?d):.*?: *"
BRACKETS = r"(?d)\[.*?\] *"
BRACKETS_WIDE = r"(?d)［.*?］ *"
BRACKETS_LENTICULAR = r"(?d)【.*?】 *"
ANGLE = r"<[^一-龥]*?>"
MENTION = rf"@+[^{WS}]{{0,30}} "
REPLY = r"(?d)回复 *@.*?: *"
SHOW_ALL = rf"…* *显示全部[{WS}]*"
WEIBO_URL = r"(?:(?:https?:?\/\/|ftp:\/\/|www\p{Nd}{0,3}\.)t\.cn?(\/[a-zA-Z0-9]{0,8})?)"
PHONE = r"\P{Nd}\p{Nd}{11}\P{Nd} "
QQ = r"[qQ]{2,}\p{Nd}{5,12}\P{Nd}"
COLON = rf"[:{WS}]{{4,}}"
TM = r"(?iu)([^a-zA-Z])(tm)([^a-zA-Z])"
HTML = r"(?d)<(.)>.?|<(.*) />"

EMOJI_CLASS = (
    r"\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2500}-\x{2BEF}"
    r"\x{1F926}-\x{1F937}\x{10000}-\x{10FFFF}\x{2640}-\x{2642}\x{2600}-\x{2B55}\x{200D}\x{23CF}\x{23E9}"
    r"\x{231A}\x{FE0F}\x{3030}\*\x{20E3}#"
)
EMOJI = f"[{EMOJI_CLASS}]+"
# the same without the two ASCII characters
PICTOGRAPHS = EMOJI_CLASS.replace(r"\*", "").replace("#", "")

CJK_CLASS = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)
CJK = f"[{CJK_CLASS}]"
RADICALS = r"[\x{2E80}-\x{2FFF}]"

# "@name:" — `@+` followed by lazy non-space, lazy space, colon.  The first colon ends
# the lazy run, so a possessive run over "neither space nor colon" finds the same text.
SINGLE_REPOST = rf"@[^{WS}:]*+[{WS}]*+: *"

# "//@name: rest of line".  The name is at most 30 units of one name character plus an
# optional space; taking each optional space possessively gives the fewest units, so the
# possessive form accepts the same names without the exponential search.
REPOST = rf"(?d)/ ?/? ?@ ?+(?:[{WORD} \-] ?+){{0,30}} ?:.+"

# URL: scheme, user info, then an IP outside the private ranges, a host name or localhost,
# port, path.  The host class is kept as the rule has it: its "\\u00a1-\\uffff" is not a
# Unicode range but the characters \ u 0 a, "1" to "\" and f.  Host labels are possessive
# and bounded (127 labels, 63 hyphens each) so that long hosts cannot exhaust the stack.
_HOST = r"[a-z\\u00a1-\\uffff0-9]"
_TLD = r"[a-z\\u00a1-\\uffff]"
_LABEL = rf"{_HOST}++(?:-{_HOST}++){{0,62}}+"
URL = (
    r"(?iu)(?:^|(?<![A-Za-z0-9\/]))"
    r"(?:(?:https?:?\/\/|ftp:\/\/|www\p{Nd}{0,3}\.))"
    rf"(?:[^{WS}]+(?::[^{WS}]*)?@)?(?:"
    r"(?!(?:10|127)(?:\.\p{Nd}{1,3}){3})"
    r"(?!(?:169\.254|192\.168)(?:\.\p{Nd}{1,3}){2})"
    r"(?!172\.(?:1[6-9]|2\p{Nd}|3[0-1])(?:\.\p{Nd}{1,3}){2})"
    r"(?:[1-9]\p{Nd}?|1\p{Nd}\p{Nd}|2[01]\p{Nd}|22[0-3])"
    r"(?:\.(?:1?\p{Nd}{1,2}|2[0-4]\p{Nd}|25[0-5])){2}"
    r"(?:\.(?:[1-9]\p{Nd}?|1\p{Nd}\p{Nd}|2[0-4]\p{Nd}|25[0-4]))"
    r"|"
    rf"{_LABEL}(?:\.{_LABEL}){{0,126}}(?:\.{_TLD}{{2,}})"
    r"|(?:(localhost)))"
    r"(?::\p{Nd}{2,5})?"
    rf"(?:\/[^\)\]\}}{WS}一-龥]*)?"
)

# text normalisation (own definition): full-width forms to ASCII, curly quotes to straight
WIDE_FROM = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "\u3000‘’“”"
WIDE_TO = "".join(chr(c) for c in range(0x21, 0x7F)) + " ''\"\""
LINE_BREAKS = r"[\n\r\x0b\x0c\x85\u2028\u2029]+"
# a single plain space stays as it is, so it is not matched
SPACES = rf"[{WS}]{{2,}}|[{WS}&&[^ ]]"
# the look-behind starts the mailbox only where its run starts: same matches, linear time
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"
NORMAL_PHONE = r"[+]?[0-9](?:[ -]?[0-9]){6,14}"

# control-character cleaning
CONTROL = r"[\p{C}\x{FFFD}&&[^\t\n\r]]"
BLANKS = r"[\p{Zs}\t\n\r&&[^ ]]"
