"""Main text of web pages by consensus host paths.

Three steps: every page's containers are scored by the running text they hold, and the page votes for the path of its best
one; Spark adds up the votes per host; every page is extracted again from the containers at the path that has most votes
of its host among those the page holds.  A page whose reader comments outweigh its article is thus read where the other
pages of its host hold theirs.  A path is the list of tags with their classes and ids from the root, digits folded.

Menus, headers, footers, side columns, notices, adverts, forms, scripts, styles and reader comments are recognised by tag,
role, class or id and left out of scores and texts; an element that holds the page's main heading is a frame, not one of
these.  A ``header`` inside the article stays if it holds a heading.

Defined results: null html is empty, an empty page gives an empty text; pages without a host vote for none and follow their
own best container; without any container the text of the whole body counts; equal votes go to the higher own score, then
to the smaller path; repeated rows vote and are returned each; an empty table gives an empty result; extra columns are
not read.  Nothing is cut: white space runs become one space, blocks are joined by one space.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuswash.llm.common import prepare, slices
from corpuswash.plans.scale import lookup_join

#: Paths kept per host; parts into which the paths of one host are dealt before they are ranked; longest path.
PATHS, SALTS, DEPTH = 16, 64, 32

# fixed values: names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
RAW = frozenset("script style title noscript template textarea iframe noframes svg math object canvas audio video select".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | frozenset("p pre blockquote li td th dd dt figcaption caption address summary".split())
#: A start tag of the first kind closes an open element of the second kind, unless one of the third kind lies between.
CLOSES = {
    **dict.fromkeys("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split(), ("p", ())),
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
}
# words that mark what does not belong to an article
BESIDE_TAGS = frozenset("nav footer aside form button dialog menu fieldset".split())
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
BESIDE_WORDS = frozenset("ad ads adv adbox adslot nav menu menus topbar share sharing social login signin signup search form forms notice notices alert alerts banner promo promos promotion widget widgets reply replies respond responses feedback guestbook skip consent gdpr paywall popover overlay pager crumbs teaser teasers hidden".split())
BESIDE_PARTS = ("advert", "sidebar", "comment", "cookie", "newsletter", "navbar", "navigation", "breadcrumb", "footer", "sponsor", "disqus", "popup", "modal", "subscri", "pagination", "related", "recommend", "toolbar", "masthead", "notification", "discussion", "menubar")
ARTICLE_WORDS = frozenset("article post entry story content main body text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/>\"']+)")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")


class Node:
    """An element: its events are ``page.events[first:last]``."""

    __slots__ = ("beside", "first", "gone", "heading", "last", "links", "main", "name", "own", "parent", "path", "score", "story", "weight")

    def __init__(self, name: str, parent: Node | None, path: str, first: int, beside: str, weight: float) -> None:
        self.name, self.parent, self.path, self.first, self.beside, self.weight = name, parent, path, first, beside, weight
        self.last = self.own = self.links = 0
        self.score = 0.0
        self.main = self.story = self.heading = self.gone = False


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        name = (m[1] or m[5]).lower()
        out.setdefault(name, next((x for x in (m[2], m[3], m[4]) if x is not None), ""))
    return out


def _beside(name: str, at: dict[str, str], inside: bool) -> tuple[str, float]:
    """Why the element may not belong to the article ('' if it may), and its weight as a container."""
    weight = {"article": 1.5, "main": 1.3, "body": 0.6, "html": 0.3}.get(name, 1.0)
    if "hidden" in at or at.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", at.get("style", "")):
        return "hidden", weight
    if name in BESIDE_TAGS:
        return ("form" if name in ("form", "fieldset") else "always"), weight
    if name in ("html", "body", "main"):
        return "", weight
    if name == "header":
        return ("heading" if inside else "always"), weight
    if at.get("role", "").lower() in BESIDE_ROLES:
        return "words", weight
    label = f"{at.get('class', '')} {at.get('id', '')}"
    words = {w.lower() for w in _WORD.findall(label)} if label != " " else set()
    if words & ARTICLE_WORDS:
        weight *= 1.25
    low = label.lower()
    if words & BESIDE_WORDS or any(x in low for x in BESIDE_PARTS):
        return "words", weight
    if not inside and ({"header", "head"} & words) and not words & ARTICLE_WORDS:
        return "header", weight
    return "", weight


class Page:
    """Elements and texts of one page, in one pass over its tokens; unclosed and stray tags do no harm."""

    def __init__(self, source: str) -> None:
        self.events: list[str] = []  # texts as they stand in the source; "" is a block border
        self.nodes = [Node("", None, "", 0, "", 0.3)]
        self._stack, self._open = [self.nodes[0]], Counter({"": 1})
        at, linked = 0, False
        size = len(source)
        while at < size:
            m = _TOKEN.search(source, at)
            if m is None:
                self._text(source[at:], linked)
                break
            if m.start() > at:
                self._text(source[at : m.start()], linked)
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                continue
            name = name.lower()
            if m[1] or m[4]:
                if name == "a":
                    linked = False
                self._close(name)
                continue
            if name in RAW:
                if not m[0].endswith("/>"):
                    end = _RAW_END[name].search(source, at)
                    at = end.end() if end else size
                if name not in INLINE:
                    self.events.append("")
                continue
            if name == "a":
                linked = True
            elif name not in INLINE:
                linked = False
            self._start(name, m[3] or m[6] or "")
        while self._stack:
            self._pop()

    def _text(self, raw: str, linked: bool) -> None:
        self.events.append(raw)
        n = len(raw) if not raw.isspace() else 0
        self._stack[-1].own += n
        if linked:
            self._stack[-1].links += n

    def _start(self, name: str, raw: str) -> None:
        if name in VOID:
            if name in ("br", "hr"):
                self.events.append("")
            return
        if name in CLOSES:
            shut, wall = CLOSES[name]
            self._shut(shut.split(), wall)
        if name in ("html", "body") and self._open[name]:
            return
        attributes = _attributes(raw) if raw.strip(" /\n\t") else {}
        inside = bool(self._open["article"] or self._open["main"])
        beside, weight = _beside(name, attributes, inside) if attributes or name not in INLINE else ("", 1.0)
        if name in INLINE and not beside:
            return
        if name not in INLINE:
            self.events.append("")
        top = self._stack[-1]
        label = "".join(f".{_DIGITS.sub('0', c)}" for c in sorted(set(attributes.get("class", "").split()))) + "".join(f"#{_DIGITS.sub('0', c)}" for c in attributes.get("id", "").split())
        above = top.path if top.path.count("/") < DEPTH else xxhash.xxh64_hexdigest(top.path.encode("utf-8", "surrogatepass"))
        node = Node(name, top, f"{above}/{name}{label}", len(self.events), beside, weight)
        self.nodes.append(node)
        self._stack.append(node)
        self._open[name] += 1
        for mark, found in (("main", name in ("h1", "main")), ("story", name == "article" and not beside), ("heading", name in HEADINGS)):
            up = node.parent if found else None
            while up is not None and not getattr(up, mark):
                setattr(up, mark, True)
                up = up.parent

    def _pop(self) -> None:
        node = self._stack.pop()
        self._open[node.name] -= 1
        node.last = len(self.events)
        if node.name not in INLINE:
            self.events.append("")

    def _shut(self, names: list[str], wall: tuple[str, ...]) -> None:
        if not any(self._open[n] for n in names):
            return
        depth = len(self._stack) - 1
        # a paragraph ends at the next block; other elements end only inside their list or table row
        while depth and self._stack[depth].name not in names:
            if self._stack[depth].name in wall or (not wall and self._stack[depth].name not in INLINE):
                return
            depth -= 1
        while len(self._stack) > max(depth, 1):
            self._pop()

    def _close(self, name: str) -> None:
        if name in VOID or not self._open[name]:
            if name in ("br", "p"):
                self.events.append("")
            return
        while self._stack[-1].name != name:
            self._pop()
        self._pop()

    def _gone(self, node: Node) -> bool:
        """An element that is no part of an article, unless it frames the page's main part."""
        kind = node.beside
        if not kind:
            return False
        if kind == "form":
            return not (node.main or node.story)
        if kind == "header":
            return not node.story
        if kind == "heading":
            return not node.heading
        return kind in ("always", "hidden") or not node.main

    def judge(self) -> list[Node]:
        """Score all containers; those with a score, best first."""
        self.cut: list[tuple[int, int]] = []
        for node in self.nodes:
            if node.parent is not None and node.parent.gone:
                node.gone = True
            elif self._gone(node):
                node.gone = True
                self.cut.append((node.first, node.last))
            if node.gone:
                continue
            text = node.own - node.links
            worth = text if text >= 25 else text * 0.25
            share = 1.0
            up = node.parent if node.name in PARAGRAPHS or node.name in INLINE else node
            for _ in range(3):
                if up is None or not worth:
                    break
                up.score += worth * share
                share -= 0.25
                up = up.parent
        kept = [n for n in self.nodes if n.score > 0 and not n.gone and n.name not in PARAGRAPHS - {"td", "li", "blockquote", "dd"}]
        for n in kept:
            n.score *= n.weight
        return sorted(kept, key=lambda n: (-n.score, n.path, n.first))

    def best(self) -> Node | None:
        """The container to vote for: the best one, or the article, main part or titled frame around it."""
        found = self.judge()
        if not found:
            return None
        node = found[0]
        around, up = None, node
        while up is not None and up.name not in ("body", "html", ""):
            if up.name == "article" or (up.name == "main" and around is None):
                around = up
            up = up.parent
        if around is not None:
            return around
        up = node
        while not (up.main or up.name in ("body", "html", "")):
            up = up.parent
        if up is not node and up.name not in ("body", "html", "") and len(self.text([up])) <= 1.3 * len(self.text([node])) + 200:
            return up
        return node

    def text(self, nodes: list[Node]) -> str:
        """The texts of the elements in page order, without the parts that are no article; references are decoded."""
        out: list[str] = []
        done = i = 0
        for node in sorted(nodes, key=lambda n: n.first):
            at = max(done, node.first)
            while i < len(self.cut) and self.cut[i][0] < node.last:  # cuts lie apart and in page order
                first, last = self.cut[i]
                if first >= at:
                    out += self.events[at:first]
                    at = last
                i += 1
            out += self.events[at : node.last]
            out.append("")
            done = max(done, node.last)
        return " ".join("".join([html.unescape(x) if "&" in x else x or " " for x in out]).split())


def main_text(source: str | None, paths: list[tuple[str, int]] | None = None) -> str:
    """The article of a page, read at the first of ``paths`` (path, votes) by votes that holds text in it."""
    if not source:
        return ""
    page = Page(source)
    own = page.best()
    if own is None:
        return page.text([page.nodes[0]])
    votes = dict(paths or [])
    votes.setdefault(own.path, 0)
    at: dict[str, list[Node]] = {}
    for n in page.nodes:
        if n.path in votes and n.first < n.last and not n.gone:
            at.setdefault(n.path, []).append(n)
    for path in sorted(at, key=lambda p: (-votes[p], -max(n.score for n in at[p]), p)):
        most = max(n.score for n in at[path])
        text = page.text([n for n in at[path] if n.score >= most / 4 and (most > 0 or path == own.path)])
        if text:
            return text
    return page.text([own])


def host_of(url: Column) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        votes: Counter[tuple[str, str]] = Counter()
        for b in slices(whole):
            for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                best = Page(source).best() if source else None
                if best is not None:
                    votes[host, best.path] += 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in votes], pa.string()), pa.array([k[1] for k in votes], pa.string()), pa.array(list(votes.values()), pa.int64())], ["host", "path", "votes"])


def consensus(pages: DataFrame, url_col: str = "url", html_col: str = "html", most: int = PATHS) -> DataFrame:
    """(host, paths): the paths with most votes of each host, as an array of (path, votes).

    Votes are added up in the task, then by (host, path); the paths of a host are ranked in ``SALTS`` parts first, so that
    a host with very many paths is no single task.
    """
    prepare(pages.sparkSession)
    source = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")).where("host <> ''")
    votes = source.mapInArrow(_votes, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    parts = votes.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)))
    for by in (["host", "salt"], ["host"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("votes"), "path"))
        parts = parts.withColumn("place", place).where(F.col("place") <= most)
    return parts.groupBy("host").agg(F.collect_list(F.struct("path", "votes")).alias("paths"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in slices(whole, 2):
            texts = [main_text(h, [(p["path"], p["votes"]) for p in paths or []]) for h, paths in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row.

    The table of winning paths goes to all tasks if it was measured small; beyond the bound pages and paths meet in a
    shuffle by host and salt.
    """
    winners = consensus(pages, url_col, html_col)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("host"))
    joined = lookup_join(rows, winners, ["host"], "left", ["id", "url"]).select("id", "url", "html", "paths")
    return joined.mapInArrow(_texts, f"id {rows.schema['id'].dataType.simpleString()}, url string, text string, n_chars long")
