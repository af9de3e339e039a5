"""Main text: planted pages of several kinds, votes across a host, broken markup, odd rows."""

import random

import pytest

from corpuswash.llm import html_text
from corpuswash.llm.html_text import Page, main_text

LONG = "This sentence is long enough to be a real paragraph, with a comma in it. " * 3
LINE = LONG.strip()


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<article><h1>A &amp; B</h1><p>x&nbsp;y<br>z<p>a<b>b</b>c</article><footer>f</footer>", "A & B x y z abc"),
        (f"<body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><main><h1>T</h1><p>{LONG}</p></main><aside>{LONG}</aside></body>", f"T {LINE}"),
        (f"<div class='page with-sidebar'><div id=sidebar>{LONG}{LONG}</div><div id=content><h1>T</h1><p>{LONG}<p>{LONG}</div></div>", f"T {LINE} {LINE}"),
        (f"<article><header><h1>T</h1></header><section><p>{LONG}</section><section><p>short</section><div class='ad'>Buy</div><footer>by me</footer></article><section class=comments><article><p>{LONG}{LONG}{LONG}</article></section>", f"T {LINE} short"),
        (f"<form action=x><div class=post-body><h1>T</h1><p>{LONG}</p></div><input name=q><button>Go</button></form>", f"T {LINE}"),
        (f"<div class=cookie-notice role=dialog><p>{LONG}{LONG}</div><div class=story><p>{LONG}</p><form><p>Sign up</form></div>", LINE),
        (f"<article><p>{LONG}</p><script>var a='</p><p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --><noscript><p>no</noscript><p hidden>no</p><div style='display: none'>no</div></article>", LINE),
        (f"<article><p>{LONG}<a href='x>y'>link</a> 1 < 2 &lt;b&gt; &#x41;&eacute;</p></article>", f"{LINE} link 1 < 2 <b> Aé"),
        (f"<table><tr><td><a href=1>m</a><td><p>{LONG}<p>{LONG}</table>", f"{LINE} {LINE}"),
        (f"<article class=commentary><h1>T</h1><p>{LONG}</p></article>", f"T {LINE}"),
        (f"<article><p>{LONG}</p><ul><li>one<li>two<ul><li>three</ul><li>four</ul></article>", f"{LINE} one two three four"),
        ("<article></article><p>Only this.</p>", "Only this."),
        ("just text &copy; here", "just text © here"),
        ("<p>open <b>and <i>never closed", "open and never closed"),
        ("<article><p>a</p></article", "a"),
        ("<article><p>tail <a href='x", "tail"),
        ("", ""),
        (None, ""),
        ("<!-- only a comment", ""),
        ("<nav>menu</nav>", ""),
    ],
)
def test_pages(source, want):
    assert main_text(source) == want


def test_deep_wide_and_hostile_markup():
    deep = "<div>" * 20_000 + LONG + "</div>" * 20_000
    assert main_text(deep) == LINE
    assert max(len(n.path) for n in Page(deep).nodes) < 400
    assert main_text("</section>" * 50_000 + f"<p>{LONG}") == LINE
    assert main_text(f"<article>{'<p>w' * 50_000}</article>") == " ".join(["w"] * 50_000)
    assert main_text("<" * 50_000 + "a") is not None
    assert main_text("<a title=\"" * 3000 + LONG) is not None
    rng = random.Random(5)
    for _ in range(300):
        main_text("".join(rng.choice(["<p>", "</p>", "<div class=a1>", "</div>", "<", ">", "'", '"', "&", "x ", "<!--", "-->", "<script>", "</script>", "<li>", "<td>", "</table>", "<article>"]) for _ in range(80)))


def page(article, comments):
    return f"<html><body><div class='c{len(article) % 7}x'><div class=b1><p>{article}</p></div><div class=b2><p>{comments}</p></div></div></body></html>"


def test_the_host_decides(spark):
    """Unmarked comments outweigh the article on some pages; the other pages of the host tell where the article stands."""
    def doc(i):
        return f"Article number {i} says {LINE}"

    rows = [(i, f"http://A.example.com/{i}", f"<body><div class=m><p>{doc(i)}</p></div><div class=k><p>{'Reader says ' + LONG * (6 if i % 5 == 0 else 0)}</p></div></body>") for i in range(20)]
    rows += [(100 + i, f"http://b.example.com/{i}?x", f"<body><div class='t-{i}'><p>{doc(i)}</p></div></body>") for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    got = {r["id"]: r for r in html_text.extract(df).collect()}
    assert all(got[i]["text"] == doc(i) for i in range(20))
    assert all(got[100 + i]["text"] == doc(i) for i in range(4))
    assert main_text(rows[0][2]) != doc(0)  # alone, the page is misread
    won = {r["host"]: [(p["path"], p["votes"]) for p in r["paths"]] for r in html_text.consensus(df).collect()}
    assert won["a.example.com"][0][1] == 16 and won["b.example.com"] == [("/body/div.t-0", 4)]


def test_many_paths_of_one_host_are_ranked_whole(spark):
    rows = [(f"http://h.org/{i}", f"<body><div class={'x' * (1 + i % 90)}><p>{LONG}</div></body>") for i in range(200)]
    got = html_text.consensus(spark.createDataFrame(rows, "url string, html string")).first()["paths"]
    assert len(got) == 16
    assert [(-p["votes"], p["path"]) for p in got] == sorted([(-3 if n <= 20 else -2, f"/body/div.{'x' * n}") for n in range(1, 91)])[:16]


def test_odd_rows(spark):
    rows = [(None, None, None, "t"), (1, "no host", f"<p>{LONG}", None), (1, "no host", f"<p>{LONG}", None), (2, "http://x/", "", "t"), (3, "http://x/", "<p>" + "long " * 300_000, "t"), (4, "http://X?q", "<p>y", "t")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, text string")
    got = sorted((r["id"] or 0, r["url"] or "", len(r["text"]), r["n_chars"]) for r in html_text.extract(df).collect())
    assert got == [(0, "", 0, 0), (1, "no host", len(LINE), len(LINE)), (1, "no host", len(LINE), len(LINE)), (2, "http://x/", 0, 0), (3, "http://x/", 1_499_999, 1_499_999), (4, "http://X?q", 1, 1)]
    assert html_text.extract(df.limit(0)).collect() == []
