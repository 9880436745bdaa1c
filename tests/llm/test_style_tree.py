import html as entities
import re

import pytest

from tallyframe.llm import style_tree as st
from tallyframe.llm.queries import LLM_QUERIES


def pages_of(spark, *pairs):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pairs)], "page_id long, url string, html string")


def texts(spark, *pairs):
    return {r.id: r.text for r in st.extract(pages_of(spark, *pairs)).collect()}


def test_query_on_article_pages(spark):
    d = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in LLM_QUERIES["op3_style_tree"](spark, d).collect()}
    for r in spark.read.parquet(f"{d}/pages.parquet").collect():
        article = r.html[r.html.index("<article>") : r.html.index("</article>")]
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1|article)>", article)]
        want = "\n".join(x for x in parts if x)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-nav">
<header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div>
<main><article><header><h1>Title &amp; more</h1></header><p>One <b>two</b>
 three<br>four&nbsp;five</p><p>Second<p>Third <!-- no --> part
<script>var a = "</p><p>no";</script><form>mail <input name=a></form><div class="ad-box">Buy</div>
<blockquote>Quoted</blockquote><ul><li>a<li>b</ul></article>
<section id="comments"><p>A reader's comment</p></section></main>
<aside>Side</aside><footer>&copy; me</footer></body></html>"""


def test_kinds_of_furniture(spark):
    got = texts(spark, ("http://one.example/a", FULL))[0]
    assert got == "Title & more\nOne two three four five\nSecond\nThird part\nQuoted\na\nb"


def test_style_tree_removes_what_repeats_without_landmarks(spark):
    """No element and no class says what is what: only the tree can."""
    pairs = []
    for i in range(30):
        body = f"<div class=x1><span>Home</span><span>About us</span></div><div class=x2><p>Story {i} of its own</p><p>More {i * 7}</p></div><div class=x3><p>All rights kept</p></div>"
        pairs.append(("https://plain.example.org/p%d" % i, f"<html><body>{body}</body></html>"))
    got = texts(spark, *pairs)
    assert all(got[i] == f"Story {i} of its own\nMore {i * 7}" for i in range(30))
    # Too few pages on a host are no evidence.
    few = texts(spark, *[(u.replace("plain", "few"), h) for u, h in pairs[:3]])
    assert few[0].startswith("HomeAbout us") and few[0].endswith("All rights kept")


def test_an_article_that_repeats_stays(spark):
    page = "<html><body><nav>Menu</nav><article><p>The same words on every page</p></article></body></html>"
    got = texts(spark, *[("http://copies.example/%d" % i, page) for i in range(40)])
    assert set(got.values()) == {"The same words on every page"}


def test_hosts():
    assert st.host_of("https://user@Www.Example.com:80/a?b//c") == "www.example.com"
    assert st.host_of("//x.y/z") == "x.y" and st.host_of(None) == st.host_of("no host") == ""


@pytest.mark.parametrize(
    "html", ["<", "<p", "</", "<p class='", "a < b", "<!-- x", "<script>", "&am;&", "<a <b>c", "</p></p>", "<" * 3000, "<div>" * 3000 + "x"]
)
def test_broken_markup_never_fails(html):
    page = st.Page(html)
    list(page.facts())
    page.main_text(st.StyleTree(None))
    if html == "a < b":
        assert page.blocks == [(0, "a < b")]


def test_odd_rows(spark):
    pages = pages_of(spark, (None, None), ("u", ""), ("http://h/", "plain words"), ("http://h/", "plain words"), ("http://h/", "<p>" + "long words " * 100_000))
    pages = pages.selectExpr("*", "'z' as text", "1 as host")
    got = {r.id: r.text for r in st.extract(pages).collect()}
    assert [got[i] for i in range(4)] == ["", "", "plain words", "plain words"] and len(got[4]) == 1_100_000 - 1
    assert st.extract(pages.limit(0)).count() == 0


def test_spark_and_python_agree_on_hosts(spark):
    urls = ["https://user@Www.Example.com:80/a", "//x.y/z", None, "nohost", "http://h", "HTTP://UP.case/"]
    many = [(u, f"<body><div class=a>same</div><div class=b>{i} own</div></body>") for u in urls for i in range(12)]
    got = texts(spark, *many)
    assert all("same" not in t for t in got.values())


def test_end_tags_of_deep_elements_match():
    deep = "<div><article>" + "<div>" * 500 + "x" + "<nav>menu</nav>" + "</div>" * 500 + "<p>tail</p></article></div>"
    page = st.Page(deep)
    assert [text for _, text in page.blocks] == ["x", "menu", "tail"]
    assert page.main_text(st.StyleTree(None)) == "x\ntail"
    assert len(st.Page("<div>" * 20_000 + "<b>" * 20_000 + "x</i>" * 20_000).tags) == 40_001


def test_the_tree_decides_inside_and_outside_of_articles(spark):
    pairs = []
    for i in range(20):
        inner = f"<article><p>Story {i} of its own</p><section class=s1><p>Our terms apply</p></section></article>"
        pairs.append(("http://news.example/%d" % i, f"<body><div class=o1>Welcome</div>{inner}<div class=o2>Letter {i} from afar</div></body>"))
    got = texts(spark, *pairs)
    assert all(got[i] == f"Story {i} of its own\nLetter {i} from afar" for i in range(20))


def test_a_layout_is_judged_alike_on_a_large_host(spark):
    """Thirty pages of a layout and per-page ids, among 970 other pages."""
    pairs = []
    for i in range(30):
        body = f"<div class=y1 id=top-{i}><span>All shops</span></div><div class=y2><p>Offer {i} of ours</p></div>"
        pairs.append(("http://big.example/%d" % i, f"<body id=post-{i} class=postid-{i}>{body}</body>"))
    pairs += [("http://big.example/o%d" % i, f"<body><div class=z{i % 97}><p>Other {i}</p></div></body>") for i in range(970)]
    got = texts(spark, *pairs)
    assert all(got[i] == f"Offer {i} of ours" for i in range(30))


def test_a_sentence_that_one_page_repeats_stays(spark):
    """Said 141 times on one page, it is more than half of its host's blocks, on one page of twelve."""
    pairs = []
    for i in range(12):
        said = "<p>Les Rech.</p>" * 141 if i == 3 else ""
        pairs.append(("http://farm.example/%d" % i, f"<body><article><h1>Title {i}</h1>{said}<p>Own words {i}</p><p>Kept by all</p></article></body>"))
    got = texts(spark, *pairs)
    assert got[3].count("Les Rech.") == 141
    assert all(got[i].endswith(f"Own words {i}") for i in range(12))


def test_all_pages_of_the_larger_table_equal_their_article(spark):
    d = "/root/testdata/sf0.1"
    got = {r.page_id: r.text for r in LLM_QUERIES["op3_style_tree"](spark, d).collect()}
    pages = spark.read.parquet(f"{d}/pages.parquet").collect()
    assert len(got) == len(pages) >= 2500
    for r in pages:
        article = r.html[r.html.index("<article>") : r.html.index("</article>")]
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1|article)>", article)]
        assert got[r.page_id] == "\n".join(x for x in parts if x), r.page_id
