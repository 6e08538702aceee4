"""Trees of elements, posts read from them, and pages against Python's own parser."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from fernlight.functions import dom
from fernlight.plans import catalogue
from fernlight.sources import landing

SF = "/root/testdata/sf0.001"


def shape(html):
    t = dom.Tree(html)
    return [(t.tags[k], t.parents[k], t.text(k)) for k in range(len(t.tags))]


@pytest.mark.parametrize(("html", "want"), [
    ("", []),
    ("plain", []),
    ("<p>a<p>b", [("p", -1, "a"), ("p", -1, "b")]),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>d", [("ul", -1, "a b c"), ("li", 0, "a b"), ("ul", 1, "b"), ("li", 2, "b"), ("li", 0, "c")]),
    ("<div><b>a</div>b</b>", [("div", -1, "a"), ("b", 0, "a")]),
    ("<DIV>x<br>y<img src=a>z</div></p>", [("div", -1, "x yz"), ("br", 0, ""), ("img", 0, "")]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", [("table", -1, "abc"), ("tr", 0, "ab"), ("td", 1, "a"), ("td", 1, "b"), ("tr", 0, "c"), ("td", 4, "c")]),
    ("<script>if (a<b) '</p>'</script><p>&lt;&eacute;&#33;", [("script", -1, ""), ("p", -1, "<é!")]),
    ("<!-- <p> --><p>a<!-- > --> b", [("p", -1, "a b")]),
    ("<a title='>' href=\"x>y\">k</a> 1 < 2", [("a", -1, "k")]),
    ("<title>a <b> c</title><script>open", [("title", -1, "a <b> c"), ("script", -1, "")]),
])
def test_trees(html, want):
    assert shape(html) == want


def test_attributes_and_search():
    t = dom.Tree("<div id=a ID=b data-testid='x&amp;y' checked><i data-testid=z></i></div><i>")
    assert t.attributes[0] == {"id": "a", "data-testid": "x&y", "checked": ""}
    assert list(t.find(tag="i")) == [1, 2] and list(t.find(0, data_testid="z")) == [1] and list(t.find(data_testid=None)) == [0, 1] and list(t.ancestors(1)) == [0]


def test_any_text_has_a_tree():
    rng = random.Random(1)
    for _ in range(400):
        html = "".join(rng.choices(["<p>", "</p>", "<div>", "</div>", "<", ">", "a", "</", "<!--", "-->", "<li>", "<script>", "</script>", '"', "<a b='", "&lt", "<tr>", "<td>"], k=30))
        t = dom.Tree(html)
        for k, (begin, inner, outer, end) in enumerate(t.spans):
            assert 0 <= begin <= inner <= outer <= end <= len(html)
            if (p := t.parents[k]) >= 0:
                assert p < k and t.spans[p][1] <= begin and end <= t.spans[p][2]


ARTICLE = """<article role="x" data-testid="tweet"><div data-testid="User-Name"><div><a href="/iris">l</a><a href="https://x.test/no">n</a><a class=c href="/@Trader/">T</a></div></div>
<a href="/x/status/1"><span>other</span></a><a class="t" href="https://x.test/Trader/status/42?s=1"><div><time datetime="2024-01-30T10:00:00Z">1h</time></div></a>
<div lang=en data-testid="tweetText"><div>Buy <span>#Nifty50</span></div><div>with <b>@Desk</div> &amp; hold<script>no()</script></div>
<button aria-label="2.5K Replies" data-testid="reply"><span>9</span></button><div data-testid="like"><span><b>1,234</b></span></div><div data-testid=retweet></div>
<a href="/Trader/status/42/analytics" aria-label="">7M<i> views</i></a></article>"""


def test_posts_from_nested_elements(spark):
    broken = ARTICLE.replace("2.5K", "1.2.3").replace("42", "43")
    quoted = ARTICLE.replace("</article>", "<article data-testid='tweet'><a href='/q/status/5'><time datetime='2024-01-01T00:00:00+02:00'></time></a><p data-testid='tweetText'>inner</p></article></article>")
    rows = [(1, f"<html><body><main>{ARTICLE}<article>no post</article>{broken}"), (2, quoted), (3, None), (4, ""), (5, ARTICLE.replace("status/42?", "photo/42?")), (6, ARTICLE[: ARTICLE.index("<button")])]
    pages = spark.createDataFrame(rows, "n int, html string")
    found = landing.split_articles(pages)
    assert {(r.n, r["count"]) for r in found.groupBy("n").count().collect()} == {(1, 2), (2, 2), (5, 1), (6, 1)}
    got = landing.parse_articles(found, F.lit("q"), F.lit("2024-02-01").cast("timestamp")).collect()
    assert sorted((r.tweet_id, r.content) for r in got) == [("42", "Buy #Nifty50 with @Desk & hold"), ("42", "Buy #Nifty50 with @Desk & hold"), ("42", "Buy #Nifty50 with @Desk & hold"), ("5", "inner")]
    one = next(r for r in got if r.tweet_id == "42" and r.like_count)
    assert (one.username, one.reply_count, one.repost_count, one.like_count, one.view_count, one.bookmark_count, one.mentions, one.hashtags, one.url) == ("trader", 2500, 0, 1234, 7_000_000, 0, ["desk"], ["nifty50"], "https://x.test/Trader/status/42?s=1")
    assert next(r for r in got if r.tweet_id == "5").username == "unknown"


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.title, self.links, self.elements, self.inside = None, [], 0, False

    def handle_starttag(self, tag, attrs):
        self.elements += 1
        own = dict(attrs)
        if tag == "a" and "href" in own:
            self.links.append(own["href"] or "")
        self.inside = tag == "title"

    def handle_data(self, data):
        if self.inside and self.title is None:
            self.title = data.strip()

    def handle_endtag(self, tag):
        self.inside = False


def test_pages_are_those_of_a_plain_parser(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in landing.outlines(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    assert got.keys() == pages.keys()
    for k, html in pages.items():
        plain = Plain()
        plain.feed(html or "")
        assert (got[k].title, got[k].links, got[k].n_elements) == (plain.title, plain.links, plain.elements)
        assert got[k].depth <= got[k].n_elements and (got[k].heading is None) == ("<h1" not in html)
    assert catalogue.page_outlines(spark, SF).count() == len(pages)
