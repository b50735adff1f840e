import html
import random
import re
from collections import Counter

import pytest
from llm_helpers import SF0001

from shopfloor.llm import html_main, queries
from shopfloor.llm.html_main import Page

DDL = "page_id long, url string, html string"


def article(source):
    """The text of this table's articles, by a few replacements."""
    inner = re.search(r"<article>(.*?)(</article>|\Z)", source, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*\Z", "", inner))
    plain = (" ".join(html.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in parts)
    return "\n".join(p for p in plain if p)


def test_query_against_articles(spark):
    rows = spark.read.parquet(f"{SF0001}/pages.parquet").collect()
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in queries.op12_main_text(spark, SF0001).collect()}
    assert got == {r.page_id: (r.url, article(r.html), len(article(r.html))) for r in rows}


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain words", "plain words"), ("a < b &lt; c &amp d &copy; &nbsp; &#x41;&bogus;", "a < b < c & d © A&bogus;"),
    ("<p>one<p>two<b>bold<p>three", "one\ntwobold\nthree"),
    ("<p>a<br>b<hr>c</p></p>d", "a b\nc\nd"),
    ("<ul><li>x<li>y<ul><li>z</ul></ul>", "x\ny\nz"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<head><title>t</title><style>p{}</style><body><p>text", "text"),
    ("<script>var a = '<p>no</p>';</script><p>yes</p><script>unclosed <p>no", "yes"),
    ("<p>keep<!-- <p>no</p> -->this<!-- open <p>no", "keepthis"),
    ("<nav><a href=/>Home</a></nav><header><h1>Site</h1></header><p>x</p><footer>f</footer><aside>s</aside>", "x"),
    ("<article><header><h1>Title</h1><p>by me</p></header><p>x</p><footer>f</footer></article><p>out</p>", "Title\nx"),
    ("<div class='comments'><article class='comment'>c</article></div><article>a</article>", "a"),
    ("<div class='cookie-notice'>c</div><form><input><button>Go</button><p>f</p></form><p>x", "x"),
    ("<form><article>whole page in a form<button>b</button></article></form>", "whole page in a form"),
    ("<div class='has-sidebar'><p>x</p><div id=sidebarLeft>s</div><p hidden>h</p><p style='display:none'>n</p></div>", "x"),
    ("<div class='commentary'><p>x <span class=ad>buy</span> y</p></div>", "x y"),
    ("<main>m<section>s</section></main><div>d</div>", "m\ns"),
    ("<div><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div><p>See <a href=4>this</a>.</p>", "See this."),
    ("<article><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul>x</article>", "One\nTwo\nThree\nx"),
    ("<ARTICLE CLASS=\"x\"><P TITLE='a > b'>caps</P></ARTICLE>", "caps"),
    ("<p>a&am", "a&am"), ("<p>a</p", "a"), ("<p>a<p class='x", "a"), ("a<p title=\"open>b</p>", "a\nb"), ("<>x</ >y", "<>xy"),
    ("<head><p>unclosed head", "unclosed head"), ("\n <p> \t wide\n text </p>", "wide text"),
])
def test_rules(source, text):
    assert Page(source).text() == text


def site(n, body, host="h.example"):
    return [(k, f"https://{host}/{k}?x=1", f"<div class=w><div class=q1>Follow us now</div>{body(k)}<div><p>All rights of {host}</p></div></div>")
            for k in range(n)]


def run(spark, rows):
    return {r.page_id: r.text for r in html_main.extract(spark.createDataFrame(rows, DDL).repartition(3)).collect()}


def test_templates_by_host(spark):
    rng = random.Random(4)
    rows = site(30, lambda k: f"<p>Own words {k}</p>" + ("<p>shared passage</p>" if k % 2 else ""))
    rows += [(100 + k, f"http://b.example/{k}", f"<article><p>Text {rng.random()}</p><div><i>Sign</i> here</div></article>") for k in range(9)]
    rows += [(200 + k, f"http://c.example/{k}", "<article><p>One article</p><p>at many addresses</p></article>") for k in range(20)]
    rows += [(300 + k, f"http://few.example/{k}", f"<p>page {k}</p><p>twice</p>") for k in range(4)]
    rows += [(400 + k, "no address", f"<p>page {k}</p><p>same</p>") for k in range(20)]
    got = run(spark, rows)
    for k in range(30):
        assert got[k] == f"Own words {k}" + ("\nshared passage" if k % 2 else "")
    assert all(re.fullmatch(r"Text [\d.e-]+", got[100 + k]) for k in range(9))
    assert all(got[200 + k] == "One article\nat many addresses" for k in range(20))
    assert all(got[300 + k] == f"page {k}\ntwice" for k in range(4))
    assert all(got[400 + k] == f"page {k}\nsame" for k in range(20))


def test_templates_against_counting(spark):
    rng = random.Random(6)
    rows = [(k, f"http://{rng.choice('abc')}.example/", "".join(f"<div><p>{rng.choice('uvwxyz')}</p>{rng.choice(['', '<p>t</p>'])}</div>"
                                                               for _ in range(rng.randint(0, 5)))) for k in range(80)]
    held, pages = Counter(), {}
    for _, url, source in rows:
        p = Page(source)
        if p.text() not in pages.setdefault(url[7:16], {}):
            pages[url[7:16]][p.text()] = set(p.subtrees().values())
    want = {}
    for host, found in pages.items():
        held = Counter(x for s in found.values() for x in s)
        if often := {x for x, n in held.items() if n >= 5 and n >= 0.7 * len(found)}:
            want[host] = often
    got = html_main.templates(spark.createDataFrame(rows, DDL).repartition(3)).collect()
    assert {r.host: set(r.subtrees) for r in got} == want


def test_by_shuffle_as_by_broadcast(spark, monkeypatch):
    rows = site(12, lambda k: f"<p>{k}</p>") + site(12, lambda k: f"<p>{k}!</p>", "other.example")
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    first = run(spark, rows)
    monkeypatch.setattr(html_main, "BROADCAST_BYTES", -1)
    assert run(spark, rows) == first == {i: str(i) if i < 12 else f"{i - 12}!" for i in range(24)}


def test_nulls_repeats_long_and_clashing_columns(spark, frame):
    rows = [(1, None, None, "old", 5), (1, None, None, "old", 5), (2, "http://x/", "", "old", 5),
            (None, "", "<p>" + "word " * 200_000, "old", 5), (4, "http://x/", "<div>" * 3_000 + "deep", "old", 5)]
    df = frame(rows, DDL + ", text string, host int")
    got = html_main.extract(df)
    assert got.columns == ["page_id", "url", "host", "text"]
    found = sorted(((r.page_id, len(r.text)) for r in got.collect()), key=str)
    assert found == sorted([(1, 0), (1, 0), (2, 0), (None, 999_999), (4, 4)], key=str)
    assert html_main.extract(frame([], DDL)).count() == 0
