"""Main text of web pages: against the known parts of pages built here, and the operator against a plain version."""

import collections

import pytest

from queuecraft.llm import wrappers
from queuecraft.llm.wrappers import grouped, main_text, parse, template

from .conftest import invented

SCHEMA = "page_id long, url string, html string, text string, host string, n long"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("  \n", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>a<p>b<br>c", "a\nb\nc"), ("<b>x</b> <i>y</i>\n\t z", "x y z"),
    (page("<nav>menu</nav><article><h1>A &lt;B&gt;</h1><p>one\n  two<p>three</article><footer>f</footer>"), "A <B>\none two\nthree"),
    (page("<div class='ad'>buy</div><div>text</div><aside>s</aside><form>f <input></form>"), "text"),
    (page("<p>a <button>share</button>b</p><p hidden>no</p><div role='navigation'>no</div>"), "a b"),
    (page("<body class='has-sidebar'><div class='with sidebar'><article><p>in</p></article></div><p>out</p>"), "in"),
    (page("<article><header><h1>Head</h1><p>by line</p></header><p>x</p></article><header><h2>Site</h2></header>"), "Head\nx"),
    (page("<article><p>x</p></article><div id='comments'><article>c</article></div><article class='comment'>d</article>"), "x"),
    (page("<ul><li><a href='/'>home</a><li><a>more</a></ul><p>a text with <a>a link</a></p>"), "a text with a link"),
    (page("<table><tr><td>a<td>b<tr><th>c<td><p>d<p>e</table>"), "a\nb\nc\nd\ne"),
    (page("<script>'<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes<!-- open"), "yes"),
    ("<p title='a>b' class=x>1 < 2 &am &copy; 3<", "1 < 2 &am © 3<"),
    ("<head><meta><p>body follows", "body follows"), ("x" * 100_000, "x" * 100_000), ("<div>" * 3000 + "deep", "deep"),
])
def test_elements(html, want):
    assert main_text(html) == want


def likeness_by_trying(a, b):
    """Largest matching of two lists of trees (tag, children), by trying every way."""
    if not a or not b:
        return 0
    best = max(likeness_by_trying(a[1:], b), likeness_by_trying(a, b[1:]))
    if a[0][0] == b[0][0]:
        best = max(best, 1 + likeness_by_trying(a[0][1], b[0][1]) + likeness_by_trying(a[1:], b[1:]))
    return best


def test_alignment_is_a_largest_matching():
    pages = ["<ul><li>a<li><p>b</ul><p>c<div>d</div>", "<div>x<p>y</div><p>c", "<div><h1>t</h1><ul><li>a</ul></div><ul><li>b</ul>", "<p>a<h1>b</h1><p>c<h1>d</h1>"]
    plain = lambda g: (g.label, [plain(c) for c in g.children])
    count = lambda g: (not g.children and g.label == "#") + sum(count(c) for c in g.children)
    for one in pages:
        for two in pages:
            a, b = grouped(parse(one)), template(grouped(parse(two)).spelled())
            assert b.spelled() == grouped(parse(two)).spelled()
            assert wrappers.likeness(a, b) == likeness_by_trying([plain(a)], [plain(b)])
            at = wrappers.aligned(a, b)
            assert set(at.values()) <= set(range(count(b)))
            if one == two:
                assert sorted(set(at.values())) == list(range(count(b)))


def site(n, host="a.example.com"):
    """Pages without telling elements: a constant line and tail around a varying body, two layouts."""
    for i in range(n):
        extra = f"<h2>{invented(900 + i, 3)}</h2>" if i % 4 == 0 else ""
        body = [invented(100 * i + k, 12) for k in range(1 + i % 3)]
        yield (i, f"http://{host}/{i}", page(f"<div><p>Welcome to our site</p></div><div>{extra}{''.join(f'<p>{b}</p>' for b in body)}</div>"
                                             f"<div><p>All rights reserved</p></div>"), "\n".join(([invented(900 + i, 3)] if extra else []) + body))


def test_constant_nodes_are_template(spark):
    rows = list(site(24))
    few = [(100 + i, url.replace("a.example", "few.example"), html, None) for i, url, html, _ in rows[:4]]
    copies = [(200 + i, f"https://copies.example.org/{i}", page("<div><p>the same story</p></div>"), "the same story") for i in range(30)]
    odd = [(300, None, rows[0][2], None), (301, "no host", page("<p>a</p>"), "a"), (302, rows[0][1], None, ""), (None, rows[1][1], rows[1][2], rows[1][3]),
           (303, rows[0][1], "", ""), (*rows[2],)]
    given = [*rows, *few, *copies, *odd]
    df = spark.createDataFrame([(i, u, h, "x", "y", 1) for i, u, h, _ in given], SCHEMA).repartition(4)
    got = collections.Counter((r.page_id, r.url, r.text) for r in wrappers.extract(df).collect())
    whole = lambda h: main_text(h)
    assert got == collections.Counter((i, u, whole(h) if t is None else t) for i, u, h, t in given)
    assert all("Welcome" in whole(h) for *_, h, _ in few)           # too few pages to tell template from content
    assert wrappers.extract(df.limit(0)).count() == 0


def test_hot_host_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "SENT", 0)
    monkeypatch.setattr(wrappers, "HOT", 4)
    rows = [*site(40), *[(1000 + i, f"http://h{i % 7}.example.net/", page(f"<p>{invented(i, 9)}</p>"), invented(i, 9)) for i in range(20)]]
    df = spark.createDataFrame([(i, u, h, "x", "y", 1) for i, u, h, _ in rows], SCHEMA)
    assert {(r.page_id, r.text) for r in wrappers.extract(df).collect()} == {(i, t) for i, _, _, t in rows}


def test_given_pages_keep_their_articles(spark, sf):
    """In the given pages the article element holds the main text, and nothing of it is lost to the wrapper."""
    from pyspark.sql import functions as F
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    want = {}
    for r in pages.select("page_id", F.regexp_extract("html", "(?s)<article>(.*?)</article>", 1).alias("a")).collect():
        want[r.page_id] = main_text(r.a)
    assert got == want
