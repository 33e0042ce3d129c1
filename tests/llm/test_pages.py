"""Main text of pages: planted templates, markup cases, the given pages and counts against brute force."""

import html as H
import re

import pytest

from quarry.llm import pages as P

SF = "/root/testdata/sf0.01"


def page(i, host, body, article=True):
    menu = "".join(f'<li><a href="/{i}/{k}">Entry {k + i}</a></li>' for k in range(5 + i % 2))
    main = f"<article>{body}</article>" if article else f'<div class="x9">{body}</div>'
    return (i, f"https://{host}/p/{i}?q=1",
            f'<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style></head><body>'
            f'<div class="top"><ul>{menu}</ul></div><div class="k1">Our shop has {i} offers today</div>'
            f'{main}<div class="k2"><p>We use your data well.</p><p>Page {i}</p></div></body></html>')


def by_id(df):
    return {r.page_id: r.text for r in df.collect()}


def test_template_of_a_site_goes_and_content_stays(spark):
    rows = [page(i, "Shop.example.com", f"<h2>Title {chr(97 + i)}</h2><p>Only here {chr(97 + i) * 9}.</p>", article=False)
            for i in range(12)]
    other = (99, "http://lone.example.org/", rows[0][2])       # the same markup where nothing recurs
    got = by_id(P.extract_pages(spark.createDataFrame([*rows, other], "page_id long, url string, html string").repartition(3)))
    for i in range(12):
        assert got[i] == f"Title {chr(97 + i)}\nOnly here {chr(97 + i) * 9}."
    assert "We use your data well." in got[99] and "Our shop has 0 offers today" in got[99]


def test_copies_of_an_article_keep_their_paragraphs(spark):
    same = "<h1>Hello</h1><p>Same words on every page.</p><ul><li>one</li></ul>"
    share = '<div class="q7">Send this to a friend</div>'
    rows = [page(i, "a.example", same + share) for i in range(30)]
    got = by_id(P.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")))
    assert set(got.values()) == {"Hello\nSame words on every page.\none"}


def test_equal_pages_count_once(spark):
    row = (7, "http://b.example/x", "<body><div>First text.</div><div>Second text.</div></body>")
    df = spark.createDataFrame([row] * 40, "page_id long, url string, html string")
    out = P.extract_pages(df).collect()
    assert len(out) == 40 and {r.text for r in out} == {"First text.\nSecond text."}


def test_recurring_counts_against_brute_force(spark):
    rows = [page(i, f"h{i % 3}.example", f"<p>{'w' * i}</p><div class='z{i % 2}'>box {i % 4}</div>") for i in range(40)]
    src = P._source(spark.createDataFrame(rows, "page_id long, url string, html string"), "page_id", "url", "html")
    got = {r.host: set(r.hashes) for r in P.recurring(src, 3, 0.3).collect()}
    seen, total = {}, {}
    for _, url, text in rows:
        host = url.split("/")[2]
        whole, subtrees = P.subtree_hashes(text)
        total.setdefault(host, set()).add(whole)
        for s in subtrees:
            seen.setdefault((host, s), set()).add(whole)
    want = {}
    for (host, s), on in seen.items():
        if len(on) >= 3 and len(on) >= 0.3 * len(total[host]):
            want.setdefault(host, set()).add(s)
    assert got == want and all(got.values())


@pytest.mark.parametrize("markup, want", [
    ("<article><p>a<p>b &amp; c&nbsp;d</article>", "a\nb & c d"),
    ("<article><p><b>a<br><p>b</b> c</article>", "a\nb c"),
    ("<article>x <script>var t='</p><p>no';</script>y<!-- <p>no --></article>", "x y"),
    ("<nav>m</nav><header>h</header><article><header><h1>T</h1></header><p>t</p><footer>f</footer></article><aside>s</aside>", "T\nt"),
    ('<main><div class="Comments-list">c</div><p>t</p><form>f</form><div id=cookie-notice>n</div></main>', "t"),
    ("<div>one</div>two<div>three</div>", "one\ntwo\nthree"),
    ("<article></article>", ""),
    ("<article><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a\nb\n1 2\n3"),
    ('<article><p title="a>b">q</p><p>1 &lt; 2 &#233; &amp</p></article>', "q\n1 < 2 é &"),
    ("<article><div>unclosed <i>text", "unclosed text"),
    ("plain text only", "plain text only"),
    ("</p></div>x</b>", "x"),
    ("<article>a <svg><path/><text>no</text></svg>b</article><article>c</article>", "a b\nc"),
])
def test_markup(markup, want):
    assert P.extract(markup) == want


@pytest.mark.parametrize("unit", ["<", "<a ", '<a "', "<div>", "<!--", "<script>", "<p>", "</p>", "<ul><li>", "<b>x"])
def test_hostile_pages_take_linear_time(unit):
    P.extract(unit * 20_000)
    P.subtree_hashes(unit * 20_000)


def test_awkward_rows(spark):
    long = "<article>" + "<p>" + "word " * 20_000 + "</p></article>"
    rows = [(1, "http://x.example", None, 1), (2, None, "<p>no url</p>", 1), (3, "not a url", "<p>t</p>", 1), (4, "http:///", "", 1),
            (None, "http://x.example", "<p>null id</p>", 1), (5, "http://u:p@X.example:80/", long, 1), (5, "http://x.example", long, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    out = sorted(((r.page_id or 0, r.url or "", len(r.text), r.n_chars) for r in P.extract_pages(df).collect()))
    assert out == [(0, "http://x.example", 7, 7), (1, "http://x.example", 0, 0), (2, "", 6, 6), (3, "not a url", 1, 1),
                   (4, "http:///", 0, 0), (5, "http://u:p@X.example:80/", 99_999, 99_999), (5, "http://x.example", 99_999, 99_999)]
    assert P.extract_pages(df.limit(0)).count() == 0
    hosts = df.select(P.host_of(df.url).alias("h")).distinct().collect()
    assert {r.h for r in hosts} == {"x.example", None}


def test_query_on_given_pages(spark):
    """The articles of the given pages, read by a plain rule that fits them only."""
    from quarry.llm.queries import QUERIES

    got = {r.page_id: r for r in QUERIES["op12_site_template"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(rows) == len(got)
    for r in rows:
        article = r.html[r.html.index("<article>") + 9:r.html.index("</article>")].replace("<b>", "").replace("<br>", " ")
        blocks = (" ".join(H.unescape(x).split()) for x in re.split("</?(?:p|h1)>", article))
        want = "\n".join(x for x in blocks if x)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url
