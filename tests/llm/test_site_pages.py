import html
import re
from collections import Counter, defaultdict

import pytest

from gristmill.llm import markup, queries, site_pages

SCHEMA = "page_id long, url string, html string, host string, text int"


def text_of(page):
    root = markup.parse(page)
    markup.prune(root)
    return markup.main_text(root)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("just words", "just words"),
        ("<p>one<p>two", "one\n\ntwo"),
        ("<article><h1>T</h1><p><b>one.<br><p>two <i>in</i>side</p></article><footer>f</footer>", "T\n\none.\n\ntwo inside"),
        ("<article>a<div class=ad>buy</div>b <span class='comment-count'>7 comments</span></article>", "a\n\nb"),
        ("<nav>n</nav><header>site</header><article><header><h1>T</h1><p>by me</p></header><p>x</p><aside>s</aside><form>f</form></article>", "T\n\nby me\n\nx"),
        ("<article><header>no heading</header><p>x</p></article><section id=comments><article class=comment>c</article></section>", "x"),
        ("<div class='cookie-notice'>c</div><div id=sidebar>s</div><div role=navigation>n</div><div class=text>kept</div>", "kept"),
        ("<div id=main-content><p>m</p></div><div>elsewhere</div>", "m"),
        ("<main><p>m</p></main><p>elsewhere</p>", "m"),
        ("<script>var t='</p><p>no';</script><style>p{}</style><p>x &amp; y &#233;&eacute;&nbsp; z&copy</p><!-- a > b --><!-->", "x & y éé z©"),
        ("<p>a</p>\n\n between \n<p>b\n  c\t d</p>", "a\n\nbetween\n\nb c d"),
        ("<ul><li>1<li>2<ul><li>3</ul></ul>", "1\n\n2\n\n3"),
        ("<table><tr><td>a<td>b<tr><td><p>c</p></td></tr></table>after", "a b\n\nc\n\nafter"),
        ("<b><p>bold</b> on</p>next", "bold on\n\nnext"),
        ("<p>2 < 3 and 4 > 1 </ > x</p></div></p>", "2 < 3 and 4 > 1 x"),
        ("<p title='a > b' data-x=\"<p>\">it's</p><p don't>fine</p>", "it's\n\nfine"),
        ("<article><p>cut of", "cut of"),
        ("<p>cut <a href='x", "cut"),
        ("<script>never ends <p>x", ""),
        ("<pre>a\n  b</pre><blockquote>q</blockquote><img alt=no>", "a b\n\nq"),
        ("<ARTICLE><P CLASS='x'>Upper</P></ARTICLE>", "Upper"),
        ("<article></article><p>article without text</p>", "article without text"),
        ("<article>one</article><article>two</article>", "one\n\ntwo"),
        ("<div class='adSlot'>no</div><div class=shadow>yes</div><p class=address>yes</p>", "yes\n\nyes"),
    ],
)
def test_one_page(page, text):
    assert text_of(page) == text


def test_deep_pages_take_linear_time():
    for page in ("<div>" * 50_000 + "x", "<p><b>x" * 30_000, "<b>" * 30_000 + "<p></b>" * 30_000, "<ul><li>" * 20_000, "<" * 50_000, "<a b='" * 20_000):
        root = markup.parse(page)
        markup.prune(root)
        markup.subtree_hashes(root)
        markup.main_text(root)


def site():
    """A host whose pages share an unmarked bar, a box inside the article and an article that is printed on many pages."""
    rows = []
    for k in range(60):
        again = k % 3 == 0
        body = "<p>The same story.</p><p>Its second part.</p>" if again else f"<p>Story {k} is told.</p><p>License: free.</p>"
        box = "<div>Read our <b>letter</b> each week</div>"
        rows.append((k, f"https://News.example.org/{k}", f"<html><body><div><span>Home</span> <span>About</span></div><article><h1>Title {k}</h1>{body}{box}</article><div>All rights kept</div></body></html>", "x", k))
    rows += [(100 + k, "http://small.example.org/", f"<div>Home</div><p>Small {k}</p>", "x", 1) for k in range(4)]
    rows += [(200, None, "<p>no address</p>", "x", 1), (201, "not a url", "<p>odd address</p>", "x", 1), (202, "http://small.example.org/", None, "x", 1), (None, "http://e.example.org", "", "x", 1)]
    rows += [rows[1], rows[1]]
    return rows


def test_templates_of_a_site(spark):
    df = spark.createDataFrame(site(), SCHEMA)
    got = defaultdict(list)
    for r in site_pages.extract_pages(df).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert got[0] == ["Title 0\n\nThe same story.\n\nIts second part."] and got[3] == ["Title 3\n\nThe same story.\n\nIts second part."]
    # The license stands on two thirds of the pages, in another article each time.
    assert got[1] == ["Title 1\n\nStory 1 is told."] * 3
    less = {r.page_id: r.text for r in site_pages.extract_pages(df, share=0.9).collect()}
    assert less[1] == "Title 1\n\nStory 1 is told.\n\nLicense: free." and less[100] == "Home\n\nSmall 0"
    assert got[100] == ["Home\n\nSmall 0"] and got[200] == ["no address"] and got[201] == ["odd address"] and got[202] == [""] and got[None] == [""]


def test_templates_against_counting_by_hand(spark):
    df = spark.createDataFrame(site(), SCHEMA)
    for share, surroundings in ((0.5, 10), (0.3, 2), (0.05, 2), (1.0, 1)):
        got = {r.host: set(r.template) for r in site_pages.site_templates(df, share, surroundings).collect()}
        pages, where, around = Counter(), Counter(), defaultdict(set)
        for _, url, page, *_ in site():
            if not url or "://" not in url:
                continue
            host = re.sub(r"^\w+://([^/]*).*", r"\1", url).lower()
            pages[host] += 1
            root = markup.parse(page or "")
            markup.prune(root)
            found = markup.subtree_hashes(root)
            for h, p in {(h, found[e.parent]) for e, h in found.items() if e.name not in ("", "html", "body", "main", "article")}:
                where[host, h] += 1
                around[host, h].add(p)
        want = defaultdict(set)
        for (host, h), n in where.items():
            if n >= share * pages[host] and len(around[host, h]) >= surroundings:
                want[host].add(h)
        assert got == dict(want)


def test_registered_query(spark, sf):
    """On the test pages the main text is what stands between the article's tags, block by block."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in queries.op12_html_extraction(spark, sf).collect()}
    assert set(got) == set(pages)
    for k, page in pages.items():
        inside = re.search("<article>(.*)</article>", page, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside))
        assert got[k] == "\n\n".join(p for p in parts if p)


def test_no_rows(spark):
    assert site_pages.extract_pages(spark.createDataFrame([], SCHEMA)).count() == 0
