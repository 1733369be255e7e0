import html
import random
import re
import time

import pytest

from lading.llm import extraction
from lading.llm.extraction import Page
from lading.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, text string, host string"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<article><h1>A&amp;b</h1><p>x <b>y</b>z<br>q<p>w</article><footer>no</footer>", "A&b x yz q w"),
        ("<nav><a>m</a></nav><div>hi<div class='ad big'>buy</div> there</div><aside>s</aside>", "hi there"),
        ("<p>a<script>var x='</p>';</script>b<!-- c -->d &am", "abd &am"),
        ("<article>t<div id=comments>c</div>u<form>f</form></article>x", "t u"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>", "a b 1 2"),
        ("<article>unclosed <p>x<foo", "unclosed x"),
        ("a < b <3 c &lt;p&gt; &#233;&nbsp;x", "a < b <3 c <p> é x"),
        ("<body><header>h</header><main>m<div hidden>no</div><p style='display: none'>no</main>x", "m"),
        ("<div class=post><p>one</p>\n\n<p>two   three</p></div><div class='cookie-notice'>ok?</div>", "one two three"),
        ("<div role=navigation>n</div><p class=lead>adept <span class=downloads>x</span>", "adept x"),
        ("<textarea>a<p>b</textarea>c<style>p{}</style><title>t", "c"),
        ("</p></div>stray<p></p>", "stray"),
        ("", ""),
        ("  \n ", ""),
    ],
)
def test_text(source, text):
    assert Page(source).text() == text


def test_templates_go_and_articles_stay():
    pages = [f"<div class=x>Visit our <b>shop</b></div><p>story {i}</p><section><p>All rights</p></section>" for i in range(3)]
    shared = frozenset.intersection(*(frozenset(Page(p).hashes) for p in pages))
    assert [Page(p, shared).text() for p in pages] == [f"story {i}" for i in range(3)]
    quoted = "<article><p>story</p><section><p>All rights</p></section></article>"
    assert Page(quoted, shared).text() == "story All rights"


def rows():
    out = []
    for i in range(12):
        out.append((i, f"http://Site.example:80/{i}", f"<div>Part of the site</div><div><p>text {i}</p></div>", "t", "h"))
    out += [(100 + i, "http://copies.example/x", "<div>one page</div>", None, None) for i in range(20)]
    out += [(200 + i, None, f"<div>same</div><p>{i}</p>", None, None) for i in range(6)]
    out += [(300, "no url", None, None, None), (301, "", "", None, None), (None, None, "<p>n</p>", None, None)]
    out += [(302, "http://other.example/", "<div>Part of the site</div>" + "<p>w</p>" * 20_000, None, None)]
    return out


@pytest.mark.parametrize("limit", [100_000, 0])
def test_site_templates(spark, limit):
    found = {r["page_id"]: r for r in extraction.extract(spark.createDataFrame(rows(), PAGES), limit).collect()}
    assert [found[i]["text"] for i in range(12)] == [f"text {i}" for i in range(12)]
    # A page that is stored many times is no template; rows without url share a host.
    assert {found[100 + i]["text"] for i in range(20)} == {"one page"}
    assert {found[200 + i]["text"] for i in range(6)} == {str(i) for i in range(6)}
    assert found[300]["text"] == found[301]["text"] == "" and found[None]["text"] == "n"
    assert found[302]["text"] == "Part of the site" + " w" * 20_000
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())
    assert extraction.extract(spark.createDataFrame([], PAGES), limit).collect() == []


def test_query_on_whole_table(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet").collect()
    found = {r["page_id"]: r["text"] for r in QUERIES["op6_extraction"](spark, data).collect()}
    assert len(found) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*?)(</article>|$)", p["html"], re.DOTALL)[1]
        plain = re.sub(r"<[^>]*>?", " ", re.sub(r"</?b>", "", body))
        assert found[p["page_id"]] == " ".join(html.unescape(plain).split())


def wrapped(i):
    top, foot = "<div class=top>Our site, all days</div>", "<div class=end>Imprint and contact</div>"
    story = f"<main><div><article>story {i}</article></div></main>"
    inner = f"<div class=page><section>{story}</section><p>Read more</p></div>"
    return f"<html><body>{top}{inner}{foot}</body></html>"


def test_wrapped_content_is_no_template(spark):
    rows = [(i, f"http://a.example/{i}", wrapped(i), None, None) for i in range(20)]
    found = {r["page_id"]: r["text"] for r in extraction.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {i: f"story {i}" for i in range(20)}
    shared = frozenset.intersection(*(frozenset(Page(wrapped(i)).hashes) for i in range(20)))
    assert len(shared) == 2
    # Where an article was left out, templates beside its wrapper still go; a paragraph may be quoted.
    bare = wrapped(1).replace("main", "div").replace("article", "div")
    assert Page(bare, shared).text() == "story 1 Read more"


@pytest.mark.parametrize(
    "wrapper",
    ["layout has-sidebar", "no-sidebar", "comments-open", "with-header", "hasSidebar", "sidebar-layout", "page header"],
)
def test_wrappers_with_listed_names(wrapper):
    comments = "<div id=comments><ol><li><article class=comment>c</article></ol></div>"
    side = "<div class=sidebar>s <p>t</div>"
    page = f"<body><div class='{wrapper}'>{side}<article><p>story{comments}</article>{comments}</div>{side}x"
    assert Page(page).text() == "story"
    # An article outside goes before one in an element of such a name.
    assert Page(f"{side}<main>m</main><div class=sidebar><article>teaser</article></div>").text() == "m"
    assert Page(f"<my-widget class=widget>w<article>a</article></my-widget>{side}").text() == "a"
    assert Page("<my-widget class=widget>w</my-widget>a").text() == "a"


@pytest.mark.parametrize("limit", [100_000, 0])
def test_templates_are_alike_on_hosts_of_every_size(spark, limit):
    out = []
    for host, size in (("small", 20), ("large", 400)):
        for i in range(size):
            notice = "<div>Notice of one section</div>" if i < 8 else "<div>Rare</div>" if i < 12 else ""
            out.append((len(out), f"http://{host}.example/{i}", f"{notice}<div><p>{host} {i}</p></div>", None, None))
    found = extraction.extract(spark.createDataFrame(out, PAGES), limit).collect()
    texts = {r["url"].removeprefix("http://"): r["text"] for r in found}
    for host in ("small", "large"):
        assert [texts[f"{host}.example/{i}"] for i in range(8)] == [f"{host} {i}" for i in range(8)]
        assert [texts[f"{host}.example/{i}"] for i in range(8, 12)] == [f"Rare {host} {i}" for i in range(8, 12)]


def extracted(spark, sources, host="h"):
    rows = [(i, f"http://{host}.example/{i}", source, None, None) for i, source in enumerate(sources)]
    found = extraction.extract(spark.createDataFrame(rows, PAGES)).collect()
    return [r["text"] for r in sorted(found, key=lambda r: r["page_id"])]


def test_copies_of_a_page_are_no_template(spark):
    body = "<body><div class=top>Our site</div><div><p>One story</p><p>that is told</p></div></body>"
    same = [f"<title>{i}</title><script>var n={i}</script>{body}" for i in range(8)]
    assert extracted(spark, same) == ["Our site One story that is told"] * 8
    # Nor are pages of which only a counter differs.
    story = "<div><p>" + "A long story about much that happened. " * 5 + "</p></div>"
    counted = [f"{story}<div>{i} views</div>" for i in range(8)]
    assert extracted(spark, counted) == [f"{Page(story).text()} {i} views" for i in range(8)]


def test_quoted_paragraphs_stay(spark):
    quote = "<blockquote><p>To be or not to be</p></blockquote><p>That is the question</p>"
    pages = [f"<div>Chrome of the site</div><div><p>Essay {i}</p>{quote}<p>end {i}</p></div>" for i in range(8)]
    said = "To be or not to be That is the question"
    assert extracted(spark, pages) == [f"Essay {i} {said} end {i}" for i in range(8)]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<article>Shares: <span class='share-price'>12</span> <div class='notice-board'>b</div>x", "Shares: 12 b x"),
        ("<article><section class='related-work'>w</section><div class='related-posts'>p</div>y", "w y"),
        ("<article><div class='promo comments'><p>The whole long article</p></div><p>tail</p>", "The whole long article tail"),
        ("<article><div class=widget>The article <div class=comments>no</div></div>x", "The article x"),
        ("<article><p>A longer text</p><div class=share><div class=x>y</div></div><x-ad class=ad>z</x-ad>", "A longer text"),
    ],
)
def test_names_inside_the_article(source, text):
    assert Page(source).text() == text


def test_deep_and_unmatched_tags():
    start = time.perf_counter()
    n = 100_000
    assert Page("<i>" * n + "</u>" * n + "x").text() == "x"
    assert Page("<p><caption>" + "<i>" * n + "<li>a" * 100 + "<div></div>" * n).text() == "a" + " a" * 99
    assert Page("<article>" + "<div class=share>" * 2_000 + "yyyy" + "<div class=ad>" * n + "z").text() == "yyyy"
    assert time.perf_counter() - start < 12


def plain_templates(pages, least=5):
    """Texts of pages of divs with one line each: lines among five different surroundings go."""
    around = {}
    for lines in pages:
        for line in set(lines):
            rest = list(lines)
            rest.remove(line)
            around.setdefault(line, set()).add(tuple(sorted(rest)))
    out = []
    for lines in pages:
        left = [line for line in lines if len(around[line]) < least]
        size = len("".join(lines))
        out.append(" ".join(left if 8 * len("".join(left)) >= size else lines))
    return out


def test_against_plain_two_passes(spark):
    rnd = random.Random(4)
    gone = 0
    for host in range(4):
        chrome = [f"chrome {host} {i} " + "w" * rnd.randrange(20) for i in range(6)]
        pages = []
        for i in range(40):
            lines = rnd.sample(chrome, rnd.randrange(5)) + [f"story {rnd.randrange(60)}" for _ in range(rnd.randrange(4))]
            rnd.shuffle(lines)
            pages.append(tuple(lines))
        expected = plain_templates([[line.strip() for line in lines] for lines in pages])
        found = extracted(spark, ["".join(f"<div>{line}</div>" for line in lines) for lines in pages], f"h{host}")
        assert found == expected
        gone += sum(len(" ".join(p)) > len(e) for p, e in zip(pages, expected, strict=True))
    assert gone > 40
