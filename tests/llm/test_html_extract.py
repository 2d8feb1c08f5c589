import html
import re

from hourgrid.llm.html_extract import article_path, extract_main_text, host_of, main_text
from hourgrid.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>gone</p> --><div class="cookie-notice">Cookies!</div><aside>Side</aside>
<article><h1>Title &amp; more</h1><p>First   <b>bold</b>
text<br>here&nbsp;&lt;ok&gt;<p>Second <i>one</i><script>var x="</p><p>no";</script></p><div class="ad">Buy</div><ul><li>One<li>Two</ul>
<form><input value="x">Send</form><table><tr><td>Cell</td><td>Next</td></tr></table><blockquote>Quote</blockquote>
<section class="comments"><p>A reader</p></section></article><footer>&copy; x</footer></body></html>"""
WANT = ["Title & more", "First bold text here <ok>", "Second one", "One", "Two", "Cell", "Next", "Quote"]


def brute(page):
    """The blocks of a test-data page: its article cut at block tags."""
    body = re.search("<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?p>|</?h1>", body)]
    return "\n\n".join(b for b in blocks if b)


def test_query_equals_brute_force(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = QUERIES["op5_html"](spark, SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == brute(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_blocks_of_a_page():
    assert main_text(PAGE, None, frozenset()).split("\n\n") == WANT
    assert main_text(PAGE.replace("article>", "main>"), None, frozenset()).split("\n\n") == WANT
    assert main_text("a < b &am &amp c <p>x", None, frozenset()) == "a < b &am & c\n\nx"
    assert main_text('<p title="a>b">q</p><p title=\'x>y\'>r</p><p broken="z>s', None, frozenset()) == "q\n\nr\n\ns"
    assert main_text("<article>" + "<div>" * 3000 + "deep" + "<p>" * 3000, None, frozenset()) == "deep"
    assert main_text('<div hidden>x</div><div style="display: none">y</div><p>z', None, frozenset()) == "z"


def test_marked_wrappers_do_not_hide_the_article():
    story = "<article><h1>Title</h1><p>Story text</p><div class='share'>Tweet</div></article>"
    for attributes in ('class="site no-sidebar"', 'id="page-with-comments"', 'class="post share"', 'class="sidebar"', 'role="form"'):
        for inner in (story, story.replace("article>", "main>")):
            page = f"<body><div class='ad'>Buy</div><section {attributes}>{inner}<div class='comments'><article>A reader</article></div></section></body>"
            assert main_text(page, None, frozenset()) == "Title\n\nStory text", attributes
    assert main_text(f"<form>{story}</form>", None, frozenset()) == "Title\n\nStory text"
    assert main_text("<div><p>The longer story</p></div><ol class=comments><li><article>Short</article></ol>", None, frozenset()) == "The longer story"
    for marked in ("site-header", "nav-links", "comments_area", "cookie-notice", "ad-300x250"):
        assert main_text(f"<div class='{marked}'>x</div><p>y", None, frozenset()) == "y", marked
    for kept in ('title="a hidden valley"', 'title="x aria-hidden=true"', 'data-x="display:none"', 'class="search-results"', 'aria-hidden="false"'):
        assert main_text(f"<p {kept}>x</p>", None, frozenset()) == "x", kept
    for gone in ("hidden", 'aria-hidden="true"', "style='color:red; display : none !important'"):
        assert main_text(f"<p {gone}>x</p><p>y", None, frozenset()) == "y", gone


def test_template_without_article(spark):
    """The slot of the deduced template: what repeats on a host's pages goes."""
    pages = [(i, f"https://h.org/{i}", f"<body><div><p>Welcome to h</p></div><div id=content><p>Story {i}</p><p>{'text ' * (i + 30)}{i}</p></div></body>") for i in range(12)]
    pages += [(90, "https://one.org", "<body><p>Only</p></body>"), (91, None, None), (92, "nonsense", ""), (92, "nonsense", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_main_text(df).collect()}
    for i in range(12):
        assert got[i].split("\n\n") == [f"Story {i}", ("text " * (i + 30)).strip() + f" {i}"]
    assert got[90] == "Only" and got[91] == "" and got[92] == ""
    assert extract_main_text(df).count() == len(pages) and extract_main_text(df.where("false")).collect() == []
    wide = df.selectExpr("*", "'x' AS host", "'y' AS region", "1 AS part", "2 AS text")
    assert {r["page_id"]: r["text"] for r in extract_main_text(wide).collect()} == got


def test_classes_nest_into_a_template():
    elements = [(">html", 1, 9, 0), (">html>body", 1, 9, 5), (">html>body>article", 1, 9, 10), (">html>body>div>article", 2, 9, 99)]
    assert article_path(elements, 9) == ">html>body>article"     # the other's parent is in no class
    assert article_path([(">html", 1, 2, 0)], 2) is None
    assert host_of("HTTPS://A.org:80/x") == "a.org:80" and host_of(None) == "" and host_of("x") == ""


def pages_of(spark, host, bodies):
    rows = [(i, f"https://{host}/{i}", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def texts_of(df):
    return {r["page_id"]: r["text"].split("\n\n") for r in extract_main_text(df).collect()}


def story(i, n=6):
    return [f"Story {i}", *[f"Paragraph {k} of story {i} " + "tells more " * (5 + (i * k) % 7) + f"and ends {i}.{k}" for k in range(n - i % 3)]]


def as_html(blocks):
    return f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])


def want(i):
    return [" ".join(b.split()) for b in story(i)]


def no_word_lists(monkeypatch):
    from hourgrid.llm import html_extract as H

    monkeypatch.setattr(H, "FURNITURE_WORDS", frozenset())
    monkeypatch.setattr(H, "STRONG_WORDS", frozenset())
    H._element.cache_clear()


def test_classes_decide_about_unlisted_comments(spark, monkeypatch):
    """Comments under a class name that no list has, as records of the article and in
    a wrapper; quotes and captions between the paragraphs stay."""
    no_word_lists(monkeypatch)

    def body(i, records):
        quote = f"<blockquote class='q1'><p>Quoted words {i}</p></blockquote>" if i % 2 else f"<div class='pic'><p>A caption {i}</p></div>" * 2
        blocks = story(i)
        return f"<article>{as_html(blocks[:3])}{quote}{''.join(f'<p>{b}</p>' for b in blocks[3:])}{records(i)}</article>"

    def wanted(i):
        return [*want(i)[:3], *([f"Quoted words {i}"] if i % 2 else [f"A caption {i}"] * 2), *want(i)[3:]]

    flat = lambda i: "".join(f"<div class='reader-says'><p>Reader {i}.{k} disagrees</p></div>" for k in range(i % 4))
    wrapped = lambda i: "<section class='zz'>" + "".join(f"<div class='entry-x'><p>Reader {i}.{k} agrees</p></div>" for k in range(1 + i % 4)) + "</section>"
    for records in (flat, wrapped):
        got = texts_of(pages_of(spark, "c.org", [body(i, records) for i in range(12)]))
        assert got == {i: wanted(i) for i in range(12)}


def test_classes_decide_about_repeated_notices(spark, monkeypatch):
    no_word_lists(monkeypatch)
    bodies = [f"<article>{as_html(story(i)[:2])}<p>All rights belong to n.org</p><div class='bar-7'>Read our terms</div>"
              + "".join(f"<p>{b}</p>" for b in story(i)[2:]) + "</article>" for i in range(10)]
    assert texts_of(pages_of(spark, "n.org", bodies)) == {i: want(i) for i in range(10)}
    # copies of one article are no template
    same = f"<article>{as_html(story(1))}</article>"
    assert texts_of(pages_of(spark, "n.org", [same] * 6)) == {i: want(1) for i in range(6)}


def test_three_layouts_on_one_host(spark, monkeypatch):
    no_word_lists(monkeypatch)

    def body(i):
        shell = ("<div class='one'><div class='lead-in'><p>Alpha bar</p></div><div class='story-a'>{}</div></div>",
                 "<section class='two'><section class='story-b'>{}</section><div><p>Beta bar</p></div></section>",
                 "<div class='three'><p>Gamma bar</p><div class='box3'><div class='story-c'>{}</div></div></div>")[i % 3]
        return shell.format(as_html(story(i)))

    got = texts_of(pages_of(spark, "l.org", [body(i) for i in range(30)]))
    assert got == {i: want(i) for i in range(30)}


def test_names_inside_an_article():
    page = "<article><p>Story text that is long enough</p><div class='notice-x'>Note</div><div class='my_comments_3'><p>I say</p></div></article>"
    assert main_text(page, None, frozenset()) == "Story text that is long enough"
    for around in ("page-with-comments", "no-sidebar", "has-ads"):
        assert main_text(f"<div class='{around}'><p>y</p></div>", None, frozenset()) == "y", around


def test_long_pages_and_ties(spark):
    """A very long page, and slots that hold the same text."""
    long = "<article><h1>Long</h1>" + "".join(f"<p>Paragraph number {i}</p>" for i in range(40000)) + "</article>"
    tie = ["<div class='a'><p>Left {0} words</p></div><div class='b'><p>Rite {0} words</p></div>".format(i) for i in range(8)]
    got = texts_of(pages_of(spark, "t.org", [long]))
    assert len(got[0]) == 40001 and got[0][-1] == "Paragraph number 39999"
    first, second = (texts_of(pages_of(spark, "t.org", tie).repartition(n)) for n in (1, 5))
    assert first == second and all(t == [f"Left {i} words", f"Rite {i} words"] for i, t in first.items())
