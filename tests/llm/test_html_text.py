"""Main text of pages: made-up markup, the given pages against their articles, templates."""

import html
import random
import re

from pyspark.sql import functions as F

from daygrain.llm import html_text
from daygrain.llm.common import Scratch
from daygrain.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.01"


def text(page):
    return html_text.text_of(html_text.parse(page))


def test_markup():
    assert text("") == "" and text("plain  text\n here") == "plain text here"
    assert text("<article><h1>T &amp; &lt;b&gt;</h1><p>One <b>two<br>three<p>four</article><p>not this") == "T & <b>\nOne two\nthree\nfour"
    page = "<body><header>H</header><nav>N</nav><p>keep</p><div class='ad'>A</div><div id=cookie-notice>C</div><aside>S</aside><form><p>F</p></form><footer>Z</footer>"
    assert text(page) == "keep"
    assert text("<main><header><h1>Own</h1></header><p>a</p><section class='comments'><article>c</article></section></main>") == "Own\na"
    assert text("<article><p>x</p><section id=comments><p>no</p></section><p>y</article>") == "x\ny"
    assert text("<script>var a='</p><p>no'</script><style>p{}</style><p>1 < 2 &eacute;&#x41;&#66;&nbsp;c</p>") == "1 < 2 éAB c"
    assert text("<p>a<!-- <p>no</p> -->b</p><p>c<!-- open") == "ab\nc"
    assert text("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>") == "one\ntwo\na\nb\nc"
    assert text("<article><p>a</p><article><p>teaser</p></article></article>") == "a"
    assert text("<p>x" + "<div>" * 30_000 + "deep") == "x\ndeep"
    assert text("<article><p>open to the end") == "open to the end"


def articles(page):
    """The articles of the given pages, whose markup is simple: their blocks by splitting at tags."""
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    parts = (" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in re.split(r"</?(?:p|h1|br)>", inner))
    return "\n".join(p for p in parts if p)


def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = QUERIES["op2_html_text"](spark, FOLDER).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == articles(pages[r.page_id].html) and r.n_chars == len(r.text)


def test_templates_are_removed(spark):
    body = "<div class=x><p>Welcome to our site</p><span>since 1990</span></div><div><p>Story {k} of the day</p><p>It rained.</p></div>"
    rows = [(k, f"http://a.com/{k}", body.format(k=k)) for k in range(12)]
    rows += [(100 + k, f"http://b{k}.com/", body.format(k=k)) for k in range(12)]
    rows += [(200, None, None), (201, "http://a.com/", ""), (202, "nothing", "<p>" + "long " * 100_000), (3, "http://a.com/3", body.format(k=3))]
    pages = spark.createDataFrame([(*r, "v") for r in rows], "page_id long, url string, html string, host string")
    got = html_text.extract(pages)
    texts = {r.page_id: r.text for r in got.collect()}
    assert texts[3] == "Story 3 of the day"
    assert texts[103] == "Welcome to our site\nsince 1990\nStory 3 of the day\nIt rained."
    assert texts[200] == texts[201] == "" and len(texts[202]) == 499_999
    assert got.count() == len(rows) and html_text.extract(pages.where(F.lit(False))).collect() == []


def by_loops(rows):
    """The template digests of each host, by counting in Python."""
    seen, pages = {}, {}
    for host, page in rows:
        root = html_text.parse(page)
        outside, inside, whole = html_text.digests(root, html_text.main_of(root))
        pages.setdefault(host, set()).add(whole)
        for inner, found in ((False, outside), (True, inside)):
            for d in found.values():
                seen.setdefault((host, inner, d), set()).add(whole)
    out = {}
    for (host, inner, d), on in seen.items():
        least, share = ((html_text.INNER_PAGES, html_text.INNER_SHARE) if inner else (html_text.MIN_PAGES, html_text.MIN_SHARE))
        if len(on) > least and len(on) > share * len(pages[host]):
            out.setdefault(host, (set(), set()))[inner].add(d)
    return out


def test_template_sets_equal_loops(spark):
    rnd = random.Random(2)
    lines = [f"<p>line {k}</p>" for k in range(6)]
    rows = []
    for k in range(300):
        host = rnd.choice(["a", "a", "b", "c", ""])
        body = "".join(line for line in lines if rnd.random() < {"a": 0.9, "b": 0.15}.get(host, 0.5)) + f"<p>own {rnd.randrange(60)}</p>"
        rows.append((host, rnd.choice([f"<div>{body}</div>", f"<p>menu</p><article>{body}</article>", body])))
    rows += rows[:40]
    pages = spark.createDataFrame(rows, "host string, html string").repartition(4)
    found = html_text.templates(pages, Scratch(spark, "t")).collect()
    assert {r.host: (set(r.outer), set(r.inner)) for r in found} == by_loops(rows)


def test_pages_are_never_emptied(spark):
    """A page that a third of the host's rows repeat is one page; one that is all template keeps its text."""
    rows = [(k, "http://a.com/x", "<html><body><p>The same page.</p></body></html>") for k in range(10)]
    rows += [(100 + k, "http://a.com/y", f"<html><body><div>Welcome</div><p>Page {k}</p></body></html>") for k in range(20)]
    rows += [(200, "http://a.com/z", "<html><body><div>Welcome</div></body></html>")]
    texts = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {texts[k] for k in range(10)} == {"The same page."}
    assert {texts[100 + k] for k in range(20)} == {f"Page {k}" for k in range(20)} and texts[200] == "Welcome"


def test_names_inside_the_main_content():
    for mark in ("class=social-history", "class=comments-on-law", "id=related-work", "class=advertising-theory"):
        assert text(f"<article><p>a</p><div {mark}>kept</div></article>") == "a\nkept"
    for mark in ("class=comments", "class='wide newsletter'", "id=share", "class=ad"):
        assert text(f"<article><p>a</p><div {mark}>gone</div></article>") == "a"


def test_what_all_pages_say_inside_their_article(spark):
    """A notice without a name on every article of the host goes, a paragraph quoted on half of them stays."""
    page = "<article><p>Story {k}</p>{quote}<div>Read more on our front page</div></article>"
    rows = [(k, "http://a.com/", page.format(k=k, quote="<p>As was said.</p>" if k % 2 else "")) for k in range(40)]
    texts = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert texts[3] == "Story 3\nAs was said." and texts[4] == "Story 4"


def test_repeated_paragraphs_of_articles_stay(spark):
    rows = [(k, f"http://a.com/{k}", f"<p>Menu</p><article><p>Same words.</p><p>Page {k}</p></article>") for k in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in html_text.extract(pages).collect()} == {f"Same words.\nPage {k}" for k in range(12)}
