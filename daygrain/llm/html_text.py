"""Main text of web pages: site templates are found by counting element subtrees per host.

Every page is read as a tree of elements; tags that were never closed are closed where the next
block or their parent ends. Each element that holds text gets a digest of its whole subtree: tags,
class and role, and text. Spark counts on how many different pages of each host a digest occurs; a page that
is there repeatedly is one page. Outside the main content (`article` or `main`, where a page has one) a
subtree on more than `MIN_PAGES` pages and more than `MIN_SHARE` of the host's is the site's template and is deleted. Inside
it articles repeat whole paragraphs with reason, so there it takes `INNER_PAGES` and `INNER_SHARE`: what nearly every page of
the host says. A page that would have no text left keeps all of it.

Elements that are never main text go whatever their count: head, scripts, styles, forms, navigation,
page headers and footers, asides. If a page has an `article` or `main`, its text is that element's;
an article inside another one (a reader's comment, a teaser) is not. In there an element goes by name only if
a whole word of its class or id is one of `INNER_NAMES`; on pages without main content, where nothing else tells a menu,
sidebar, notice, advert or comment on a single page, by part of the name, too.

Text is joined per block: character references decoded, white space made one space, trimmed, empty
blocks dropped, blocks joined by a newline. NULL or empty html has an empty text, a NULL url the host
''. Malformed html never fails: a `<` that begins no tag is text. Very long pages are read whole. There are no ties:
a digest is counted or not. A host with a large part of all pages is only counted, by partial aggregates, and its templates
(few, since each covers a share of its pages) come back by a join on the host that broadcasts those
of hot hosts. Empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import Scratch, attach, hot_keys
from daygrain.llm.url_filter import host_and_path

MIN_PAGES = 5
MIN_SHARE = 0.2
# The same within the main content.
INNER_PAGES = 20
INNER_SHARE = 0.8

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
# What an opening tag closes if it is still open, and where that search stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CLOSES_P = BLOCKS - {"body", "html", "br", "caption", "dd", "dt", "legend", "li", "optgroup", "option", "summary", "tbody", "td", "tfoot", "th", "thead", "title", "tr"}
NEVER_TEXT = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form head iframe input label map math menu nav noscript "
    "object script search select style svg template textarea title video".split()
)
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar toolbar alert alertdialog dialog form".split())
NEVER_NAMES = re.compile(
    r"(?:^|[-_ ])(?:ad|ads|advert\w*|adsbygoogle|banner|breadcrumbs?|comments?|comment-?list|cookies?|consent|disclaimer|footer|"
    r"gdpr|masthead|menu|nav|navbar|navigation|newsletter|notices?|popup|promo\w*|related|respond|share|sharing|sidebar|skip|social|"
    r"sponsor\w*|subscribe|toolbar|widget)(?:$|[-_ ])",
    re.I,
)

# Whole words of class or id that name what is no article text even inside an article.
INNER_NAMES = frozenset(
    "ad ads advert advertisement adsbygoogle comments comment-list cookie-notice newsletter share sharing sidebar".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)|"
    r"<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(/?)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s=])|aria-hidden\s*=\s*[\"']?true", re.I)


@dataclass(slots=True)
class Element:
    tag: str
    marks: str = ""  # class, id and role
    role: str = ""
    hidden: bool = False
    parts: list = field(default_factory=list)  # texts and elements, in order


def parse(page: str) -> Element:
    """The tree of a page."""
    root = Element("#page")
    stack = [root]
    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        if found is None:
            stack[-1].parts.append(page[at:])
            break
        if found.start() > at:
            stack[-1].parts.append(page[at : found.start()])
        at = found.end()
        closing, opening = found.group(1), found.group(2)
        if closing:
            tag = closing.lower()
            if tag in ("p", "br") and not any(e.tag == tag for e in stack):
                stack[-1].parts.append(Element(tag))
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break  # an inline end tag closes nothing outside its block
        elif opening:
            tag = opening.lower()
            if tag in CLOSES:
                ends, stops = CLOSES[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in stops:
                        break
                    if stack[k].tag in ends:
                        del stack[k:]
                        break
            elif tag in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == "p":
                        del stack[k:]
                        break
                    if stack[k].tag in BLOCKS:
                        break
            element = Element(tag)
            if found.group(3):
                named = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(found.group(3))}
                element.role = named.get("role", "").lower()
                element.marks = " ".join(v for k, v in sorted(named.items()))
                element.hidden = bool(_HIDDEN.search(found.group(3)))
            stack[-1].parts.append(element)
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])[^>]*(?:>|$)", re.I).search(page, at)
                element.parts.append(page[at : end.start()] if end else page[at:])
                at = end.end() if end else size
            elif tag not in VOID and not found.group(4):
                stack.append(element)
    return root


def never_text(element: Element, inside: bool) -> bool:
    """`inside`: within the main content, where a header is the article's own."""
    tag = element.tag
    if tag in NEVER_TEXT or element.role in NEVER_ROLES or element.hidden:
        return True
    if tag == "header":
        return not inside
    if tag in ("body", "html", "main", "#page"):
        return False
    if inside:
        return not INNER_NAMES.isdisjoint(element.marks.lower().split())
    return bool(element.marks and NEVER_NAMES.search(element.marks))


def main_of(root: Element) -> list[Element]:
    """The outermost article or main elements that are not part of a menu, aside or comment."""
    out, todo = [], [root]
    while todo:
        element = todo.pop()
        if element.tag == "article" or element.tag == "main" or element.role == "main":
            out.append(element)
        elif not never_text(element, False):
            todo.extend(e for e in reversed(element.parts) if isinstance(e, Element))
    articles = [a for m in out if m.tag != "article" for a in _articles(m)]
    return articles or out


def _articles(element: Element) -> list[Element]:
    """Articles inside a main element."""
    out, todo = [], [e for e in reversed(element.parts) if isinstance(e, Element)]
    while todo:
        found = todo.pop()
        if found.tag == "article":
            if not never_text(found, True):
                out.append(found)
        elif not never_text(found, True):
            todo.extend(e for e in reversed(found.parts) if isinstance(e, Element))
    return out


def digests(root: Element, mains: list[Element]) -> tuple[dict[int, int], dict[int, int], int]:
    """64-bit digests of the subtrees that hold text, by the element's identity: outside and inside
    the main content; and the digest of the whole page.

    The main content itself and the elements around it have none.
    """
    tops = {id(e) for e in mains}
    # Children before parents, without recursion: pages may be nested deeply.
    order: list[tuple[Element, bool]] = []
    todo = [(root, False)]
    while todo:
        element, inside = todo.pop()
        order.append((element, inside))
        inside |= id(element) in tops
        todo.extend((e, inside) for e in element.parts if isinstance(e, Element))
    around: set[int] = set()
    whole: dict[int, bytes] = {}
    textual: set[int] = set()
    found: tuple[dict[int, int], dict[int, int]] = ({}, {})
    for element, inside in reversed(order):
        key = id(element)
        sums = hashlib.md5(f"{element.tag}\x00{element.marks}".encode("utf-8", "replace"))
        for part in element.parts:
            if isinstance(part, str):
                words = " ".join(part.split())
                if words:
                    textual.add(key)
                sums.update(b"\x01" + words.encode("utf-8", "replace"))
            else:
                sums.update(b"\x02" + whole[id(part)])
                if id(part) in textual:
                    textual.add(key)
                if id(part) in tops or id(part) in around:
                    around.add(key)
        whole[key] = sums.digest()
        if key in textual and key not in around and key not in tops and element is not root:
            found[inside][key] = int.from_bytes(whole[key][:8], "big", signed=True)
    return (*found, int.from_bytes(whole[id(root)][:8], "big", signed=True))


def text_of(root: Element, outer: frozenset = frozenset(), inner: frozenset = frozenset()) -> str:
    """The main text, without subtrees whose digest is a template outside or inside the main content.

    A page whose whole text is templates keeps it.
    """
    mains = main_of(root)
    if outer or inner:
        outside, inside, _ = digests(root, mains)
        gone = {k for k, d in outside.items() if d in outer} | {k for k, d in inside.items() if d in inner}
        if gone and (text := _text(root, mains, gone)):
            return text
    return _text(root, mains, set())


def _text(root: Element, mains: list[Element], gone: set[int]) -> str:
    blocks: list[str] = []
    line: list[str] = []

    def close():
        text = " ".join(html.unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    # (element or text or None for the end of a block, within the main content)
    todo: list = [(e, bool(mains)) for e in reversed(mains or [root])]
    tops = {id(e) for e in mains}
    while todo:
        part, inside = todo.pop()
        if part is None:
            close()
        elif isinstance(part, str):
            line.append(part)
        else:
            own = id(part) in tops
            if not own and (never_text(part, inside) or id(part) in gone or (inside and part.tag == "article")):
                if part.tag in BLOCKS:
                    close()
                continue
            if part.tag in BLOCKS:
                close()
                todo.append((None, inside))
            todo.extend((e, inside) for e in reversed(part.parts))
    close()
    return "\n".join(blocks)


def _page_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, inner, digest, page) for each subtree of each page; a page itself has the digest NULL."""
    for batch in batches:
        hosts, inner, found, pages = [], [], [], []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            root = parse(page.as_py() or "")
            outside, inside, whole = digests(root, main_of(root))
            own = [(False, None), *((False, d) for d in set(outside.values())), *((True, d) for d in set(inside.values()))]
            hosts.extend([host] * len(own))
            inner.extend(k for k, _ in own)
            found.extend(d for _, d in own)
            pages.extend([whole] * len(own))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(inner, pa.bool_()), pa.array(found, pa.int64()), pa.array(pages, pa.int64())],
            ["host", "inner", "digest", "page"],
        )


def templates(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, html) to (host, outer, inner): digests of the subtrees that recur on the host.

    A page has at most as many template subtrees as elements, and each covers a share of the
    host's pages, so a host's lists are bounded by the elements of 1 / MIN_SHARE pages.
    """
    counted = (
        pages.select("host", "html")
        .mapInArrow(_page_digests, "host string, inner boolean, digest long, page long")
        .groupBy("host", "inner", "digest", "page").agg(F.lit(1).alias("once"))
        .groupBy("host", "inner", "digest").agg(F.count(F.lit(1)).alias("n"))
    )
    least = F.when(F.col("inner"), INNER_PAGES).otherwise(MIN_PAGES)
    counted = scratch.save(counted.where(F.col("digest").isNull() | (F.col("n") > least)), "recurring")
    sizes = counted.where("digest IS NULL").select("host", F.col("n").alias("pages"))
    share = F.when(F.col("inner"), INNER_SHARE).otherwise(MIN_SHARE)
    return (
        counted.where("digest IS NOT NULL").join(sizes, "host").where(F.col("n") > share * F.col("pages"))
        .groupBy("host").agg(
            F.collect_list(F.when(~F.col("inner"), F.col("digest"))).alias("outer"),
            F.collect_list(F.when(F.col("inner"), F.col("digest"))).alias("inner"),
        )
    )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, *known in zip(batch.column(2), batch.column(3), batch.column(4)):
            source = page.as_py()
            texts.append(text_of(parse(source), *(frozenset(k.as_py() or ()) for k in known)) if source else "")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    scratch = Scratch(pages.sparkSession, "html-text")
    host, _ = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"), host.alias("host"))
    found = scratch.save(templates(rows, scratch), "templates")
    # Only hosts that have a template need the join.
    hot = scratch.save(hot_keys(rows.select("host"), "host").join(found.select("host"), "host", "left_semi"), "hot")
    joined = attach(rows, found, "host", hot).select("page_id", "url", "html", "outer", "inner")
    return joined.mapInArrow(_texts, "page_id long, url string, text string").withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
