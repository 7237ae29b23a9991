"""Main text of web pages, with each site's templates removed.

A page's elements are hashed as subtrees (tag, class, and what they hold). Spark counts on how many pages of
a host each subtree occurs; those on many of a host's pages are its template and are
deleted, along with elements whose tag, role or whole class or id name marks them as furniture; names never make furniture of an
article, a main element or what holds one. What is left of the article is cut into blocks.

Guarded: an article (or main element), whatever holds it, and prose in it (paragraphs, headings, lists, quotes,
code, tables) are never a template, however often copied; inside an article only other
elements without prose can be. Without an article or main element, the body is the article, and all its subtrees (but not
single parts of tables) can be a template: such a subtree counts once for every different text that its pages hold besides it, so that
the article of copied pages, which always stands in the same text, counts once, and a menu around different articles counts for each of them.

Pages are parsed twice and never shuffled for counting: only (host, subtree hash) pairs are, counted in the task first, and for pages
without an article (host, subtree hash, hash of the text besides). A host's templates
are bounded, as each is on a share of its pages; the join with the pages is left to the planner, which
splits hot hosts or sends the table of templates if that is small.

Defined cases: a null html gives an empty text; tags left open or cut off are closed at the end; very long
pages are parsed whole; hosts of fewer than ``min_pages`` pages have no templates; repeated rows count as pages of their own; columns of the
input named like a result give way to it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import map_columns
from tickerloom.llm.urlfilter import host_of
from tickerloom.staging import stage

MIN_PAGES = 5
MIN_SHARE = 0.2

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object xmp".split())
SKIPPED = RAW | frozenset("head nav header footer aside form button select dialog menu".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tr td th figcaption".split())
BLOCK = PROSE | frozenset("html body div section article main figure center address details summary fieldset caption thead tbody tfoot hr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Whole class and id names that mark furniture.
MARKS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe signup login "
    "share sharing social comment comments commentlist respond disqus replies related recommended pagination pager toolbar skip form search hidden "
    "cookie-notice cookie-banner cookie-bar cookie-consent cookie-popup cookie-message gdpr-banner consent-banner site-header site-footer site-nav site-navigation "
    "page-footer main-nav main-navigation main-menu nav-menu nav-bar top-nav top-bar topbar bottom-nav footer-nav footer-links global-nav primary-nav primary-menu "
    "secondary-nav nav-links post-navigation navigation-bar mobile-menu mobile-nav side-bar sidebar-left sidebar-right widget-area ad-banner ad-container ad-slot "
    "ad-unit ad-box ad-wrapper advert-box banner-ad google-ad adsbygoogle sponsored-content promo-box newsletter-signup newsletter-form email-signup subscribe-form "
    "subscribe-box login-form search-form search-box search-bar searchform social-share social-links social-media share-buttons share-links share-bar sharing-buttons "
    "comment-form comment-list comments-area comments-section comment-respond disqus_thread related-posts related-articles related-content related-links "
    "recommended-posts page-navigation skip-link skip-links skip-to-content skip-nav screen-reader-text popup-overlay modal-dialog modal-content contact-form".split()
)
#: Class names that show at some width what another hides.
SHOWN = re.compile(r":(?:block|flex|grid|inline\S*|table\S*|contents|visible)$")
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"\s+")
#: Parts of tables, which are never a template by themselves.
CELLS = frozenset("tr td th thead tbody tfoot caption".split())
#: Elements that the start of these others closes, if it stands open nearest.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

RESULTS = "text string, n_chars long"


class Node:
    __slots__ = ("tag", "mark", "furniture", "by_tag", "children", "digest", "prose", "said")

    def __init__(self, tag: str, mark: str = "", by_tag: bool = False, by_name: bool = False):
        self.tag, self.mark, self.by_tag, self.furniture = tag, mark, by_tag, by_tag or by_name
        self.children: list[Node | str] = []
        self.digest = self.said = 0
        self.prose = tag in PROSE


def parse(html: str) -> Node:
    """The page as a tree. Ends without a start are dropped; an end closes what stands open inside it."""
    root = Node("html")
    stack = [root]
    at = 0
    for m in TOKEN.finditer(html):
        if m.start() < at:
            continue
        if m.start() > at:
            stack[-1].children.append(html[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        closing = CLOSES.get(tag)
        if closing and stack[-1].tag in closing:
            stack.pop()
        if tag in BLOCK and stack[-1].tag == "p":
            stack.pop()
        elif tag in BLOCK and tag in PROSE:
            # a paragraph left open around inline elements ends where the next block begins
            depth = len(stack) - 1
            while depth > 0 and stack[depth].tag not in BLOCK and stack[depth].tag not in SKIPPED:
                depth -= 1
            if stack[depth].tag == "p":
                del stack[depth:]
        attributes = {k.lower(): unescape(a or b or c or "") for k, a, b, c in ATTRIBUTE.findall(m[3])} if m[3].strip(" /\n\t") else {}
        mark = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip().lower()
        by_tag = tag in SKIPPED or attributes.get("role", "").lower() in ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true"
        node = Node(tag, mark, by_tag, tag not in ("html", "body") and named_furniture(mark))
        stack[-1].children.append(node)
        if tag in ("article", "main"):
            for holder in (node, *stack):
                holder.furniture = holder.by_tag
        if tag not in VOID:
            stack.append(node)
    if at < len(html):
        stack[-1].children.append(html[at:])
    return root


def named_furniture(mark: str) -> bool:
    """Whether a class or id name, taken whole, marks furniture."""
    found = MARKS.intersection(mark.split())
    return bool(found) and not (found == {"hidden"} and any(map(SHOWN.search, mark.split())))


def tidy(text: str) -> str:
    return SPACE.sub(" ", unescape(text)).strip()


def seal(root: Node) -> None:
    """Work out every subtree's hash, the sum of its texts' hashes, and whether it holds prose; children first, without recursion."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if isinstance(c, Node)]
    for node in reversed(order):
        hasher = blake2b(f"{node.tag}\x00{node.mark}".encode("utf-8", "replace"), digest_size=8)
        for child in node.children:
            if isinstance(child, Node):
                hasher.update(b"\x01" + child.digest.to_bytes(8, "big", signed=True))
                node.prose = node.prose or child.prose
                node.said += 0 if child.furniture else child.said
            else:
                text = tidy(child).encode("utf-8", "replace")
                hasher.update(b"\x02" + text)
                if text:
                    node.said += int.from_bytes(blake2b(text, digest_size=8).digest(), "big")
        node.digest = int.from_bytes(hasher.digest(), "big", signed=True)


def articles(root: Node) -> list[Node]:
    """The page's main parts: its outermost articles, or main elements, that aren't furniture; else the whole page."""
    for wanted in ("article", "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.furniture:
                continue
            if node.tag == wanted:
                found.append(node)
                continue
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]
        if found:
            return found
    return [root]


def candidates(root: Node) -> dict[int, int | None]:
    """Hashes of the subtrees that can be a template: all outside the main parts, and those without prose in them.

    On pages without a main part all but parts of tables; these have the hash of the rest of the page's text, the others None.
    """
    mains = articles(root)
    inside = {id(m) for m in mains}
    whole = mains == [root]
    holds: set[int] = set()
    out: dict[int, int | None] = {}
    order, todo = [], [(root, False, False)]
    while todo:
        node, in_main, gone = todo.pop()
        in_main = in_main or id(node) in inside
        gone = gone or (node.furniture and node is not root)
        order.append((node, in_main, gone))
        todo += [(c, in_main, gone) for c in node.children if isinstance(c, Node)]
    for node, in_main, gone in reversed(order):
        if id(node) in inside or any(id(c) in holds for c in node.children if isinstance(c, Node)):
            holds.add(id(node))
        elif node.tag not in BLOCK or gone:
            continue
        elif not whole:
            if not (in_main and node.prose):
                out[node.digest] = None
        elif node.tag not in CELLS:
            out[node.digest] = (root.said - node.said + 2**63) % 2**64 - 2**63
    return out


def main_text(html: str | None, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """Blocks of the main parts, in page order, joined by newlines."""
    if not html:
        return ""
    root = parse(html)
    if templates:
        seal(root)
        deletable = candidates(root).keys() & templates
    else:
        deletable = set()
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = tidy("".join(run))
        run.clear()
        if text:
            blocks.append(text)

    for main in articles(root):
        todo: list[Node | str | None] = [main]
        while todo:
            node = todo.pop()
            if node is None:
                close()
            elif isinstance(node, str):
                run.append(node)
            elif node.tag == "br":
                run.append(" ")
            elif not (node.furniture and node is not main) and node.digest not in deletable:
                if node.tag in BLOCK:
                    close()
                    todo.append(None)
                todo += reversed(node.children)
        close()
    return "\n".join(blocks)


def count_subtrees(pages: DataFrame) -> DataFrame:
    """host, digest and the number of the host's pages that hold it, on pages without an article that of the different texts besides it; digest null counts all pages of the host."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            keys = list(counts)
            made = [pa.array([k[i] for k in keys], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
            return pa.RecordBatch.from_arrays([*made, pa.array([counts[k] for k in keys], pa.int64())], names=["host", "digest", "rest", "pages"])

        counts: Counter[tuple[str, int | None, int | None]] = Counter()
        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[host, None, None] += 1
                if html:
                    root = parse(html)
                    seal(root)
                    counts.update((host, d, rest) for d, rest in candidates(root).items())
                if len(counts) > 100_000:
                    yield flush()
                    counts = Counter()
        yield flush()

    found = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, digest long, rest long, pages long")
    pairs = found.groupBy("host", "digest", "rest").agg(F.sum("pages").alias("pages"))
    return pairs.groupBy("host", "digest").agg(F.sum(F.when(F.col("rest").isNull(), F.col("pages")).otherwise(1)).alias("pages"))


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per host that has templates: host and their hashes. A host's list is bounded by its pages' size over ``min_share``."""
    counts = stage(count_subtrees(pages), "subtrees")
    totals = counts.where("digest IS NULL").select(F.col("host").alias("of"), F.col("pages").alias("total"))
    often = counts.where((F.col("pages") >= min_pages) & F.col("digest").isNotNull()).join(totals, F.col("host") == F.col("of"))
    return often.where(F.col("pages") >= min_share * F.col("total")).groupBy("host").agg(F.sort_array(F.collect_list("digest")).alias("templates"))


def extract(pages: DataFrame, carry: Sequence[str] = ("page_id", "url"), min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Main text of every page and its length in code points."""
    templates = stage(site_templates(pages, min_pages, min_share), "templates").withColumnRenamed("host", "template_host")
    rows = pages.withColumn("page_host", host_of(F.col("url")))
    joined = rows.join(templates, F.col("page_host") == F.col("template_host"), "left")

    def make():
        cache: dict[tuple[int, ...], frozenset[int]] = {}

        def work(htmls: pa.Array, lists: pa.Array):
            texts = []
            for html, found in zip(htmls.to_pylist(), lists.to_pylist()):
                key = tuple(found or ())
                if key not in cache:
                    if len(cache) > 100:
                        cache.clear()
                    cache[key] = frozenset(key)
                texts.append(main_text(html, cache[key]))
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

        return work

    return map_columns(joined, [F.col("html"), F.col("templates")], RESULTS, make, carry)
