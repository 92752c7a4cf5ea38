"""Main text of web pages by site template removal.

Every page is parsed into elements. The subtrees of block elements are hashed (tags and text, white space apart) and
counted in Spark for each host; one that stands beside at least ``MIN_PAGES`` different texts is
template, and is deleted from that host's pages. What stands beside it is one block of the rest of the page, drawn by a hash with a
chance that follows its length: copies of a page draw the same and count once, near copies mostly so. A page on which less
than a fifth of the text is beside a subtree says nothing about it, unless the subtree is mostly links. Elements that markup itself names as no content
(menus, forms, adverts, comments of readers and so on: ``DROPPED_TAGS``, ``DROPPED_ROLES``, ``DROPPED_NAMES``) go too, as on hosts
with few pages nothing recurs. In ``article`` and ``main`` elements real text recurs as well (headings, licence lines), so what is not
mostly links must there stand beside as many different texts as ``MAIN_SHARE`` of the host's different pages with such elements too. If
what is left of these elements is at least half of what is left of the page, only they count, else the whole page does.
Containers whose whole class means adverts, readers' comments, notices or a sidebar (``CERTAIN_NAMES``; for comments and sidebars also the id), and
footers, asides and menus, go in main content too and however long they are, as long as paragraphs or main content of their own
remain beside them; so the text of a page that is nothing but comments or one form stays. Headers with a heading of the article stay.

Blocks are what block elements bound; character references are decoded, white space becomes one space, and
blocks are joined by line feeds. Elements left open are closed as browsers do. Null and empty pages, and pages without text outside templates, have
the empty text; pages without a host share one. Repeated rows count as pages of their own. An empty table gives an empty result;
of further columns only those asked for are kept.
"""

import html
import re
import zlib
from itertools import accumulate
from math import log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .url_reputation import host_of

MIN_PAGES = 5
MOST = 4  # times the rest of the page
MAIN_SHARE = 0.5
LINK_SHARE = 0.5
MIN_NAMED = 2  # different texts beside a subtree whose name says that it is no content
_INSIDE = 0x2545F4914F6CDD1D  # marks the hash of a subtree in main content
_NAMED = 0x1B873593CC9E2D51  # of one with such a name

# What HTML says about elements, and names that sites give to what is no content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
TO_THE_END = frozenset("script style textarea title".split())  # without an end tag they hold the rest of the page
FOREIGN = frozenset(("svg", "math"))
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPES = frozenset("article aside body div footer form header html main nav ol section table td th ul button".split())
DROPPED_TAGS = frozenset("head nav footer aside form button select option input script style textarea title noscript template iframe svg dialog menu".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
DROPPED_NAMES = frozenset("ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices newsletter subscribe signup login popup modal overlay share sharing social related recommended comment comments disqus replies respond pagination pager toolbar".split())
WHOLE_NAMES = DROPPED_NAMES | frozenset("share-buttons share-links social-links social-share related-posts related-articles post-navigation comments-area comment-list comment-body cookie-notice cookie-banner newsletter-signup".split())
AD_NAMES = frozenset("ad ads advert adverts advertisement adsense adsbygoogle".split())
COMMENT_NAMES = frozenset("comment comments comments-area comment-list commentlist comment-body disqus disqus_thread replies respond".split())
CERTAIN_NAMES = AD_NAMES | COMMENT_NAMES | frozenset("sponsored sidebar cookie-notice cookie-banner cookie-consent cookies gdpr newsletter-signup".split())
CERTAIN_IDS = COMMENT_NAMES | frozenset(["sidebar"])
CERTAIN_TAGS = frozenset("footer aside nav".split())
NO_TEXT = frozenset("head script style textarea title noscript template iframe svg select option input button".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dt dd li td th figcaption caption".split())
MAIN_NAMES = frozenset(("article", "main"))
PROSE_TAGS = frozenset("p blockquote pre article main".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_NAME = re.compile(r"[a-z0-9]+")


class Element:
    __slots__ = ("tag", "attributes", "children", "hash", "has_main", "chars", "link_chars", "first", "end", "inside", "whole", "certain", "holds_main", "has_heading", "has_nav", "free", "prose", "left")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []


def foreign_at(stack: list[Element]) -> int:
    """Where on the stack the innermost ``svg`` or ``math`` element is, 0 for nowhere."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in FOREIGN:
            return k
        if stack[k].tag in BLOCKS:
            break
    return 0


def parse(page: str) -> Element:
    """The element tree; children are elements and decoded texts."""
    root = Element("html")
    stack, at = [root], 0
    match = _TOKEN.search(page)
    while match:
        if match.start() > at:
            stack[-1].children.append(html.unescape(page[at:match.start()]))
        at = match.end()
        tag = (match[2] or "").lower()
        if tag and match[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
        elif tag and tag not in ("html",):
            foreign = foreign_at(stack)
            if foreign and tag in BLOCKS and not any(e.tag in ("foreignobject", "annotation-xml") for e in stack[foreign:]):
                del stack[foreign:]  # a block ends a drawing or formula that was left open
                foreign = 0
            closes = CLOSES.get(tag, {"p"} if tag in BLOCKS else ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closes or tag in BLOCKS and stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in SCOPES and not (tag == "tr" and stack[k].tag in ("td", "th")):
                    break
            element = Element(tag, match[3])
            stack[-1].children.append(element)
            if match[3].endswith("/") and (foreign or tag in FOREIGN):
                pass  # the slash closes an element here; HTML ignores it elsewhere
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page) if tag in TO_THE_END else at
            elif tag not in VOID:
                stack.append(element)
        match = _TOKEN.search(page, at)
    if at < len(page):
        stack[-1].children.append(html.unescape(page[at:]))
    return root


def names_no_content(element: Element) -> int:
    """2 if a class of the element is a name of what is no content, 1 if a piece of a class or id is, 0 if none."""
    level = 0
    if "class" in element.attributes.lower() or "id" in element.attributes.lower():
        for name, a, b, c in _ATTRIBUTE.findall(element.attributes):
            name, text = name.lower(), (a or b or c).lower()
            if name == "class" and not WHOLE_NAMES.isdisjoint(text.split()):
                return 2
            if name in ("class", "id") and not DROPPED_NAMES.isdisjoint(_NAME.findall(text)):
                level = 1
    return level


def certainty(element: Element) -> int:
    """Not 0 if a whole class or id of this container, or any element's class for adverts, leaves no doubt that it is no content: 2 for
    comments, which may hold articles, and 1 for others, which may be wrapped around main content."""
    tag, attributes = element.tag, element.attributes.lower()
    if tag in ("html", "body") or "class" not in attributes and "id" not in attributes:
        return 0
    wanted = COMMENT_NAMES if tag in MAIN_NAMES else CERTAIN_NAMES if tag in BLOCKS and tag not in TEXT_TAGS else AD_NAMES
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        said = wanted.intersection((a or b or c).split()) if name == "class" else wanted & CERTAIN_IDS & {(a or b or c).strip()} if name == "id" else ()
        if said:
            return 1 if COMMENT_NAMES.isdisjoint(said) else 2
    return 0


def is_dropped(element: Element, templates: frozenset | set = frozenset()) -> bool:
    """Whether markup says that this is no content. What holds most of the text of the page, or of its main element, is content
    unless it is mostly links, or certainly is none and leaves other paragraphs there. A name alone is enough only if it is a whole class of a container outside main content; else
    the element must also be mostly links or recur on the host, and in main content ids and pieces of names say nothing."""
    if element.tag in NO_TEXT:
        return True
    if element.left and (element.certain == 2 or not element.holds_main and (element.certain or element.tag in CERTAIN_TAGS)):
        return True
    links = element.link_chars >= LINK_SHARE * element.chars and element.chars > 0
    if 2 * element.chars > element.whole and not links:
        return False
    if element.tag in DROPPED_TAGS:
        return True
    if element.tag == "header":
        if any(isinstance(c, Element) and c.tag in ("h1", "h2") for c in element.children):
            return False
        return not element.has_heading or element.has_nav and not element.inside
    if not element.attributes.strip() or element.tag in ("html", "body", *MAIN_NAMES) and "comment" not in element.attributes.lower():
        return False
    for name, a, b, c in _ATTRIBUTE.findall(element.attributes):
        name, text = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and text == "true" or name == "style" and "display:none" in text.replace(" ", ""):
            return True
        if name == "role" and text.strip() in DROPPED_ROLES:
            return True
    level = names_no_content(element)
    if level == 2 and not element.inside and element.tag not in TEXT_TAGS and (element.tag in BLOCKS or "comment" not in element.attributes.lower()):
        return True
    return level > element.inside and (links or element.hash ^ _NAMED in templates)


def measure(root: Element) -> None:
    """Hash, text length and link share of every element, children first, with what it holds; then whether it is in main content, and how much
    text its main element or else the page has, and how much of that is in paragraphs that are not in what is certainly no content."""
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        todo += [c for c in element.children if isinstance(c, Element)]
    for element in reversed(order):
        parts, element.chars, element.link_chars = [element.tag], 0, 0
        element.certain = certainty(element)
        element.has_main = element.tag in MAIN_NAMES
        element.holds_main = element.has_heading = element.has_nav = False
        element.free = prose = 0
        for child in element.children:
            if isinstance(child, Element):
                parts.append(f"<{child.hash}>")
                element.chars += child.chars
                element.link_chars += child.link_chars
                element.has_main |= child.has_main
                element.holds_main |= child.holds_main or child.tag in MAIN_NAMES and not child.certain
                element.has_heading |= child.has_heading or child.tag in ("h1", "h2")
                element.has_nav |= child.has_nav or child.tag == "nav"
                element.free += child.free
                prose += child.prose
            elif text := " ".join(child.split()):
                parts.append(text)
                element.chars += len(text)
                element.free += len(text)
        if element.tag == "a" or element.tag == "header" or element.tag in DROPPED_TAGS or element.certain == 2 or element.certain and not element.holds_main:
            element.free = prose = 0
        element.prose = element.free if element.tag in PROSE_TAGS else prose
        if element.tag == "a":
            element.link_chars = element.chars
        elif element.tag in NO_TEXT:
            element.chars = element.link_chars = 0
        element.hash = xxhash.xxh3_64_intdigest("\n".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)
    root.inside, root.whole, root.left = False, root.chars, root.prose
    for element in order:
        starts = element.tag in MAIN_NAMES and not element.inside
        within = (True, element.chars, element.prose) if starts else (element.inside, element.whole, element.left)
        for child in element.children:
            if isinstance(child, Element):
                child.inside, child.whole, child.left = within


def candidates(root: Element):
    """``(element, mark, kind)`` of the block elements that may be template, their hashes marked and of kind 1 if they are in main
    content or hold such and are not mostly links; and of elements whose name says that they are no content, as kind 3."""
    todo = [root]
    while todo:
        element = todo.pop()
        if element.tag in BLOCKS and element.chars:
            strict = (element.inside or element.has_main) and element.link_chars < LINK_SHARE * element.chars
            yield element, element.hash ^ _INSIDE if strict else element.hash, int(strict)
        if element.chars and names_no_content(element) > element.inside:
            yield element, element.hash ^ _NAMED, 3
        todo += [c for c in element.children if isinstance(c, Element)]


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def draws(root: Element) -> list[tuple[float, int]]:
    """Each text of the page, in order, with its lot; the least lot of some texts is drawn, in proportion to their lengths.

    Elements are told which texts they hold.
    """
    lots, todo = [], [(root, False)]
    while todo:
        node, done = todo.pop()
        if done:
            node.end = len(lots)
        elif isinstance(node, Element):
            node.first = len(lots)
            todo.append((node, True))
            todo += [(c, False) for c in reversed(node.children)]
        elif text := " ".join(node.split()):
            found = text_hash(text)
            lots.append((-log((found + 1) / (2 ** 64 + 1)) / len(text), found))
    return lots


def evidence(page: str | None, page_hash: int = 0) -> list[tuple[int, int, int]]:
    """``(subtree, beside, kind)``: what may be template, and what was drawn from the rest of the page. Kinds are those of ``candidates``;
    a page that has main content also gives its own hash, as kind 2."""
    root = parse(page or "")
    measure(root)
    lots = draws(root)
    nothing = (float("inf"), 0)
    before, after = list(accumulate(lots, min, initial=nothing)), list(accumulate(reversed(lots), min, initial=nothing))[::-1]
    out = {(0, 2): page_hash} if root.has_main else {}
    for e, mark, kind in candidates(root):
        rest = root.chars - e.chars
        if rest and (e.chars <= MOST * rest or e.link_chars >= LINK_SHARE * e.chars):
            out[mark, kind] = min(before[e.first], after[e.end])[1] - (1 << 63)
    return [(mark, beside, kind) for (mark, kind), beside in out.items()]


def main_text(page: str | None, templates: frozenset | set) -> str:
    if not page:
        return ""
    root = parse(page)
    measure(root)
    template = {id(e) for e, mark, kind in candidates(root) if kind != 3 and mark in templates}

    # Main content in page order. What wraps the first of it stays, whatever its name; a later wrapper may hold comments or teasers.
    found, wraps, todo = [], set(), [root]
    while todo:
        element = todo.pop()
        if id(element) in template or is_dropped(element, templates) and (not element.has_main or element.tag in MAIN_NAMES or found):
            continue
        if element.tag in MAIN_NAMES:
            found.append(element)
        else:
            if element.has_main:
                wraps.add(id(element))
            todo += [c for c in reversed(element.children) if isinstance(c, Element)]

    def text_in(starts: list[Element]) -> str:
        blocks, words = [], []

        def end_block():
            if text := " ".join("".join(words).split()):
                blocks.append(text)
            words.clear()

        for start in starts:
            todo = [start]
            while todo:
                node = todo.pop()
                if node is None:
                    end_block()
                elif isinstance(node, str):
                    words.append(node)
                elif node.tag == "br":
                    words.append(" ")
                elif id(node) not in template and (id(node) in wraps or not is_dropped(node, templates)):
                    if node.tag in BLOCKS:
                        end_block()
                        todo.append(None)
                    todo += reversed(node.children)
            end_block()
        return "\n".join(blocks)

    main, whole = text_in(found), text_in([root])
    return main if 2 * len(main) >= len(whole) else whole


def page_templates(pages: DataFrame, url: str = "url", page: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host_hash, page_hash, templates)`` for the pages that hold template subtrees. Equal pages of a host are one."""
    def subtrees(frames):
        for frame in frames:
            lists = [evidence(p, h) for p, h in zip(frame["page"], frame["page_hash"])]
            sizes = [len(x) for x in lists]
            flat = np.array([x for found in lists for x in found], np.int64).reshape(-1, 3)
            yield pd.DataFrame({"host_hash": np.repeat(frame["host_hash"].to_numpy(), sizes), "page_hash": np.repeat(frame["page_hash"].to_numpy(), sizes), "subtree": flat[:, 0], "beside": flat[:, 1], "kind": flat[:, 2]})

    hosted = _hashed(pages.select(host_of(F.col(url)).alias("host"), F.col(page).cast("string").alias("page"))).select("host_hash", "page_hash", "page")
    found = stage(hosted.mapInPandas(subtrees, "host_hash long, page_hash long, subtree long, beside long, kind long"), "subtrees")
    counted = found.groupBy("host_hash", "subtree", "kind").agg(F.countDistinct("beside").alias("n"))
    sizes = counted.filter("kind = 2").select("host_hash", F.col("n").alias("pages"))
    enough = counted.filter((F.col("kind") != 2) & (F.col("n") >= F.when(F.col("kind") == 3, MIN_NAMED).otherwise(min_pages))).join(sizes, "host_hash", "left")
    templates = enough.filter((F.col("kind") != 1) | (F.col("n") >= MAIN_SHARE * F.col("pages"))).select("host_hash", "subtree", "kind")
    # Adaptive execution splits the subtrees that a large host has on all its pages, as templates have one row each.
    return found.drop("beside").join(templates, ["host_hash", "subtree", "kind"]).groupBy("host_hash", "page_hash").agg(F.collect_set("subtree").alias("templates"))


def _hashed(hosted: DataFrame) -> DataFrame:
    return hosted.withColumn("host_hash", F.xxhash64("host")).withColumn("page_hash", F.xxhash64(F.coalesce("page", F.lit(""))))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """``(key, url, text, n_chars)`` for every page."""
    hosted = _hashed(pages.select(F.col(key).alias("__key"), F.col(url).alias("__url"), host_of(F.col(url)).alias("host"), F.col(page).cast("string").alias("page")))

    @F.pandas_udf("binary")
    def pressed(contents: pd.Series) -> pd.Series:  # pages are shuffled, and shuffles compress less
        return contents.map(lambda c: None if c is None else zlib.compress(c.encode(), 1))

    hosted = hosted.withColumn("page", pressed("page"))
    joined = hosted.join(page_templates(pages, url, page, min_pages), ["host_hash", "page_hash"], "left")

    @F.pandas_udf("string")
    def text_of(contents: pd.Series, templates: pd.Series) -> pd.Series:
        return pd.Series([main_text(c and zlib.decompress(c).decode(), frozenset() if t is None else frozenset(t)) for c, t in zip(contents, templates)], dtype=object)

    found = joined.withColumn("text", text_of("page", "templates"))
    return found.select(F.col("__key").alias(key), F.col("__url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
