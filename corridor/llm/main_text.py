"""Main text of web pages by scoring the element tree.

The page becomes a tree (end tags that browsers imply are implied here too). Scripts, styles,
forms, menus, page headers and footers, sidebars, notices, adverts and reader comments are cut by
tag, role and the words of class and id. Words cut only elements they name (``names_a_part``): not
headings, not those that only tell a layout (``has-sidebar``) or a subject (``related-work``), and
inside the article, or where a page has none, not an element that holds the greater part of the text
unless that is links. Every paragraph then passes points for its length and its
commas to its ancestors, less the farther they are; an element's points are discounted by the share
of its text that stands in links. The best container is kept whole, widened to the article or main
part it lies in; without one, with those siblings and bare texts beside it that are not mostly links,
less their link lists, and with such siblings of its ancestors as hold a block of 25 characters or a
comma. Its blocks are joined in page order; of containers that score alike the first is the best.

Null and empty pages, and pages without text, give an empty string. Pages are handled one by one,
whole, however long; repeated rows give the same text each.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from corridor.llm.text import text_groups

#: Names of elements and words of class and id with these meanings. Fixed values.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea template noscript iframe svg object xmp".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ENDS_ITSELF = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"},
}
SCOPE = set("table td th caption ul ol dl body html".split())
CUT_TAGS = set("head nav aside footer form button select dialog menu script style noscript template iframe svg object canvas audio video map annotation annotation-xml".split())
CUT_ROLES = set("navigation banner contentinfo complementary dialog alertdialog alert search menu menubar toolbar".split())
COMMENT_WORDS = set("comment comments commentlist disqus respond replies discussion".split())
#: With these a name of comments tells of a text whether it may have some.
STATE_WORDS = set("open opened closed on off enabled disabled allowed status no has with without".split())
CUT_WORDS = COMMENT_WORDS | set(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promoted promotion banner "
    "breadcrumb breadcrumbs menu navbar navigation nav pager pagination sidebar aside rail widget widgets footer "
    "cookie cookies consent gdpr notice notification alert popup modal overlay lightbox newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations toolbar skip hidden".split()
)
HEADER_WORDS = set("header masthead topbar".split())
#: Words that tell of place and form and may stand beside the word that names a part. Fixed values.
FORM_WORDS = set(
    "box block bar list links link container wrapper wrap area region zone panel pane slot unit group row column col inner outer "
    "top bottom left right upper lower primary secondary main sub mini small large sticky fixed floating mobile desktop "
    "site page post posts entry article articles story blog global section module component item items button buttons "
    "text title icon icons content contents form message center middle this us follow policy js id new more".split()
)

#: Characters of a bare text that is kept away from the best container.
FAR_BLOCK = 25

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_BLANK = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "attributes", "children", "parent", "points", "chars", "linked", "most")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Element | str] = []
        self.points = self.most = 0.0
        self.chars = self.linked = 0


def parse(page: str) -> Element:
    """The element tree; unknown end tags are ignored, open elements end with the page."""
    root = here = Element("#page", "", None)
    at, end = 0, len(page)
    while at < end:
        found = _TAG.search(page, at)
        text = page[at : found.start() if found else end]
        if text:
            here.children.append(text)
        if not found:
            break
        at = found.end()
        closing, tag, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            up = here
            while up is not root and up.tag != tag:
                if tag not in BLOCK and up.tag in BLOCK:
                    up = root
                else:
                    up = up.parent
            if up is not root:
                here = up.parent
            continue
        ends = ENDS_ITSELF.get(tag, ())
        up, last = here, None
        while up is not root and (up.tag not in SCOPE or up.tag in ends):
            if up.tag in ends or (up.tag == "p" and tag in BLOCK):
                last = up
            up = up.parent
        if last is not None:
            here = last.parent
        element = Element(tag, rest, here)
        here.children.append(element)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not rest.endswith("/"):
            here = element
        elif tag not in VOID and tag in BLOCK:
            here = element  # a slash does not end other elements in HTML
    return root


def named_comments(element: Element) -> bool:
    """Whether class or id call an element comments, not a text open to comments."""
    for name, *values in _ATTRIBUTE.findall(element.attributes):
        if name.lower() in ("class", "id"):
            for token in "".join(values).split():
                words = {w.lower() for w in _WORDS.findall(token)}
                if words & COMMENT_WORDS and not words & STATE_WORDS:
                    return True
    return False


def is_main(element: Element) -> bool:
    return element.tag == "main" or element.tag == "article" and not named_comments(element)


def unwanted(element: Element, in_article: bool, mains: int = 0) -> bool:
    """Cut by tag, role, being hidden or being comments; ``mains`` is how many articles and main parts the page has."""
    if element.tag in CUT_TAGS or element.tag == "header" and not in_article:
        return True
    if not element.attributes or element.tag in ("html", "body"):
        return False
    words: set[str] = set()
    for name, *values in _ATTRIBUTE.findall(element.attributes):
        name, value = name.lower(), "".join(values)
        if name == "role" and value.lower() in CUT_ROLES or name == "hidden":
            return True
        if name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id"):
            words |= {w.lower() for w in _WORDS.findall(value)}
    if words & COMMENT_WORDS and element.tag != "main" and element.tag not in HEADINGS and named_comments(element):
        inside = [child.tag for child in below(element) if is_main(child)]
        return "main" not in inside and (not inside or len(inside) < mains)
    return False


def names_a_part(element: Element, in_article: bool) -> bool:
    """Whether a name of class or id calls the element a menu, a sidebar, an advert and so on.

    All words of the name must be such words or tell of place and form: others make it a subject's
    name, and words of state a layout's.
    """
    if not element.attributes or element.tag in ("html", "body", "main", "article") or element.tag in HEADINGS:
        return False
    cut = CUT_WORDS - COMMENT_WORDS if in_article else CUT_WORDS - COMMENT_WORDS | HEADER_WORDS
    for name, *values in _ATTRIBUTE.findall(element.attributes):
        if name.lower() in ("class", "id"):
            for token in "".join(values).split():
                words = {w.lower() for w in _WORDS.findall(token)}
                if words & cut and not words - cut - FORM_WORDS:
                    return not any(child.tag in ("main", "article") for child in below(element))
    return False


def below(element: Element) -> Iterator[Element]:
    waiting = [element]
    while waiting:
        for child in reversed(waiting.pop().children):
            if isinstance(child, Element):
                yield child
                waiting.append(child)


def prune(root: Element) -> None:
    mains = sum(is_main(element) for element in below(root))
    _cut(root, lambda child, in_article: unwanted(child, in_article, mains))
    measured: list[tuple[Element, str, int]] = []

    def named(child: Element, in_article: bool) -> bool:
        if not names_a_part(child, in_article):
            return False
        # beside an article a named part goes whatever its size
        if mains > 0 and not in_article:
            return True
        if not measured:
            measured.extend(blocks(root))
            for owner, text, linked in measured:
                _count(owner, len(text), linked)
        return 2 * child.chars <= root.chars or 2 * child.linked > child.chars

    _cut(root, named)
    for owner, text, linked in measured:
        _count(owner, -len(text), -linked)


def _count(owner: Element, chars: int, linked: int) -> None:
    for element in upward(owner):
        element.chars += chars
        element.linked += linked


def _cut(root: Element, goes) -> None:
    waiting = [(root, False)]
    while waiting:
        element, in_article = waiting.pop()
        in_article |= element.tag in ("article", "main")
        kept = []
        for child in element.children:
            if isinstance(child, Element):
                if goes(child, in_article):
                    continue
                waiting.append((child, in_article))
            kept.append(child)
        element.children = kept


def upward(element: Element | None) -> Iterator[Element]:
    while element is not None:
        yield element
        element = element.parent


def blocks(element: Element) -> Iterator[tuple[Element, str, int]]:
    """(element the block stands in, its text, its characters in links) in page order."""
    text: list[str] = []
    linked = 0
    # Walked with an own stack, since pages can be nested deeper than Python calls.
    waiting: list[tuple[Element, Iterator, bool]] = [(element, iter(element.children), element.tag == "a")]
    owner = element

    def ended() -> str:
        return _BLANK.sub(" ", html.unescape("".join(text))).strip()

    while waiting:
        here, children, in_link = waiting[-1]
        child = next(children, None)
        if child is None:
            waiting.pop()
            if here.tag in BLOCK or not waiting:
                if done := ended():
                    yield owner, done, min(linked, len(done))
                text, linked = [], 0
                owner = next((e for e, _, _ in reversed(waiting) if e.tag in BLOCK), element)
        elif isinstance(child, str):
            text.append(child)
            if in_link:
                linked += len(_BLANK.sub(" ", child).strip())
        elif child.tag == "br":
            text.append(" ")
        else:
            if child.tag in BLOCK:
                if done := ended():
                    yield owner, done, min(linked, len(done))
                text, linked, owner = [], 0, child
            if child.children:
                waiting.append((child, iter(child.children), in_link or child.tag == "a"))


def is_link_list(element: Element) -> bool:
    """A list of three links or more, with little text beside them."""
    if element.tag not in ("ul", "ol", "dl", "table") or not element.chars:
        return False
    return element.linked > 0.7 * element.chars and sum(e.tag == "a" for e in below(element)) >= 3


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    prune(root)
    for owner, text, linked in blocks(root):
        points = text.count(",") + min(len(text) / 100, 3) + min(len(text) / 25, 1)
        share, up = 1.0, owner if owner.tag not in ("p", "li", "td", "th", "dd", "dt", "pre", "blockquote", *HEADINGS) else owner.parent
        for above in upward(owner):
            above.chars += len(text)
            above.linked += linked
            above.most = max(above.most, points)
        level = 0
        while up is not None and level < 6:
            up.points += points * share
            level += 1
            share = 1 / (2 * level)
            up = up.parent
    if not root.chars:
        return ""
    everything = [root, *below(root)]
    worth = lambda e: e.points * (1 - e.linked / e.chars) if e.chars else 0.0
    best = max(everything, key=worth)
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    if up is None:
        up = with_siblings(best)
    return "\n\n".join(text for _, text, _ in blocks(up))


def with_siblings(best: Element) -> Element:
    """The best container with what stands beside it, and beside its ancestors, and is not mostly links."""
    here, whole = best, best
    while here.parent is not None:
        whole = _beside(here, whole, nearest=here is best)
        here = here.parent
    return whole


def _beside(here: Element, kept: Element, nearest: bool) -> Element:
    """``kept``, which stands for ``here``, among its siblings; farther out only siblings with a block of some length."""
    whole, run = Element("div", "", None), []

    def add_run() -> None:
        # Bare text and inline elements between blocks are one text.
        alone = Element("div", "", None)
        alone.children = list(run)
        found = [(len(text), linked) for _, text, linked in blocks(alone)]
        size = sum(n for n, _ in found)
        if sum(linked for _, linked in found) < 0.5 * size and (nearest or size >= FAR_BLOCK):
            whole.children += run
        run.clear()

    for child in here.parent.children:
        if child is not here and (isinstance(child, str) or child.tag not in BLOCK):
            run.append(child)
            continue
        add_run()
        if child is here:
            whole.children.append(kept)
        elif child.chars and child.linked < 0.5 * child.chars and (nearest or child.most >= 1):
            for element in [e for e in below(child) if is_link_list(e)]:
                element.parent.children = [c for c in element.parent.children if c is not element]
            whole.children.append(child)
    add_run()
    return whole


def extract(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """The id, the ``carry`` columns, text and n_chars of every page."""
    rows = pages.select(id_column, *carry, html_column)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in text_groups(batches, html_column):
            texts = [main_text(x.decode()) for x in found]
            columns = [part.column(c) for c in (id_column, *carry)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=[id_column, *carry, "text", "n_chars"],
            )

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (id_column, *carry)) + ", text string, n_chars bigint"
    return rows.mapInArrow(run, schema)
