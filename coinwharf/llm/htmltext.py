"""Main text of web pages by tag-path ratios.

A page is read into text nodes with their tag paths from the root. For each path, the text per
node and the punctuation per node are gathered over the page. Both ratios are smoothed along the
page and fused, and nodes above a share of the spread are content. The content's home is the
innermost element that holds nearly all of it; the text of that element is returned block by
block, without parts that are marked as something else (menus, headers and footers of the page,
sidebars, notices, adverts, forms, scripts, comments of readers) or are lists of links.

Defined cases: a null or empty page, or one without text, gives an empty text; broken markup is
read as browsers do where it matters (unclosed tags end with their parent, a new paragraph ends
the one before, a tag or text not allowed in the head ends it, an unclosed comment takes the rest); equal rows give equal results each; very
long pages are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from coinwharf.llm.common import text_slices

RAW = {"script", "style", "noscript", "template", "iframe", "svg", "annotation", "annotation-xml", "title", "textarea", "select", "canvas", "audio", "video"}
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noscript", "noframes", "script", "style", "template", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "annotation", "annotation-xml", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
    "math", "menclose", "merror", "mfenced", "mfrac", "mi", "mmultiscripts", "mn", "mo", "mover", "mpadded", "mphantom", "mroot", "mrow", "ms", "mspace", "msqrt",
    "mstyle", "msub", "msubsup", "msup", "mtext", "munder", "munderover", "object", "q", "rp", "rt", "ruby", "s", "samp", "semantics", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
ASIDE = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset"}
ENDS_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}, "tbody": {"table"}}
#: Names in a class or id that mark a part as something else than the article.
_NAMES = (
    r"(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebar|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|topbar|toolbar"
    r"|comments?|comment-?list|replies|disqus|respond|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login"
    r"|share|sharing|social|related|recommend\w*|widget|pagination|pager|skip-?link|copyright|disclaimer)"
)
#: Names that say where a part is or whose, and ends that speak of a state or a layout.
_PLACE = r"(?:site|page|main|top|bottom|left|right|side|primary|secondary|global|header|footer|nav|user|reader|post|entry|article|blog|google|cookie|social|mobile|sub)[_-]"
_STATE = r"(?!.*[_-](?:enabled|disabled|active|inactive|open|opened|closed|visible|hidden|free|on|off|layout|page|content|body|wrapper|container|left|right|none)$)"
MARKED = re.compile(rf"(?:{_PLACE})*{_NAMES}(?:s|[_-](?:left|right|wrapper|container|content|body))?$|{_STATE}(?:{_PLACE})*{_NAMES}[_-]", re.IGNORECASE)
OF_READERS = re.compile(r"comment|replies|disqus|respond", re.IGNORECASE)
HEADS = re.compile(rf"{_STATE}(?:site|page|top|global)[_-]?header(?:$|[_-])", re.IGNORECASE)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form"}
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Element:
    """An element; what its ancestors say about it is carried down when it is made, and sums are
    carried up once, so no step walks all ancestors of all elements."""

    __slots__ = ("article", "aside", "chars", "chosen", "depth", "in_list", "link", "link_chars", "links", "marked", "parent", "path", "paths", "tag")

    def __init__(self, tag: str, parent: Element | None, aside: bool):
        self.tag, self.parent, self.aside, self.marked = tag, parent, aside, ""
        # a path has a number: that of its parent's path and the tag
        self.paths: dict[tuple[int, str], int] = parent.paths if parent else {}
        self.path = self.paths.setdefault((parent.path if parent else -1, tag), len(self.paths))
        self.depth = parent.depth + 1 if parent else 0
        self.article = tag in ("article", "main") or bool(parent and parent.article)
        self.link = tag == "a" or bool(parent and parent.link)
        self.chars = self.link_chars = self.links = 0
        self.chosen = 0.0
        self.in_list = False


def _is_aside(tag: str, attributes: str, parent: Element) -> bool:
    if tag in ASIDE or tag == "head":
        return True
    if tag == "header" and not parent.article:
        return True
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = next(filter(None, values), ""), name.lower()
        if name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
    return False


def _mark(tag: str, attributes: str, parent: Element) -> str:
    """The class or id that marks an element as something else than the article, or nothing."""
    if tag in ("html", "body", "article", "main") or "=" not in attributes:
        return ""
    for name, *values in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            value = next(filter(None, values), "")
            for part in value.split():
                if MARKED.match(part):
                    return part
                if (HEADS.match(part) or value.lower() == "header") and not parent.article:
                    return part
    return ""


def _read(page: str) -> tuple[list[tuple[Element, str, int]], list[Element]]:
    """Text nodes in page order (their element, raw text and number of the block they are in), and
    the elements, parents first."""
    nodes: list[tuple[Element, str, int]] = []
    root = Element("#", None, False)
    stack, block, at, low = [root], 0, 0, None
    elements: list[Element] = []
    opened: Counter[str] = Counter()  # tags in the stack, which is searched only for those it holds

    def close_to(depth: int) -> None:
        nonlocal block
        opened.subtract(e.tag for e in stack[depth:])
        if any(e.tag not in INLINE for e in stack[depth:]):
            block += 1
        del stack[depth:]

    def raw_end(tag: str, at: int) -> int:
        """Where the end tag of a raw element begins, or -1."""
        nonlocal low
        low = page.lower() if low is None else low
        if len(low) != len(page):
            ended = re.compile(f"</{tag}(?=[\\s/>]|$)", re.IGNORECASE).search(page, at)
            return ended.start() if ended else -1
        end = low.find(f"</{tag}", at)
        while end >= 0 and not (low[(after := end + len(tag) + 2) : after + 1].isspace() or low[after : after + 1] in ("", "/", ">")):
            end = low.find(f"</{tag}", after)
        return end

    def leave_head() -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag == "head":
                close_to(depth)

    while at < len(page):
        sign = page.find("<", at)
        if sign < 0:
            sign = len(page)
        if sign > at:
            if stack[-1].tag == "head" and not page[at:sign].isspace():
                leave_head()
            nodes.append((stack[-1], page[at:sign], block))
        if sign == len(page):
            break
        if page.startswith("<!--", sign):
            end = page.find("-->", sign + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), sign):
            end = page.find(">", sign)
            at = len(page) if end < 0 else end + 1
            continue
        found = TAG.match(page, sign) or LOOSE_TAG.match(page, sign)
        if not found:
            if stack[-1].tag == "head":
                leave_head()
            nodes.append((stack[-1], "<", block))
            at = sign + 1
            continue
        at, tag = found.end(), found[2].lower()
        if found[1]:
            for depth in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[depth].tag == tag:
                    close_to(depth)
                    break
                if tag in INLINE and stack[depth].tag not in INLINE:
                    break
            continue
        if tag == "head":
            if len(stack) > 1 + (stack[-1].tag == "html") or any(t.strip() for _, t, _ in nodes):
                continue  # only the first part of a page is its head
        elif tag not in IN_HEAD and stack[-1].tag == "head":
            leave_head()
        if tag in RAW and not found[3].endswith("/"):
            end = raw_end(tag, at)
            if end < 0:
                at = len(page)
            else:
                end = page.find(">", end)
                at = len(page) if end < 0 else end + 1
            block += tag not in INLINE
            continue
        if tag in ENDS_P and opened["p"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close_to(depth)
                    break
                if stack[depth].tag not in INLINE:
                    break
        for depth in range(len(stack) - 1, 0, -1) if tag in ENDS and any(opened[t] for t in ENDS[tag]) else ():
            if stack[depth].tag in ENDS[tag]:
                close_to(depth)
            elif stack[depth].tag in LIMITS[tag]:
                break
        if tag in VOID:
            if tag == "br":
                nodes.append((stack[-1], " ", block))
            elif tag == "hr":
                block += 1
            continue
        if tag not in INLINE:
            block += 1
        elements.append(Element(tag, stack[-1], stack[-1].aside or _is_aside(tag, found[3], stack[-1])))
        elements[-1].marked = _mark(tag, found[3], stack[-1])
        stack.append(elements[-1])
        opened[tag] += 1
    return nodes, elements


def _smooth(values: list[float]) -> list[float]:
    """Each value with its neighbours, by a Gaussian curve of width one."""
    curve = [math.exp(-(d * d) / 2) for d in range(3)]
    out = []
    for i in range(len(values)):
        around = [(values[j], curve[abs(i - j)]) for j in range(max(0, i - 2), min(len(values), i + 3))]
        out.append(sum(v * w for v, w in around) / sum(w for _, w in around))
    return out


def _chosen(solid: list[tuple[Element, str, int]], spread: float) -> list[bool]:
    """Which text nodes are content, by the smoothed ratios of their paths."""
    texts: dict[int, list[int]] = {}
    for e, t, size in solid:
        of = texts.setdefault(e.path, [0, 0, 0])
        of[0] += size
        of[1] += len(PUNCTUATION.findall(t))
        of[2] += 1
    text_ratio = _smooth([texts[e.path][0] / texts[e.path][2] for e, _, _ in solid])
    mark_ratio = _smooth([texts[e.path][1] / texts[e.path][2] for e, _, _ in solid])
    fused = [t * (1 + m) for t, m in zip(text_ratio, mark_ratio)]
    mean = sum(fused) / len(fused)
    least = min(spread * math.sqrt(sum((f - mean) ** 2 for f in fused) / len(fused)), max(fused))
    return [f >= least for f in fused]


def _leave_out_marked(nodes: list[tuple[Element, str, int]], elements: list[Element], spread: float) -> None:
    """Marked elements become asides with all in them, but for those that hold the page's article:
    its main, most of the text of its articles, or, in an article or where there is none, most of its
    chosen text. For remarks of readers, which may be longer than the article, most is nearly all."""
    if not any(e.marked for e in elements):
        return
    solid = [(e, t, len(" ".join(t.split()))) for e, t, _ in nodes if not e.aside and t.strip()]
    sizes: dict[Element, int] = {}  # characters, those chosen, and those in articles below each element
    picked: dict[Element, int] = {}
    below: dict[Element, int] = {}
    has_main: set[Element] = set()
    in_articles = in_chosen = 0
    for (e, _, size), chosen in zip(solid, _chosen(solid, spread) if solid else ()):
        in_articles += size * e.article
        in_chosen += size * chosen
        sizes[e] = sizes.get(e, 0) + size
        picked[e] = picked.get(e, 0) + size * chosen
    for e in reversed(elements):
        up = e.parent
        sizes[up] = sizes.get(up, 0) + sizes.get(e, 0)
        picked[up] = picked.get(up, 0) + picked.get(e, 0)
        # of an article, what is within the marked part counts where the article is
        below[up] = below.get(up, 0) + (sizes.get(e, 0) if e.tag in ("article", "main") else below.get(e, 0))
        if e in has_main or e.tag == "main" and not e.aside:
            has_main.add(up)
    for e in elements:
        if e.marked and e not in has_main:
            articles, chosen = below.get(e, 0), picked.get(e, 0)
            most = 0.95 if OF_READERS.search(e.marked) else 0.5
            holds = chosen > most * in_chosen if e.article or not in_articles else articles > most * in_articles
            e.aside = e.aside or not holds
        e.aside = e.aside or e.parent.aside


def main_text(page: str, spread: float = 0.8, share: float = 0.9) -> str:
    """The page's main text, its blocks joined by two line feeds."""
    read, elements = _read(page)
    nodes = [(e, html.unescape(t), b) for e, t, b in read]
    _leave_out_marked(nodes, elements, spread)
    solid = [(e, t, len(" ".join(t.split()))) for e, t, _ in nodes if not e.aside and t.strip()]
    if not solid:
        return ""
    for e, _, size in solid:
        e.chars += size
        e.link_chars += size * e.link
        e.links += e.link
    for e in reversed(elements):
        e.parent.chars += e.chars
        e.parent.link_chars += e.link_chars
        e.parent.links += e.links
    for e in elements:
        e.in_list = e.parent.in_list or _link_list(e)
    content = _chosen(solid, spread)
    in_links = [e.in_list for e, _, _ in solid]
    if any(c and not links for c, links in zip(content, in_links)):
        content = [c and not links for c, links in zip(content, in_links)]
    chosen = [(e, size) for (e, _, size), c in zip(solid, content) if c]
    total = sum(size for _, size in chosen)
    for e, size in chosen:
        e.chosen += size
    for e in reversed(elements):
        e.parent.chosen += e.chosen
    root = solid[0][0]
    while root.parent:
        root = root.parent
    everything = [root, *elements]
    home = inner = max((e for e in everything if e.chosen >= share * total), key=lambda e: e.depth)
    if not home.article:
        # the deepest element with all chosen ones and all headlines in it
        wanted = {e for e, _ in chosen} | {e for e in elements if e.tag == "h1" and e.chars}
        count = dict.fromkeys(everything, 0) | dict.fromkeys(wanted, 1)
        for e in reversed(elements):
            count[e.parent] += count[e]
        home = max((e for e in everything if count[e] == len(wanted)), key=lambda e: e.depth)
    while home.parent and home.tag not in ("article", "main") and (home.tag in INLINE or home.tag in ("p", "li", "pre", "td", "h1", "h2", "h3", "h4", "h5", "h6") or home.article):
        home = home.parent
    in_home, in_inner = {home}, {inner}
    for e in elements:
        for part in (in_home, in_inner):
            if e.parent in part:
                part.add(e)
    # link lists go outside the chosen content: before it, or behind it in other elements
    places = [i for i, c in enumerate(content) if c]
    first, last = places[0], places[-1]
    held = home.tag in ("article", "main")
    seen: set[Element] = set()
    for i, (e, _, _) in enumerate(solid):
        if in_links[i] and not held and not first <= i <= last and e in in_home:
            if not (i > last and e in in_inner and inner.tag not in ("#", "html", "body")):
                while e is not home and e not in seen:
                    seen.add(e)
                    e = e.parent
    gone: set[Element] = set()
    for e in elements:
        if e in in_home and e is not home and (e.parent in gone or e in seen and _link_list(e)):
            gone.add(e)
    blocks: dict[int, list[str]] = {}
    for e, t, b in nodes:
        if not e.aside and e in in_home and e not in gone:
            blocks.setdefault(b, []).append(t)
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(filter(None, joined))


def _link_list(e: Element) -> bool:
    return e.tag in ("ul", "ol", "dl", "div", "table", "section") and e.links >= 3 and e.link_chars >= 0.8 * e.chars


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, pages in text_slices(batches):
        found = [main_text(p) for p in pages]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def page_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("text"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
