"""A small, forgiving reader of HTML into block nodes and text leaves.

Block elements become nodes, runs of text between block borders become leaves;
inline elements only leave their link text count. Broken markup is read as far as
it goes: open paragraphs and items are closed by the next one, unknown end tags are
ignored, an unfinished tag at the end is dropped. Scripts, styles and other
unshown elements are skipped whole.
"""

from __future__ import annotations

import html
import re

# Element names of the HTML standard, by their role here.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead tr ul".split())
UNSHOWN = frozenset("script style noscript template iframe svg math title object canvas audio video textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An element that opens closes an open one of these, within the nearest container of that kind.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table", "tbody", "thead", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
INSIDE_P = frozenset("button option select legend caption summary".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|</?[a-zA-Z][^>]*+\Z", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|data-keep)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Page:
    """Nodes in page order: parent, tag, attribute tokens; leaves have tag "" and a text."""

    __slots__ = ("parent", "tag", "tokens", "text", "links", "keep")

    def __init__(self) -> None:
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.tokens: list[tuple[str, ...]] = []
        self.text: list[str] = []
        self.links: list[int] = []  # characters of link text in a leaf
        self.keep: list[bool] = []  # carries the label attribute of training pages

    def add(self, parent: int, tag: str, tokens: tuple[str, ...] = (), text: str = "", links: int = 0, keep: bool = False) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.tokens.append(tokens)
        self.text.append(text)
        self.links.append(links)
        self.keep.append(keep)
        return len(self.tag) - 1


def _attributes(raw: str) -> tuple[tuple[str, ...], bool]:
    if "=" not in raw:
        return (), False
    tokens: list[str] = []
    keep = False
    for name, value in _ATTRIBUTE.findall(raw):
        if name == "data-keep":
            keep = True
        else:
            tokens += (t.lower() for t in _TOKEN.findall(value))
    return tuple(tokens), keep


def read_page(source: str | None) -> Page:
    page = Page()
    stack = [page.add(-1, "body")]
    if not source:
        return page
    places: dict[str, list[int]] = {}  # depths of the open elements of each name, so that no tag walks the stack
    pieces: list[str] = []
    link_depth = links = 0
    in_head = False

    def flush() -> None:
        nonlocal links
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                page.add(stack[-1], "", (), text, min(links, len(text)))
        links = 0

    def deepest(names: tuple[str, ...]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def pop_from(depth: int) -> None:
        while len(stack) > depth:
            places[page.tag[stack.pop()]].pop()

    def pop_to(names: tuple[str, ...], stops: tuple[str, ...]) -> None:
        depth = deepest(names)
        if depth > deepest(stops):
            flush()
            pop_from(depth)

    at, end = 0, len(source)
    while at < end:
        match = _TAG.search(source, at)
        stop = match.start() if match else end
        if stop > at and not in_head:
            piece = source[at:stop]
            pieces.append(piece)
            if link_depth:
                links += len(piece)
        if not match:
            break
        at = match.end()
        name = match[2] or match[5]
        if not name:
            if match[0].startswith("<![CDATA[") and not in_head:
                pieces.append(html.escape(match[0][9:].removesuffix("]]>")))
            continue
        name = name.lower()
        closing = bool(match[1] or match[4])
        raw = match[3] or match[6] or ""
        if name == "head":
            in_head = not closing
            continue
        if name == "body":
            in_head = False
            if not closing:
                page.tokens[0], keep = _attributes(raw)
            continue
        if name == "html":
            continue
        if name in UNSHOWN:
            if not closing and not raw.endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(source, at)
                at = close.end() if close else end
            if not in_head:
                pieces.append(" ")
            continue
        if name in ("meta", "link", "base"):
            continue
        in_head = False
        if name == "a":
            link_depth = 0 if closing else 1
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name not in BLOCKS:
            continue
        if closing:
            if places.get(name):
                flush()
                pop_from(places[name][-1])
                link_depth = 0
            else:
                flush()
            continue
        flush()
        if name not in INSIDE_P:
            pop_to(("p",), ("td", "th", "button"))
        if name[0] == "h" and name[1:].isdigit() and page.tag[stack[-1]][:1] == "h" and page.tag[stack[-1]][1:].isdigit():
            pop_from(len(stack) - 1)
        if name in CLOSES:
            names, stops = CLOSES[name]
            for _ in names:
                pop_to(names, stops)
        if name in VOID:
            continue
        tokens, keep = _attributes(raw)
        places.setdefault(name, []).append(len(stack))
        stack.append(page.add(stack[-1], name, tokens, keep=keep))
        link_depth = 0
    flush()
    return page
