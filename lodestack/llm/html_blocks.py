"""Leaf blocks of HTML pages, with the tags and names of the elements around them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

#: Elements that begin and end blocks of text; others are part of the line around them.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is not text of the page.
SKIPPED = frozenset("script style noscript template iframe object svg math head title textarea select canvas audio video noframes".split())
SECTIONS = frozenset("article aside footer form header main nav section table".split())
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
_SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}}
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""", re.DOTALL)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Block:
    text: str
    tag: str
    tags: frozenset[str]
    names: frozenset[str]
    sections: tuple[str, ...]
    outer: frozenset[str]  # the names around the innermost article
    linked: int


def _tokens(attributes: str) -> frozenset[str]:
    found = (a or b or c for a, b, c in _NAMES.findall(attributes))
    return frozenset(x.lower() for names in found for x in _TOKEN.findall(names))


def leaf_blocks(html: str, known: frozenset[str] | None = None) -> list[Block]:
    """The page's runs of text between block elements, white space folded and references decoded; empty ones are left out.

    Elements may be nested to any depth. With ``known`` only those names are told, so that what
    an open element holds does not grow with the names around it.
    """
    blocks: list[Block] = []
    # open elements: name, tags around and with it, names around and with it, sections, names around the innermost article
    stack: list[tuple[str, frozenset[str], frozenset[str], tuple[str, ...], frozenset[str]]] = [("", frozenset(), frozenset(), (), frozenset())]
    count: dict[str, int] = {}  # open elements by name
    parts: list[str] = []
    links = linked = 0

    def close(k: int) -> None:
        """Close the open elements from number k on."""
        for name, *_ in stack[k:]:
            count[name] -= 1
        del stack[k:]

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            tag, tags, names, sections, outer = stack[-1]
            blocks.append(Block(text, tag, tags, names, sections, outer, linked))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text := unescape(text) if "&" in text else text)
        if links:
            linked += len(text)

    at, end = 0, len(html)
    while at < end:
        m = _TAG.search(html, at)
        if not m:
            add(html[at:])
            break
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        closing = m[1] or m[4]
        if not name:
            continue
        if name in SKIPPED:
            if not closing and not (m[3] or m[6] or "").endswith("/"):
                if name == "head":
                    stop = re.compile(r"</head\s*>|<body[\s>]", re.IGNORECASE).search(html, at)
                else:
                    stop = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(html, at)
                if stop:
                    at = stop.start() if html[stop.start() + 1] != "/" else stop.end()
                elif name in ("script", "style"):
                    at = end
            continue
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            parts.append(" ")
        elif name not in BLOCKS:
            continue
        elif closing:
            flush()
            links = 0
            if count.get(name):
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
        else:
            flush()
            links = 0
            if stack[-1][0] == "p":
                close(len(stack) - 1)
            if any(map(count.get, _CLOSES.get(name, ()))):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in _SCOPE.get(name, ()):
                        break
                    if stack[k][0] in _CLOSES[name]:
                        close(k)
                        break
            if name != "hr":
                _, tags, names, sections, outer = stack[-1]
                own = _tokens(m[3] or m[6] or "")
                if known is not None:
                    own &= known
                count[name] = count.get(name, 0) + 1
                stack.append((name, tags if name in tags else tags | {name}, names if own <= names else names | own, (*sections[-1:], name) if name in SECTIONS else sections, names if name == "article" else outer))
    flush()
    return blocks
