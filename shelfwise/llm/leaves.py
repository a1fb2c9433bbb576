"""Web pages to sequences of leaf blocks: the text between two block-level tags, with the open elements around it."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Elements whose content is not text of the page, up to their end tag.
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math select object canvas audio video button datalist".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements within a line of text; all others begin and end blocks.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: Start tags that end an open element of one of these names, if none of the second ones lies between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
#: Elements an open paragraph does not reach out of.
SCOPE = ("td", "th", "table", "caption", "html")
#: Elements of a path that are described: the outermost and the innermost ones.
OUTER, INNER = 4, 12

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]{0,5000}\"|'[^']{0,5000}')*+>|[^>]*+(?:>|\Z))", re.S
)
_NAMES = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(frozen=True)
class Leaf:
    """``path``: keys of the open elements around the block (see ``element``), outermost first; ``linked``: characters in links."""

    path: tuple[str, ...]
    text: str
    linked: int


def element(tag: str, attributes: str) -> str:
    """Key of an element: its tag, then the words of its class, id and role; ``!`` first where it is hidden."""
    if not attributes.strip("/> \n\t\r"):
        return tag
    words, hidden = [], False
    for name, *values in _NAMES.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or (name == "style" and _HIDDEN.search(value)) or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name in ("class", "id", "role"):
            words += _WORD.findall(_CAMEL.sub(" ", value).lower())
    return ("!" if hidden else "") + " ".join([tag, *words[:12]])


def _tidy(parts: list[str]) -> str:
    return " ".join(html.unescape("".join(parts)).split())


def leaves(page: str | None) -> list[Leaf]:
    """Leaf blocks of a page in their order, character references decoded, white space joined to single spaces.

    Comments, scripts, styles and other elements without page text, hidden elements and empty blocks are left out. A start tag
    ends an open paragraph, item or cell as browsers do; end tags without a start are passed over; unclosed elements
    reach to the end of what encloses them.
    """
    page = page or ""
    out: list[Leaf] = []
    stack: list[str] = []
    tags: list[str] = []
    text: list[str] = []
    linked, link, hidden, at = 0, 0, 0, 0

    def close() -> None:
        nonlocal linked
        if text:
            tidy = _tidy(text)
            if tidy and not hidden:
                path = stack if len(stack) <= OUTER + INNER else [*stack[:OUTER], *stack[-INNER:]]
                out.append(Leaf(tuple(path), tidy, linked))
            text.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal hidden
        hidden -= sum(key[0] == "!" for key in stack[to:])
        del stack[to:], tags[to:]

    def last(names: tuple[str, ...], stop: tuple[str, ...]) -> int:
        for k in range(len(tags) - 1, -1, -1):
            if tags[k] in names:
                return k
            if tags[k] in stop:
                return -1
        return -1

    while True:
        found = _TOKEN.search(page, at)
        piece = page[at : found.start()] if found else page[at:]
        if piece:
            text.append(piece)
            if link:
                linked += len(piece)
        if not found:
            break
        at = found.end()
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            if tag in INLINE:
                if tag == "a":
                    link = 0
                continue
            if tag == "br":
                text.append(" ")
                continue
            close()
            link = 0
            k = last((tag,), ()) if tag in tags else -1
            if k >= 0:
                pop(k)
        elif tag in VOID:
            if tag in ("br", "wbr", "img", "input"):
                text.append(" " if tag != "wbr" else "")
            elif tag in ("hr",):
                close()
        elif tag in RAW:
            if found[3].rstrip(">").endswith("/") and tag in ("svg", "math"):
                continue
            end = re.compile(rf"</{tag}\s*/?>|</{tag}[\s/][^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            text.append(" ")
        elif tag in INLINE:
            if tag == "a":
                link = 1
        else:
            close()
            link = 0
            if "p" in tags:
                k = last(("p",), SCOPE)
                if k >= 0:
                    pop(k)
            if tag in ENDS:
                k = last(*ENDS[tag])
                if k >= 0:
                    pop(k)
            key = element(tag, found[3])
            if not found[3].rstrip(">").endswith("/") or "=" in found[3][-3:]:
                stack.append(key)
                tags.append(tag)
                hidden += key[0] == "!"
    close()
    return out
