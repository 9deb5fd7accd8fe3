"""HTML pages as sequences of leaf blocks with their tag paths (for operator 13).

A block is the text between two boundaries of block-level elements; inline elements and line breaks do not end it. Its path
lists the open elements with the words of their class, id and role. Head, scripts, styles, controls and other
elements without readable text (SILENT) are left out whatever stands around them.

Pages may be damaged: unclosed elements end where HTML lets them end (a new paragraph ends the last one, a list item the item before),
end tags without a start are passed over, an unfinished tag at the end of a page is no text.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
# Their content is no markup and runs to their own end tag.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
SILENT = RAW | frozenset("head template noscript svg math object audio video canvas select datalist button option map".split())
# These stand inside a line of text and do not end it.
_WITHIN = INLINE | (SILENT - {"head"})
# Elements that end an open element of the same group, looked for up to a scope.
_ENDS = {
    "li": ("li", frozenset(("ul", "ol", "menu"))),
    "dt": ("dt dd", frozenset(("dl",))),
    "dd": ("dt dd", frozenset(("dl",))),
    "td": ("td th", frozenset(("tr", "table"))),
    "th": ("td th", frozenset(("tr", "table"))),
    "tr": ("tr", frozenset(("table",))),
}
_P_SCOPE = frozenset(("td", "th", "table", "caption", "object", "body", "html"))
# A head without end tag ends where the page's content begins.
_HEAD_PARTS = frozenset("base basefont bgsound link meta title style script noscript template".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*\Z",
    re.S,
)
_RAW_ENDS = {tag: re.compile(f"</{tag}", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block(NamedTuple):
    path: tuple[tuple[str, ...], ...]  # from the outermost element; an element is its tag and its name words
    text: str
    linked: int  # code points of the text inside links, before white space is collapsed


def _element(tag: str, attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return (tag,)
    words: list[str] = []
    for match in _ATTRIBUTE.finditer(attributes):
        words += [w.lower() for w in _WORDS.findall(match[2] or match[3] or match[4] or "")]
    return (tag, *dict.fromkeys(words))


def blocks(page: str) -> list[Block]:
    """Blocks of a page with text, in page order."""
    found: list[Block] = []
    stack: list[tuple[str, ...]] = []
    parts: list[str] = []
    path: tuple[tuple[str, ...], ...] = ()
    linked = links = silent = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            parts.clear()
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                found.append(Block(path, text, linked))
            linked = 0

    def cut(size: int) -> None:
        """Leave open elements until so many remain."""
        nonlocal links, silent
        for name, *_ in stack[size:]:
            links -= name == "a"
            silent -= name in SILENT
        del stack[size:]

    at, n = 0, len(page)
    while at < n:
        match = _TOKEN.search(page, at)
        begin = match.start() if match else n
        if begin > at and not silent:
            piece = page[at:begin]
            if not parts and not piece.isspace():
                path = tuple(stack)
            if parts or not piece.isspace():
                parts.append(piece)
                linked += len(piece) if links else 0
        if not match:
            break
        at = match.end()
        tag = match[2] or match[5]
        if tag is None:
            continue
        tag = tag.lower()
        ends, attributes = (match[1], match[3]) if match[2] else (match[4], match[6])
        if ends:
            if tag not in _WITHIN:
                close()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    cut(k)
                    break
                # An inline end tag does not close the block around it.
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if tag == "br" and parts:
            parts.append(" ")
        if tag not in _WITHIN:
            close()
            if stack and silent and stack[-1][0] == "head" and tag not in _HEAD_PARTS:
                cut(len(stack) - 1)
            names, scope = _ENDS.get(tag, ("p", _P_SCOPE))
            for k in range(len(stack) - 1, -1, -1):
                name = stack[k][0]
                if name in names.split():
                    cut(k)
                    break
                if name in scope or (names == "p" and name not in INLINE):
                    break
        if tag in VOID or (attributes.endswith("/") and tag in SILENT):
            continue
        if tag in RAW:
            end = _RAW_ENDS[tag].search(page, at)
            at = end.start() if end else n
        stack.append(_element(tag, attributes))
        links += tag == "a"
        silent += tag in SILENT
    close()
    return found
