"""A small reader of HTML as found on the web: a tree of block elements and the text in them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# fixed values of the markup language
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("script style title textarea template iframe svg select button canvas audio video".split())
RAW = frozenset("script style title textarea iframe xmp".split())
HEAD_ONLY = frozenset("title meta link script style base noscript template".split())
#: Elements that stand for themselves in a page; all others run on in a line of text.
BLOCKS = frozenset(
    "html head body article aside blockquote address caption center colgroup dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup legend li listing main menu nav noframes "
    "noscript object ol optgroup option p plaintext pre search section summary table tbody td tfoot th thead tr ul xmp".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("html body ul ol dl table thead tbody tfoot div section article main aside nav header footer form".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARKS = re.compile(r"[.,;:!?]")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    place: int  # among its siblings
    tokens: list[str]
    label: str | None
    before: int  # characters of text before it
    text: int = 0  # characters, words, marks, link characters of its own blocks
    words: int = 0
    marks: int = 0
    links: int = 0
    blocks: int = 0
    controls: int = 0
    children: int = 0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)  # owning node, text


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def read(source: str) -> Page:
    """Blocks of text in page order, each owned by its nearest block element.

    Character references are decoded, white space inside a block becomes one space, empty blocks
    vanish. Comments, declarations, scripts and other silent elements leave nothing, and what is within
    them opens and closes nothing outside; a tag cut off at the end of the text is no text. Elements may
    be left open, or closed without being open. Tags that are not known run on in a line, as formulas
    do; what stands in for objects and scripts is a block of its own.
    """
    page = Page()
    nodes, total = page.nodes, 0
    nodes.append(Node("#page", 0, 0, 0, [], None, 0))
    stack: list[tuple[str, int, bool]] = [("#page", 0, True)]  # tag, block node, is a block
    pieces: list[tuple[str, bool]] = []  # text and whether it is in a link
    silent, links = 0, 0

    def flush() -> None:
        nonlocal total
        if not pieces:
            return
        words = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
        if words:
            owner = nodes[stack[-1][1]]
            owner.text += len(words)
            owner.words += words.count(" ") + 1
            owner.marks += len(_MARKS.findall(words))
            owner.links += sum(len(p.strip()) for p, linked in pieces if linked)
            owner.blocks += 1
            total += len(words)
            page.blocks.append((stack[-1][1], words))
        pieces.clear()

    def pop() -> None:
        nonlocal silent, links
        tag, _, block = stack[-1]
        if block:
            flush()
        stack.pop()
        silent -= tag in SILENT or tag == "head"
        links -= tag == "a"

    def close(tags: frozenset[str], within: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                while len(stack) > i:
                    pop()
                return
            # out of a silent element leads only what also closes the parts of a page around it
            if stack[i][0] in within and stack[i][2] or stack[i][0] in SILENT and not tags & SCOPES:
                return

    def raw_end(tag: str, begin: int) -> int:
        rest = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, begin)
        return rest.start() if rest else size

    at, size = 0, len(source)
    while at < size:
        found = _TAG.search(source, at)
        end = found.start() if found else size
        if end > at and not silent:
            pieces.append((source[at:end], links > 0))
        if not found:
            break
        at = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        tag, closing = name.lower(), bool(found[1] or found[4])
        if closing:
            if tag == "br":
                pieces.append((" ", False))
            elif tag not in VOID:
                close(frozenset([tag]), frozenset() if tag in BLOCKS else SCOPES)
            continue
        given = found[3] or found[6] or ""
        if silent and stack[-1][0] == "head" and tag not in HEAD_ONLY:
            pop()
        if tag in VOID or given.endswith("/") and tag not in BLOCKS:
            if tag in ("br", "hr", "img") and not silent:
                pieces.append((" ", False))
            if tag == "hr":
                flush()
            nodes[stack[-1][1]].controls += tag == "input"
            continue
        if silent and stack[-1][0] != "head" and any(t in SILENT for t, *_ in stack):
            stack.append((tag, stack[-1][1], False))
            silent += tag in SILENT
            links += tag == "a"
            if tag in RAW:
                at = raw_end(tag, at)
            continue
        block = tag in BLOCKS
        owner = stack[-1][1]
        nodes[owner].controls += tag in ("button", "select", "textarea")
        if block:
            flush()
            if tag in CLOSED_BY:
                close(CLOSED_BY[tag], SCOPES - CLOSED_BY[tag])
            close(frozenset(["p"]), SCOPES)
            flush()
            owner = stack[-1][1]
            if tag != "head":
                given = _attributes(given) if "=" in given else {}
                words = " ".join(given.get(k, "") for k in ("class", "id", "role"))
                parent = nodes[owner]
                tokens = [t.lower() for t in _TOKEN.findall(words)]
                nodes.append(Node(tag, owner, parent.depth + 1, parent.children, tokens, given.get("data-y"), total))
                parent.children += 1
                owner = len(nodes) - 1
        stack.append((tag, owner, block))
        silent += tag in SILENT or tag == "head"
        links += tag == "a"
        if tag in RAW:
            begin, at = at, raw_end(tag, at)
            if tag == "xmp" and not silent:
                pieces.append((html.escape(source[begin:at]), links > 0))
    while len(stack) > 1:
        pop()
    flush()
    return page
