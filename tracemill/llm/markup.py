"""A web page as a tree of blocks with their texts.

The parser takes any text: it closes what browsers close by themselves, skips comments, scripts
and other elements without running text, and never fails. Inline elements do not show in the
tree; a run of text between two block borders is one slot.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from zlib import crc32

BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select
    summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no running text.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math canvas object audio video".split())
#: Those that swallow the rest of a page when they are not closed.
OPEN_ENDED = frozenset("script style textarea title xmp".split())
#: What an opening tag closes, and up to where.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
          "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
SCOPE = frozenset(["html", "table", "td", "th", "caption"])
#: Any other block closes an open paragraph that none of these encloses.
PARAGRAPH, AROUND_P = frozenset(["p"]), SCOPE | {"li", "div", "section", "article", "main", "button", "body"}
#: Blocks deeper than this belong to the block at this depth.
DEEPEST = 64

_TOKEN = re.compile(
    r"""<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|/([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)
    |([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]{0,65536}"|'[^']{0,65536}')*+)[^>]*(?:>|\Z))""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([a-zA-Z:_-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_END = {name: re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I) for name in RAW}


class Slot:
    """A run of text between block borders, or all that an inferred slot stands for."""

    __slots__ = ("pages", "chars", "links", "low", "high", "runs", "optional")
    key = "#"
    many = False

    def __init__(self, pages=1, chars=0, links=0, low=0, high=0, runs=None):
        self.pages, self.chars, self.links, self.low, self.high = pages, chars, links, low, high
        self.runs = runs or []
        self.optional = False


class Node:
    """A block, or a group of blocks that repeat together, with what stands in it."""

    __slots__ = ("key", "items", "many", "optional")

    def __init__(self, key, items=None, many=False, optional=False):
        self.key, self.items, self.many, self.optional = key, items if items is not None else [], many, optional


def words(value: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(value)]


@lru_cache(maxsize=65_536)
def label(tag: str, attributes: str) -> str:
    """The name of a block: its tag, then the words of its role, class and id, digits left out."""
    found: list[str] = []
    for name, double, single, bare in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), double or single or bare
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            found.append("hidden")
        elif name == "role":
            found += ["role=" + w for w in words(value)]
        elif name in ("class", "id"):
            found += [w for w in words(value) if not w.isdigit()]
    return ".".join([tag, *sorted({w[:32] for w in found})[:12]])


class Page:
    """The tree of a page in ``root``, and the texts of its slots in page order in ``texts``."""

    def __init__(self, html: str, unwanted):
        self.texts: list[str] = []
        self.root = Node("")
        self._stack: list[tuple[str, Node]] = [("", self.root)]
        self._pieces: list[tuple[str, bool]] = []
        self._links = 0
        self._read(html, unwanted)
        self._flush()

    def _flush(self) -> None:
        if not self._pieces:
            return
        decoded = [(unescape(piece) if "&" in piece else piece, linked) for piece, linked in self._pieces]
        self._pieces = []
        text = " ".join("".join([piece for piece, _ in decoded]).split())
        if not text:
            return
        linked = min(len(text), sum([len(piece.strip()) for piece, linked in decoded if linked]))
        digest = crc32(text.encode("utf-8", "replace"))
        self._stack[-1][1].items.append(Slot(1, len(text), linked, digest, digest, [len(self.texts)]))
        self.texts.append(text)

    def _pop_to(self, names, until) -> None:
        """Close the outermost open block of ``names`` that no block of ``until`` encloses."""
        place = None
        for depth in range(len(self._stack) - 1, 0, -1):
            name = self._stack[depth][0]
            if name in until:
                break
            if name in names:
                place = depth
        if place is not None:
            del self._stack[place:]

    def _open(self, tag: str, name: str) -> None:
        self._flush()
        if tag in CLOSES:
            self._pop_to(*CLOSES[tag])
        else:
            self._pop_to(PARAGRAPH, AROUND_P)
        parent = self._stack[-1][1]
        if tag == "hr":
            return
        if len(self._stack) > DEEPEST:
            self._stack.append((tag, parent))
            return
        node = Node(name)
        parent.items.append(node)
        self._stack.append((tag, node))

    def _close(self, tag: str) -> None:
        self._flush()
        for depth in range(len(self._stack) - 1, 0, -1):
            name = self._stack[depth][0]
            if name == tag:
                del self._stack[depth:]
                return
            if name in SCOPE and tag not in ("html", "body", "table", "tbody", "thead", "tfoot", "tr", "caption"):
                return

    def _read(self, html: str, unwanted) -> None:
        place, end = 0, len(html)
        dropped, depth = "", 0  # an inline element that is no text, and how often it is open
        while place < end:
            at = html.find("<", place)
            found = _TOKEN.match(html, at) if at >= 0 else None
            while at >= 0 and found is None:  # a bare < is text
                at = html.find("<", at + 1)
                found = _TOKEN.match(html, at) if at >= 0 else None
            stop = at if at >= 0 else end
            if stop > place and not dropped:
                self._pieces.append((html[place:stop], self._links > 0))
            if found is None:
                break
            place = found.end()
            closing, opening, attributes = found.groups()
            if closing:
                tag = closing.lower()
                if tag in BLOCKS:
                    dropped = ""
                    self._close(tag)
                elif tag == dropped:
                    depth -= 1
                    dropped = dropped if depth else ""
                elif tag == "a":
                    self._links = 0
            elif opening:
                tag = opening.lower()
                if tag in BLOCKS:
                    dropped = ""
                    self._open(tag, label(tag, attributes))
                elif tag in RAW:
                    last = _END[tag].search(html, place)
                    if last:
                        place = last.end()
                    elif tag in OPEN_ENDED:
                        break
                elif tag == "br":
                    self._pieces.append((" ", False))
                elif tag == dropped:
                    depth += 1
                elif tag == "a":
                    self._links = 1
                elif not dropped and tag not in VOID and attributes and unwanted(label(tag, attributes)):
                    dropped, depth = tag, 1
