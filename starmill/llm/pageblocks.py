"""Leaf blocks of a page: runs of text between block-level tags, with the path of tags above them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Fixed sets of tag names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe svg math object canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
CLOSES_ITSELF = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
}
_KEEPS_OPEN = frozenset("ul ol dl table select article section div main aside nav body form".split())

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)""",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Za-z]+")


@dataclass
class Block:
    """``path``: tag names and the words of their class, id and role, outermost first; ``linked``: characters in links."""

    text: str
    path: tuple[str, ...]
    linked: int


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    found = [tag]
    for m in _NAMES.finditer(attributes) if attributes else ():
        found += [f".{p.lower()}" for p in _PARTS.findall(m[2] or m[3] or m[4] or "")]
    return tuple(found)


class _Reader:
    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.parts: list[str] = []
        self.path: tuple[str, ...] = ()
        self.links = self.linked = 0

    def text(self, text: str) -> None:
        if not text:
            return
        if not text.isspace():
            if not self.path:
                self.path = tuple(name for _, names in self.open for name in names) or ("#",)
            if self.links:
                self.linked += len(text)
        self.parts.append(text)

    def flush(self) -> None:
        if self.path:
            # References are decoded once the block's text is whole.
            whole = "".join(self.parts)
            text = " ".join((html.unescape(whole) if "&" in whole else whole).split())
            if text:
                self.blocks.append(Block(text, self.path, self.linked))
        self.parts, self.path, self.linked = [], (), 0

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self.flush()
            self._close_implied(tag)
        if tag in VOID or attributes.endswith("/"):
            return
        if tag == "a":
            self.links += 1
        self.open.append((tag, _names(tag, attributes)))

    def _close_implied(self, tag: str) -> None:
        closed = CLOSES_ITSELF.get(tag, set()) | {"p"}
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name in closed:
                self._cut(i)
                return
            if name in _KEEPS_OPEN:
                return

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._cut(i)
                return
            if tag in INLINE and self.open[i][0] not in INLINE:
                return

    def _cut(self, i: int) -> None:
        self.links -= sum(name == "a" for name, _ in self.open[i:])
        del self.open[i:]


def read(page: str) -> list[Block]:
    """The page's blocks in order; scripts, styles and comments hold none, a torn last tag is left out."""
    reader, at = _Reader(), 0
    while m := _MARKUP.search(page, at):
        reader.text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            reader.end(tag)
            continue
        reader.start(tag, m[3])
        if tag in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = end.start() if end else len(page)
    reader.text(page[at:])
    reader.flush()
    return reader.blocks
