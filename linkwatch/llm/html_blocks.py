"""Leaf blocks of a page: the text between two block-level tags, with its ancestors."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from typing import NamedTuple

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_OPENING = re.compile(r"<[!?/a-zA-Z]")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">]++)*+)>", re.S)
_NAME_END = re.compile(r"[\s/>]|\Z")
_LONG_REFERENCE = re.compile(r"&#0*([0-9]+);?")
_STOP = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+))|([^\s=\"'/]+)", re.S)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
# HTML's void, raw-text and inline elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike"
    " strong sub sup time tt u var wbr img br label"
    " math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose"
    " msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mlabeledtr mtd"
    " maction semantics annotation annotation-xml".split()
)
# Elements of a drawing: those that hold text are blocks, the others only draw.
DRAWN_TEXT = frozenset("text desc foreignobject".split())
DRAWING = DRAWN_TEXT | frozenset(
    "svg a g defs symbol use path rect circle ellipse line polyline polygon image marker mask pattern"
    " clippath lineargradient radialgradient stop filter switch view metadata tspan textpath set mpath"
    " animate animatemotion animatetransform".split()
)
# a start tag of the key closes open elements of these kinds
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"},
}
# an element that keeps what is outside it from being closed
WALLS = frozenset("ul ol dl table article section main div aside nav header footer form body".split())


class Marks(NamedTuple):
    """Known features of an ancestor: as one of many, as one of the nearest two, as the own element."""

    far: tuple[str, ...]
    near: tuple[str, ...]
    own: str


class Path:
    """Ancestors of a block, innermost first; pages share what their paths share.

    A sequence of (tag, attribute words), outermost first, when iterated or sliced.
    """

    __slots__ = ("parent", "item", "depth", "marks")

    def __init__(self, parent: Path | None, item: tuple[str, tuple[str, ...]]):
        self.parent, self.item, self.depth = parent, item, parent.depth + 1 if parent else 1
        self.marks: Marks | None = None  # a reader's notes on the item

    def last(self, n: int) -> list[tuple[str, tuple[str, ...]]]:
        """Up to ``n`` innermost ancestors, outermost first."""
        out, node = [], self
        while node is not None and len(out) < n:
            out.append(node.item)
            node = node.parent
        return out[::-1]

    def __len__(self) -> int:
        return self.depth

    def __iter__(self):
        return iter(self.last(self.depth))


@dataclass(slots=True)
class Block:
    text: str
    path: Path | tuple[()]  # tag and attribute words of the ancestors
    linked: int  # characters inside links


class _Tags:
    """The next tag, comment or broken end of a page, in time linear in the page.

    A tag ends at the first ``>`` outside quotes.  Where none follows, the rest
    of the page was read in vain; from then on ends are remembered: where the
    quote at a place leads depends on that place alone.
    """

    def __init__(self, page: str):
        self.page, self.failed = page, False
        self.last = max(page.rfind("<"), page.rfind(">"))
        self.name = (-1, -1)  # a stretch without white space, slash or >
        self.stop = -1  # the next quote or > behind a place, once looked for
        self.ends: dict[int, int] = {}

    def name_end(self, at: int) -> int:
        if not self.name[0] <= at <= self.name[1]:
            self.name = (at, _NAME_END.search(self.page, at).start())
        return self.name[1]

    def next_stop(self, at: int) -> int:
        m = _STOP.search(self.page, at)
        return m.start() if m else len(self.page)

    def end(self, at: int) -> int:
        """The ``>`` that ends the tag whose name ends here, or -1."""
        page, way = self.page, []
        if self.stop < at:
            self.stop = self.next_stop(at)
        place = self.stop
        while place not in self.ends:
            way.append(place)
            if place == len(page):
                self.ends[place] = -1
            elif page[place] == ">":
                self.ends[place] = place
            else:
                close = page.find(page[place], place + 1)
                place = len(page) if close < 0 else self.next_stop(close + 1)
        for x in way:
            self.ends[x] = self.ends[place]
        return self.ends[place]

    def find(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start, end, slash, name and attributes; a comment has no name, a broken end no ``>``."""
        page = self.page
        while m := _OPENING.search(page, at):
            start = m.start()
            if page[start + 1] in "!?":
                return start, _COMMENT.match(page, start).end(), "", "", ""
            slash = "/" if page[start + 1] == "/" else ""
            first = start + 1 + len(slash)
            at = start + 1
            if not page[first : first + 1].isalpha() or not page[first].isascii():
                continue
            if not self.failed:
                tag = _TAG.match(page, start)
                if tag:
                    return start, tag.end(), tag[1], tag[2], tag[3]
                self.failed = True
            edge = self.name_end(first)
            end = self.end(edge)
            if end >= 0:
                return start, end + 1, slash, page[first:edge], page[edge:end]
            if self.last < edge:
                return start, len(page) + 1, slash, page[first:edge], ""
        return None


class _Open:
    """Open elements, with the places of each kind and of walls, and the path of each."""

    def __init__(self):
        self.tags: list[str] = []
        self.paths: list[Path | None] = []
        self.of: dict[str, list[int]] = {}
        self.walls: list[int] = []

    def push(self, tag: str, source: str) -> None:
        path = self.path()
        if tag not in INLINE:
            path = Path(path, _attributes(tag, source))
        self.of.setdefault(tag, []).append(len(self.tags))
        if tag in WALLS:
            self.walls.append(len(self.tags))
        self.tags.append(tag)
        self.paths.append(path)

    def cut(self, at: int) -> None:
        while len(self.tags) > at:
            tag = self.tags.pop()
            self.paths.pop()
            self.of[tag].pop()
            if tag in WALLS:
                self.walls.pop()

    def path(self) -> Path | None:
        return self.paths[-1] if self.paths else None

    def last(self, tag: str) -> int:
        places = self.of.get(tag)
        return places[-1] if places else -1

    def closing(self, kinds: set[str]) -> int:
        """The innermost open element of these kinds that no wall is inside of, or -1."""
        at = max(map(self.last, kinds))
        return at if at > (self.walls[-1] if self.walls else -1) else -1


def _attributes(tag: str, source: str) -> tuple[str, tuple[str, ...]]:
    words: list[str] = []
    if source and not source.isspace():
        for m in _ATTRIBUTE.finditer(source):
            name = (m[1] or m[5]).lower()
            if name in ("class", "id", "role", "itemprop", "aria-label"):
                value = m[2] or m[3] or m[4] or ""
                words += [w.lower() for w in _NAME.findall(value)]
            elif name == "hidden" or name == "style" and "none" in (m[2] or m[3] or ""):
                words.append("hidden")
    return tag, tuple(words)


def _decoded(piece: str) -> str:
    """Character references resolved; a number too long for any character is the replacement sign."""
    if "&#" in piece:
        piece = _LONG_REFERENCE.sub(lambda m: m[0] if len(m[0]) < 99 else f"&#{m[1][:9]};", piece)
    return html.unescape(piece)


def blocks_of(page: str | None) -> list[Block]:
    """Blocks in page order; white space is one blank, references are decoded.

    Unclosed elements end where HTML ends them, a page that breaks off ends
    there.  Comments, scripts, styles, text areas and the title have no blocks.
    Formulas are part of the text around them; texts of a drawing are blocks of
    their own, and an element that no drawing holds ends one that is open.
    """
    out: list[Block] = []
    stack = _Open()
    parts: list[str] = []
    where: Path | None = None
    placed = False
    linked = links = 0

    def flush() -> None:
        nonlocal linked, where, placed
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, where or (), linked))
            parts.clear()
        linked, where, placed = 0, None, False

    page, at, lower = page or "", 0, None
    tags = _Tags(page)
    while at < len(page):
        found = tags.find(at)
        piece = page[at : found[0] if found else len(page)]
        if piece:
            piece = _decoded(piece) if "&" in piece else piece
            parts.append(piece)
            if not placed and not piece.isspace():
                # a drawing opens without an end of the block around it
                where, placed = stack.path(), True
            if links:
                linked += len(piece.strip())
        if not found:
            break
        _, at, slash, name, source = found
        if not name:
            continue
        if at > len(page):  # the page breaks off inside a tag
            break
        tag, alone = name.lower(), source.endswith("/")
        if slash:
            if tag == "a":
                links = max(0, links - 1)
            if stack.last(tag) >= 0:
                if tag not in INLINE and (tag not in DRAWING or tag in DRAWN_TEXT):
                    flush()
                stack.cut(stack.last(tag))
            elif tag == "p":
                flush()
            continue
        if tag in RAW and not alone:
            lower = page.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at) if len(lower) == len(page) else page.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
            continue
        drawings = stack.of.get("svg")
        if drawings and stack.last("foreignobject") < 0:
            if tag in DRAWING or tag[:2] == "fe" or ":" in tag:
                if tag in DRAWN_TEXT:
                    flush()
                if tag == "a":
                    links += 1
                if not alone:
                    stack.push(tag, source)
                continue
            flush()
            stack.cut(drawings[0])
        if tag == "svg":
            if not alone:
                stack.push(tag, source)
            continue
        if tag in ("br", "mtd"):
            parts.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag not in INLINE:
            flush()
            ended = stack.closing(CLOSES.get(tag, {"p"}))
            if ended >= 0:
                stack.cut(ended)
            links = 0
        elif tag == "a":
            links += 1
        if not alone:
            stack.push(tag, source)
    flush()
    return out
