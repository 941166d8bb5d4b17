"""A small HTML reader: elements with parents, and text chunks in page order, in linear time."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
#: Elements that never hold text of the page.
SILENT = frozenset("script style noscript template head title iframe object svg canvas audio video noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label "
    "legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead tr ul".split()
)
_CLOSES_P = BLOCK - frozenset("br button label option select textarea td th tr tbody thead tfoot caption html head body legend".split())
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_BARRIER = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""(class|id|role|aria-label|itemprop|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


@dataclass
class Page:
    """Parallel lists over elements (0 is the page itself) and over text chunks."""

    tag: list[str] = field(default_factory=lambda: ["#page"])
    parent: list[int] = field(default_factory=lambda: [-1])
    marks: list[str] = field(default_factory=lambda: [""])
    chunk_node: list[int] = field(default_factory=list)
    chunk_block: list[int] = field(default_factory=list)
    chunk_text: list[str] = field(default_factory=list)

    def text(self, keep) -> str:
        """The chunks of kept elements: white space within a block as one space, blocks joined by one."""
        blocks: list[str] = []
        last = -1
        for node, block, text in zip(self.chunk_node, self.chunk_block, self.chunk_text, strict=True):
            if keep[node]:
                if block == last:
                    blocks[-1] += text
                else:
                    blocks.append(text)
                last = block
        return " ".join(filter(None, (" ".join(b.split()) for b in blocks)))


class _TagEnds:
    """Ends of tags, past quoted values. Remembers that a quote comes no more, so that a page is searched once."""

    def __init__(self, source: str):
        self.source = source
        self.gone = {'"': False, "'": False}

    def after(self, at: int) -> int:
        """The place of the > that ends the tag whose name ends at ``at``; -1 if there is none."""
        source, end = self.source, -1
        while True:
            if end < at:
                end = source.find(">", at)
                if end < 0:
                    return -1
            quote = min((q for q in (source.find('"', at, end), source.find("'", at, end)) if q >= 0), default=-1)
            if quote < 0:
                return end
            if not source[at:quote].rstrip().endswith("="):
                at = quote + 1
                continue
            close = -1 if self.gone[source[quote]] else source.find(source[quote], quote + 1)
            if close < 0:
                self.gone[source[quote]] = True
                return end
            at = close + 1


class _Open:
    """The open elements: a stack, and for each tag, and for all blocks, the places on it."""

    def __init__(self) -> None:
        self.stack = [0]
        self.tags = ["#page"]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: int, tag: str) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(node)
        self.tags.append(tag)

    def cut(self, place: int) -> None:
        """Close all from this place on."""
        while len(self.stack) > place:
            tag = self.tags.pop()
            self.stack.pop()
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def last(self, *tags: str) -> int:
        """The highest place of one of the tags, 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def end(self, tag: str) -> None:
        place = self.last(tag)
        if place:
            self.cut(place)

    def make_way(self, tag: str) -> None:
        """Close what a new element of this tag ends."""
        if tag in _CLOSES_P:
            if self.blocks and self.tags[self.blocks[-1]] == "p":
                self.cut(self.blocks[-1])
        elif tag in _SAME:
            while (place := self.last(*_SAME[tag])) > self.last(*_BARRIER[tag]):
                found = self.tags[place]
                self.cut(place)
                if tag != "tr" or found == "tr":
                    break


def parse(source: str) -> Page:
    page = Page()
    opened, ends, block, at, n = _Open(), _TagEnds(source), 0, 0, len(source)
    stack, tags, parents, marks = opened.stack, page.tag, page.parent, page.marks
    lowered: str | None = None

    def say(text: str) -> None:
        if text:
            page.chunk_node.append(stack[-1])
            page.chunk_block.append(block)
            page.chunk_text.append(html.unescape(text) if "&" in text else text)

    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            say(source[at:])
            break
        following = source[lt + 1 : lt + 2]
        if not (following.isalpha() and following.isascii() or following in "/!?" and following):
            say(source[at : lt + 1])
            at = lt + 1
            continue
        say(source[at:lt])
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if following in "!?":
            end = source.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = following == "/"
        name_at = _NAME.match(source, lt + 1 + closing)
        if not name_at:
            end = source.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        name = name_at.group().lower()
        end = ends.after(name_at.end())
        if end < 0:
            break  # cut off within a tag
        at = end + 1
        if closing:
            opened.end(name)
            if name in BLOCK:
                block += 1
            continue
        opened.make_way(name)
        if name in BLOCK:
            block += 1
        if name == "br" or name == "hr" or name == "wbr":
            continue
        tags.append(name)
        parents.append(stack[-1])
        own = source[name_at.end() : end]
        marks.append(" ".join(f"{m[0].lower()}={m[1] or m[2] or m[3]}" for m in _ATTRIBUTE.findall(own)) if "=" in own or "hidden" in own else "")
        if name in VOID or own.endswith("/") and name not in BLOCK and name not in RAW:
            continue
        opened.push(len(tags) - 1, name)
        if name in RAW:
            lowered = source.lower() if lowered is None else lowered
            if len(lowered) != n:  # a letter whose lower case is longer; find the end tag as written
                found = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.IGNORECASE).search(source, at)
                stop = found.start() if found else -1
            else:
                stop = lowered.find(f"</{name}", at)
            if name not in SILENT:
                say(source[at : n if stop < 0 else stop])
            at = n if stop < 0 else stop
    return page


def mark_words(marks: str) -> list[str]:
    """Lower-case words of attribute values: ``side-Bar_2`` gives side, bar."""
    return [w.lower() for w in _WORD.findall(marks)]
