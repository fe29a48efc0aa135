"""Text blocks of an HTML page with their element paths.

A block is the text between two block-level boundaries; inline elements do not
part it. Character references are decoded and white space runs become one
space. Pages are read as browsers read them where that decides what is text:
raw-text elements, comments, quoted attributes, implied end tags, stray end
tags and unclosed elements. One pass over the page, one step per tag.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

# Element names of the HTML standard, by their role here.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
HIDDEN = frozenset("template svg math select object datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q s samp small span strike strong sub sup "
    "time tt u var wbr".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split())
#: A new element of these names ends an open one of the listed names, looked for up to the given parents.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}),
}
NEAR_INLINE = 4  #: open inline elements that a block's path may end with
CELLS = frozenset("td th caption table button html".split())

_MARKUP = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def name_words(attributes: str) -> tuple[str, ...]:
    """Lower-case words of the class, id, role and itemprop values, in order, each once."""
    found = (next(filter(None, m), "") for m in _NAMES.findall(attributes))
    return tuple(dict.fromkeys(w.lower() for value in found for w in _NAME_WORDS.findall(value)))


@dataclass(eq=False, slots=True)
class Element:
    """An open element; equal paths share one object while the cache lasts."""

    tag: str
    words: tuple[str, ...]
    parent: "Element | None"
    inner: dict = field(default_factory=dict)
    vector: object = None

    def path(self) -> str:
        names, e = [], self
        while e.parent is not None:
            names.append(".".join((e.tag, *e.words)))
            e = e.parent
        return "/".join(reversed(names))


class Paths:
    """Shared path objects, dropped when there are many."""

    def __init__(self, most: int = 50_000):
        self.most, self.n, self.root = most, 0, Element("", (), None)

    def start(self) -> Element:
        if self.n > self.most:
            self.n, self.root = 0, Element("", (), None)
        return self.root

    def child(self, parent: Element, tag: str, attributes: str) -> Element:
        key = (tag, attributes)
        found = parent.inner.get(key)
        if found is None:
            self.n += 1
            found = parent.inner[key] = Element(tag, name_words(attributes), parent)
        return found


@dataclass(slots=True)
class Block:
    element: Element
    text: str
    linked: int  #: characters inside links


class Reader:
    """One page: open elements, open inline elements and the block being read."""

    def __init__(self, paths: Paths):
        self.paths = paths
        self.open = [paths.start()]
        self.tags: Counter = Counter()
        self.inline: list[tuple[str, str, int]] = []  # tag, attributes, open elements at its start
        self.spans: Counter = Counter()
        self.hidden = 0
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked, self.at = 0, None

    def say(self, raw: str) -> None:
        if self.hidden or not raw:
            return
        text = unescape(raw) if "&" in raw else raw
        if self.at is None:
            if text.isspace():
                return
            at = self.open[-1]
            for tag, attributes, _ in self.inline[-NEAR_INLINE:]:
                if tag == "a" or attributes:
                    at = self.paths.child(at, tag, attributes)
            self.at = at
        self.parts.append(text)
        if self.spans["a"]:
            self.linked += len(text)

    def cut(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(self.at, text, self.linked))
        self.parts, self.linked, self.at = [], 0, None

    def leave(self, depth: int) -> None:
        """Close all elements beyond ``depth`` open ones."""
        self.cut()
        while len(self.open) > depth:
            gone = self.open.pop()
            self.tags[gone.tag] -= 1
            self.hidden -= gone.tag in HIDDEN
        while self.inline and self.inline[-1][2] > depth:
            self.spans[self.inline.pop()[0]] -= 1

    def end_open(self, names, parents) -> None:
        """Close the innermost open element of ``names`` below the next of ``parents``."""
        if not any(self.tags[n] for n in names):
            return
        found = None
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.open[depth].tag
            if tag in names:
                found = depth
            elif tag in parents:
                break
        if found:
            self.leave(found)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.say(" ")
            return
        if tag in INLINE:
            if tag not in VOID:
                self.inline.append((tag, attributes if name_words(attributes) else "", len(self.open)))
                self.spans[tag] += 1
            return
        self.cut()
        if tag in ENDS_P:
            self.end_open({"p"}, CELLS)
        if tag in IMPLIED:
            self.end_open(*IMPLIED[tag])
        if tag in VOID or tag in ("html", "body") and self.tags[tag]:
            return
        if tag == "body":
            self.end_open({"head"}, ())
        self.open.append(self.paths.child(self.open[-1], tag, attributes.strip() if name_words(attributes) else ""))
        self.tags[tag] += 1
        self.hidden += tag in HIDDEN

    def end(self, tag: str) -> None:
        if tag == "br":
            self.say(" ")
        elif tag in INLINE:
            if self.spans[tag]:
                i = len(self.inline) - 1
                while self.inline[i][0] != tag:
                    i -= 1
                del self.inline[i]
                self.spans[tag] -= 1
        else:
            self.cut()
            if self.tags[tag]:
                depth = len(self.open) - 1
                while self.open[depth].tag != tag:
                    depth -= 1
                self.leave(depth)


def read(html: str, paths: Paths | None = None) -> list[Block]:
    """The blocks of a page in order; scripts, styles, comments and form values are none."""
    page = Reader(paths or Paths())
    at = 0
    while m := _MARKUP.search(html, at):
        page.say(html[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            page.end(tag)
        elif tag in RAW:
            page.cut()
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = close.start() if close else len(html)
        else:
            page.start(tag, m[3])
    page.say(html[at:])
    page.leave(1)
    return page.blocks
