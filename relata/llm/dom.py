"""A tolerant reader of HTML: elements with their parents, and runs of text with their blocks.

It follows the usual rules for void elements, raw text, end tags that are implied, and tags that are never closed. Every
byte is looked at a bounded number of times. Inline elements, formulas, drawings and their parts without class, id or role
are not nodes of their own.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
#: Elements in which a tag that ends in "/>" is complete, and whose parts are no blocks.
FOREIGN = frozenset(("svg", "math"))
#: In foreign elements these hold ordinary HTML.
HTML_AGAIN = frozenset("foreignobject desc annotation-xml".split())
#: Ordinary elements that end an open foreign element when they start.
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub "
    "sup time tt u var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: An element that starts ends an open one of these, up to the nearest of the scopes.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
P_SCOPES = {"table", "td", "th", "caption", "button", "object", "body", "html"}

NAME = re.compile(r"[A-Za-z][^\s/>]*")
QUOTED_TAG = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
ATTRIBUTE = re.compile(r"""([^\s=>/"']++)\s*+=\s*+("[^"]*"|'[^']*'|[^\s>"']++)""")
KEPT_ATTRIBUTES = ("class", "id", "role", "data-keep")
TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Page:
    """Nodes in the order in which they start. A text run is a node too: tag ``#text``, its own text and block."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    attributes: list[dict[str, str]] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)
    linked: list[bool] = field(default_factory=list)

    def add(self, tag: str, parent: int, attributes: dict[str, str], text: str = "", block: int = -1, linked: bool = False) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.attributes.append(attributes)
        self.texts.append(text)
        self.blocks.append(block)
        self.linked.append(linked)
        return len(self.tags) - 1


def attributes_of(source: str) -> dict[str, str]:
    found = {}
    for name, value in ATTRIBUTE.findall(source):
        name = name.lower()
        if name in KEPT_ATTRIBUTES:
            found.setdefault(name, entities.unescape(value.strip("\"'")))
    return found


def tokens_of(attributes: dict[str, str]) -> set[str]:
    """Lower-case words of class, id and role; camel case and separators part them."""
    return {token.lower() for name in ("class", "id", "role") for token in TOKENS.findall(attributes.get(name, ""))}


def parse(source: str) -> Page:
    page = Page()
    root = page.add("#root", -1, {})
    # Open elements: tag, and the node their text belongs to.
    stack: list[tuple[str, int]] = [("#root", root)]
    block, links, at, size, quotes = 0, 0, 0, len(source), True
    # Where foreign elements and those with ordinary HTML in them stand in the stack.
    turns: list[int] = []

    def text(low: int, high: int, escaped: bool = True) -> None:
        if low < high:
            run = source[low:high]
            page.add("#text", stack[-1][1], {}, entities.unescape(run) if escaped else run, block, links > 0)

    def pop_to(place: int) -> None:
        nonlocal links
        links -= sum(tag == "a" for tag, _ in stack[place:])
        del stack[place:]
        while turns and turns[-1] >= place:
            turns.pop()

    def close(names: set[str] | frozenset[str], scopes: set[str]) -> bool:
        for place in range(len(stack) - 1, 0, -1):
            if stack[place][0] in names:
                pop_to(place)
                return True
            if stack[place][0] in scopes:
                return False
        return False

    while at < size:
        start = source.find("<", at)
        if start < 0:
            text(at, size)
            break
        following = source[start + 1 : start + 2]
        if following in ("!", "?"):
            text(at, start)
            comment = source.startswith("<!--", start)
            end = source.find("-->", start + 4) if comment else source.find(">", start)
            at = size if end < 0 else end + (3 if comment else 1)
            continue
        closing = following == "/"
        name = NAME.match(source, start + 1 + closing)
        if not name:
            # A plain character; the text goes on behind it.
            if closing:
                text(at, start)
                end = source.find(">", start)
                at = size if end < 0 else end + 1
            else:
                text(at, start)
                page.add("#text", stack[-1][1], {}, "<", block, links > 0)
                at = start + 1
            continue
        text(at, start)
        tag = name[0].lower()
        matched = QUOTED_TAG.match(source, name.end()) if quotes else None
        if matched:
            end = matched.end()
        else:
            # A quote that never ends: from here on tags end at the next bracket.
            quotes = False
            end = source.find(">", name.end()) + 1
            if not end:
                break
        at = end
        foreign = bool(turns) and stack[turns[-1]][0] in FOREIGN
        if foreign and not closing and tag in ENDS_FOREIGN:
            while turns and stack[turns[-1]][0] in FOREIGN:
                pop_to(turns[-1])
            foreign = False
        if tag not in INLINE and tag not in ("br", "img", "wbr") and tag not in FOREIGN and not foreign:
            block += 1
        if closing:
            if tag == "br":
                page.add("#text", stack[-1][1], {}, "\n", block)
            elif tag in INLINE:
                # An inline end tag does not end the blocks around it.
                for place in range(len(stack) - 1, 0, -1):
                    if stack[place][0] == tag:
                        pop_to(place)
                        break
                    if stack[place][0] not in INLINE:
                        break
            else:
                close({tag}, set())
            continue
        if tag == "br":
            page.add("#text", stack[-1][1], {}, "\n", block)
            continue
        if tag in VOID:
            continue
        given = source[name.end() : end - 1]
        complete = (foreign or tag in FOREIGN) and given.endswith("/")
        if tag in RAW and not complete:
            over = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(source, end)
            at = over.end() if over else size
            continue
        if tag in CLOSES_P and not foreign:
            close({"p"}, P_SCOPES)
        if tag in ENDS:
            close(*ENDS[tag])
        attributes = attributes_of(given) if "=" in given else {}
        node = stack[-1][1]
        if not (tag in INLINE or tag in FOREIGN or foreign) or attributes:
            node = page.add(tag, node, attributes)
        if complete:
            continue
        if tag in FOREIGN or (foreign and tag in HTML_AGAIN):
            turns.append(len(stack))
        stack.append((tag, node))
        links += tag == "a"
    return page
