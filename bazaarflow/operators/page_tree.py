"""Small element tree of one page, for use inside tasks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

# Elements that never have content, so they never stay open.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN_TEXT = frozenset(["script", "style", "template"])


class Node:
    __slots__ = ("attributes", "children", "classes", "parent", "tag")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None, classes: list[str] | None = None):
        self.tag = tag
        self.attributes = attributes
        self.classes = attributes.get("class", "").split() if classes is None else classes
        self.parent = parent
        self.children: list[Node | str | Comment] = []


class Comment:
    __slots__ = ("text",)

    def __init__(self, text: str):
        self.text = text


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.current = Node("", {}, None)
        self.open_tags = Counter()

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {name: value or "" for name, value in attrs}, self.current)
        self.current.children.append(node)
        if tag not in VOID_TAGS:
            self.current = node
            self.open_tags[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        """Close the innermost such element and all within it; else nothing."""
        if not self.open_tags[tag]:
            return
        closed = None
        while closed != tag:
            closed = self.current.tag
            self.open_tags[closed] -= 1
            self.current = self.current.parent

    def handle_data(self, data):
        self.current.children.append(data)

    def handle_comment(self, data):
        self.current.children.append(Comment(data))

    def parse_marked_section(self, i, report=1):
        """Sections that word processors leave (``<![if ...]>``) are comments; the parser knows some only."""
        end = self.rawdata.find(">", i)
        if end < 0:
            return -1
        self.handle_comment(self.rawdata[i + 2 : end])
        return end + 1


# Markup that every version of the parser reads alike: names in small letters, quoted values, scripts and
# comments without inner ends. A "<" that begins anything else is the last group.
_VALUE = r'[^"<>&]*(?:&amp;[^"<>&]*)*'
_ATTRIBUTES = rf'(?:[ \t\n]+[a-z][a-z0-9-]*="{_VALUE}")*'
_PLAIN = re.compile(
    r"([^<]+)|</([a-z][a-z0-9]*)>"
    r"|<(?!(?:script|style|textarea|iframe|noembed|noframes|noscript|plaintext|xmp)[ \t\n/>])(?!title(?!>[^<]*</title>))"
    rf"([a-z][a-z0-9]*)({_ATTRIBUTES})[ \t\n]*(/?)>"
    rf"|<(script|style)({_ATTRIBUTES})>([^<]*(?:<(?!/\s*(?i:script|style))(?!!--)[^<]*)*)</\6>"
    r"|<!--(?!-|>)([^-]+(?:-(?!-)[^-]*)*)-->|<![Dd][Oo][Cc][Tt][Yy][Pp][Ee][^<>]*>|(<)"
)
_ATTRIBUTE = re.compile(rf'([a-z][a-z0-9-]*)="({_VALUE})"')


def _attributes(text: str) -> tuple[dict[str, str], list[str]]:
    """Attributes and classes of a tag."""
    attributes = {name: value.replace("&amp;", "&") for name, value in _ATTRIBUTE.findall(text)}
    return attributes, attributes.get("class", "").split()


def _read_plain(html: str) -> Node | None:
    """The tree that ``_Builder`` makes of a page, or None where the page has any markup but the plain kind."""
    root = current = Node("", {}, None)
    open_tags: dict[str, int] = {}
    # Tags of a page repeat each other; their nodes share the values, which nothing changes.
    seen: dict[str, tuple[dict[str, str], list[str]]] = {}
    for text, end, tag, attributes, closed, script, its_attributes, code, comment, odd in _PLAIN.findall(html):
        if text:
            current.children.append(unescape(text) if "&" in text else text)
        elif tag:
            known = seen.get(attributes)
            if known is None:
                known = seen[attributes] = _attributes(attributes)
            values, classes = known
            node = Node(tag, values, current, classes)
            current.children.append(node)
            if not closed and tag not in VOID_TAGS:
                current = node
                open_tags[tag] = open_tags.get(tag, 0) + 1
        elif end:
            if open_tags.get(end):
                found = None
                while found != end:
                    found = current.tag
                    open_tags[found] -= 1
                    current = current.parent
        elif script:
            node = Node(script, _attributes(its_attributes)[0], current)
            current.children.append(node)
            if code:
                node.children.append(code)
        elif odd:
            return None
        elif comment:
            current.children.append(Comment(comment))
    return root


def read_page(html: str) -> Node:
    """The page's tree: plain pages by one pattern, all others by the library's parser, with the same result."""
    plain = _read_plain(html)
    if plain is not None:
        return plain
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def elements(node: Node) -> Iterator[Node]:
    """Document order, without recursion: broken pages can nest very deeply."""
    waiting = [child for child in reversed(node.children) if child.__class__ is Node]
    while waiting:
        child = waiting.pop()
        yield child
        waiting.extend([inner for inner in reversed(child.children) if inner.__class__ is Node])


def child_items(root: Node, list_tag: str, list_class: str | None, item_tag: str) -> Iterator[Node]:
    """Elements whose direct parent is a list of the wanted class."""
    for node in elements(root):
        if node.tag == item_tag:
            owner = node.parent
            if owner.tag == list_tag and (list_class is None or list_class in owner.classes):
                yield node


def text_of(node: Node | None) -> str | None:
    """Visible text: each piece stripped, then glued together."""
    if node is None:
        return None
    pieces = []
    waiting = list(reversed(node.children))
    while waiting:
        child = waiting.pop()
        if isinstance(child, str):
            pieces.append(child.strip())
        elif isinstance(child, Node) and child.tag not in HIDDEN_TEXT:
            waiting.extend(reversed(child.children))
    return "".join(pieces)


def outer_html(node: Node | None) -> str | None:
    """The element written out again, its own tag and attributes included."""
    if node is None:
        return None
    written = []
    waiting: list[Node | str | Comment | tuple[str]] = [node]
    while waiting:
        part = waiting.pop()
        if isinstance(part, tuple):
            written.append(part[0])
        elif isinstance(part, str):
            written.append(part)
        elif isinstance(part, Comment):
            written.append(f"<!--{part.text}-->")
        else:
            attributes = "".join(f' {k}="{v}"' for k, v in part.attributes.items())
            written.append(f"<{part.tag}{attributes}>")
            waiting.append((f"</{part.tag}>",))
            waiting.extend(reversed(part.children))
    return "".join(written)
