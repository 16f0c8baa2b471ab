"""Small page helper for executors: parse one HTML page, read fields of its cards.

Standard library only. Selectors are the CSS subset the card profiles use: tag,
``.class``, ``[attr]``, ``[attr=v]``, ``[attr*=v]``, descendants, and commas.
"""

import re
from html.parser import HTMLParser

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_SELF_CLOSING = {"p", "li", "option", "tr", "td", "th"}  # a new one ends an open one
_PART = re.compile(r"^([\w-]+)|\.([\w-]+)|\[([\w-]+)(?:(\*?=)['\"]?([^'\"\]]*)['\"]?)?\]")


class _Node:
    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.classes = set(attrs["class"].split()) if "class" in attrs else set()
        self.children = []


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = _Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in _SELF_CLOSING and self.open.tag == tag:
            self.open = self.open.parent
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.children.append(node)
        if tag not in _VOID:
            self.open = node

    def handle_endtag(self, tag):
        node = self.open
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.open = node.parent

    def handle_data(self, data):
        self.open.children.append(data)


def _walk(node):
    stack = [c for c in reversed(node.children) if not isinstance(c, str)]
    while stack:
        found = stack.pop()
        yield found
        stack.extend(c for c in reversed(found.children) if not isinstance(c, str))


def _text(node):
    parts, stack = [], [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            parts.append(item)
        elif item.tag not in ("script", "style"):
            stack.extend(reversed(item.children))
    return " ".join("".join(parts).split())


def compile_selector(css):
    """A selector text to a list of chains, each a list of (tag, classes, attribute
    tests) that reads from the outermost element to the wanted one."""
    return [[_compound(text) for text in chain.split()] for chain in css.split(",")]


def _compound(text):
    parts = _PART.findall(text)
    tag = next((p[0] for p in parts if p[0]), None)
    return tag, {p[1] for p in parts if p[1]}, [p[2:] for p in parts if p[2]]


def _fits(node, compound):
    tag, classes, attributes = compound
    if (tag and node.tag != tag) or not classes <= node.classes:
        return False
    for name, operator, value in attributes:
        actual = node.attrs.get(name)
        if actual is None or (operator == "=" and actual != value) or (operator == "*=" and value not in actual):
            return False
    return True


def _matches(node, chain):
    if not _fits(node, chain[-1]):
        return False
    above, wanted = node.parent, len(chain) - 2
    while wanted >= 0 and above is not None:
        if _fits(above, chain[wanted]):
            wanted -= 1
        above = above.parent
    return wanted < 0


def _select(nodes, selector):
    """Those of ``nodes`` that a selector matches, in document order."""
    if len(selector) == 1:
        chain = selector[0]
        return (n for n in nodes if _matches(n, chain))
    return (n for n in nodes if any(_matches(n, chain) for chain in selector))


def _first(nodes, readings):
    """First non-empty reading; '' when an element is there but empty; None without any."""
    seen = None
    for selector, attribute in readings:
        found = next(_select(nodes, selector), None)
        if found is not None:
            seen = found.attrs.get(attribute, "") if attribute else _text(found)
            if seen:
                return seen
    return seen


def read_cards(html, card_selectors, single, multiple):
    """Fields of every card. The first card selector that matches is used.
    ``single``: name to readings; ``multiple``: name to selector, all texts."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    everything = list(_walk(tree.root))
    records = []
    for selector in card_selectors:
        for card in _select(everything, selector):
            nodes = list(_walk(card))
            record = {name: _first(nodes, readings) for name, readings in single.items()}
            record.update({name: [_text(n) for n in _select(nodes, css)] for name, css in multiple.items()})
            records.append(record)
        if records:
            break
    return records
