"""A forgiving HTML tree: tags that authors leave out are implied, as browsers do."""

from __future__ import annotations

import re
import sys
from collections import Counter
from html import unescape

# -- fixed values of the HTML standard, in the order of its text ---------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style xmp iframe noembed noframes".split())
ESCAPABLE_RAW_TEXT = frozenset("textarea title".split())
#: Elements whose start closes an open paragraph.
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta noframes script style template title".split())
INLINE = frozenset("a b big code em font i nobr s small strike strong tt u span label abbr cite q sub sup mark".split())
ROW_GROUPS = frozenset("thead tbody tfoot".split())
CELLS = frozenset("td th".split())
#: What an end tag may not reach past.
SCOPE = frozenset("table td th caption html template button object".split())
# -- end of the fixed values ---------------------------------------------------

#: An element that starts: the open ones it closes, and those the search for them stops at.
CLOSES_OPEN = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"]) | SCOPE),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"]) | SCOPE),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"]) | SCOPE),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"]) | SCOPE),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"]) | SCOPE),
    "tr": (frozenset(["tr", "caption", "colgroup"]), frozenset(["table", "template"])),
    "td": (CELLS, frozenset(["tr", "table", "template"])),
    "th": (CELLS, frozenset(["tr", "table", "template"])),
    "thead": (ROW_GROUPS | {"caption", "colgroup"}, frozenset(["table", "template"])),
    "tbody": (ROW_GROUPS | {"caption", "colgroup"}, frozenset(["table", "template"])),
    "tfoot": (ROW_GROUPS | {"caption", "colgroup"}, frozenset(["table", "template"])),
    "caption": (frozenset(["caption"]), frozenset(["table", "template"])),
    "rt": (frozenset(["rt", "rp"]), frozenset(["ruby"]) | SCOPE),
    "rp": (frozenset(["rt", "rp"]), frozenset(["ruby"]) | SCOPE),
}

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"  # a comment
    # a tag of names and values: a quote opens a value behind the "=" of a name, elsewhere it is as any character
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|(?:=[^\s=/>]*+|[^\s=/>]++)"
    r"(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+)*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"  # a tag whose quotes do not close
    r"|<[!?/][^>]*(?:>|\Z)"  # declarations and bogus comments
    r"|[^<]+|<",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


class Node:
    __slots__ = ("_attributes", "children", "raw", "tag")

    def __init__(self, tag: str, raw: str = ""):
        self.tag, self.raw, self.children, self._attributes = tag, raw, [], None

    @property
    def attributes(self) -> dict[str, str]:
        """Names in lower case; of a repeated one the first counts."""
        if self._attributes is None:
            found: dict[str, str] = {}
            for name, double, single, bare in ATTRIBUTE.findall(self.raw):
                found.setdefault(name.lower(), unescape(double or single or bare))
            self._attributes = found
        return self._attributes


class _Builder:
    def __init__(self) -> None:
        self.root = Node("html")
        self.body = Node("body")
        self.head = Node("head")
        self.root.children = [self.head, self.body]
        self.stack = [self.body]
        # how many elements of each name are open, so that none is looked for in vain
        self.open = Counter(["body"])
        self.deepest = 1

    def pop(self, begin: int, end: int | None = None) -> None:
        """Ends the open elements from one place to another."""
        for node in self.stack[begin:end]:
            self.open[node.tag] -= 1
        del self.stack[begin:end]

    def text(self, text: str) -> None:
        self.stack[-1].children.append(unescape(text) if "&" in text else text)

    def start(self, tag: str, raw: str) -> Node | None:
        if tag in ("html", "body"):
            target = self.root if tag == "html" else self.body
            target.raw, target._attributes = f"{target.raw} {raw}", None
            return None
        if tag == "head":
            return None
        if tag in HEAD_ONLY and len(self.stack) == 1 and not self.body.children:
            node = Node(tag, raw)
            self.head.children.append(node)
            return node
        if tag in CLOSES_PARAGRAPH:
            self.close({"p"}, SCOPE)
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self.pop(len(self.stack) - 1)
        if tag in CLOSES_OPEN:
            self.close(*CLOSES_OPEN[tag])
        if tag in ROW_GROUPS or tag == "tr":
            self.close({"tr"} if tag != "tr" else set(), {"table", "template"})
        elif tag in CELLS and self.stack[-1].tag in ROW_GROUPS | {"table"}:
            self.push(Node("tr"))
        elif tag == "a":
            self.close({"a"}, SCOPE | {"p", "div", "li"})
        node = Node(tag, raw)
        if tag in VOID:
            self.stack[-1].children.append(node)
        else:
            self.push(node)
        return node

    def push(self, node: Node) -> None:
        self.stack[-1].children.append(node)
        self.stack.append(node)
        self.open[node.tag] += 1
        self.deepest = max(self.deepest, len(self.stack))

    def close(self, tags, stops) -> bool:
        """Ends the nearest open element of ``tags``, with all that it holds."""
        if not any(self.open[tag] for tag in tags):
            return False
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                self.pop(i)
                return True
            if tag in stops:
                return False
        return False

    def end(self, tag: str) -> None:
        if tag == "br":
            self.stack[-1].children.append(Node("br"))
        elif tag == "p":
            if not self.close({"p"}, SCOPE):
                self.stack[-1].children.append(Node("p"))
        elif tag in HEADINGS:
            self.close(HEADINGS, SCOPE)
        elif tag in ("body", "html", "head") or tag in VOID:
            return
        elif tag in INLINE and self.open[tag]:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag == tag:
                    if all(x.tag in INLINE for x in self.stack[i:]):
                        self.pop(i)
                    else:  # misnested: blocks that it opened stay open
                        self.pop(i, i + 1)
                    return
                if self.stack[i].tag in SCOPE:
                    return
        elif tag in INLINE:
            return
        elif tag in CELLS | ROW_GROUPS | {"tr", "caption"}:
            self.close({tag}, {"table", "template"})
        elif tag == "table":
            self.close({tag}, {"template"})
        else:
            self.close({tag}, SCOPE - {tag})


def parse(html: str) -> Node:
    """The tree of a page. Anything parses: stray ends are left out, missing ones implied,
    unclosed comments, tags and raw text run to the end. Takes time in proportion to the
    length of the page."""
    builder, at, length = _Builder(), 0, len(html)
    last_close = html.rfind(">")
    while at < length:
        if at > last_close and html[at] == "<" and html[at + 1 : at + 2].isalpha():
            break  # a tag that never ends, as all that follow it
        found = TOKEN.match(html, at)
        at = found.end()
        first = found.group()
        name = found.group(2) or found.group(5)
        if name is None:
            if first[0] != "<" or first == "<":
                builder.text(first)
            continue
        name = name.lower()
        if found.group(1) or found.group(4):
            builder.end(name)
            continue
        node = builder.start(name, found.group(3) or found.group(6) or "")
        if node is not None and (name in RAW_TEXT or name in ESCAPABLE_RAW_TEXT):
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
            content = html[at : close.start() if close else length]
            node.children.append(unescape(content) if name in ESCAPABLE_RAW_TEXT else content)
            at = close.end() if close else length
            if builder.stack[-1] is node:
                builder.pop(len(builder.stack) - 1)
    # every element is a few calls deep in those who walk the tree
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 2000 + 8 * builder.deepest))
    return builder.root
