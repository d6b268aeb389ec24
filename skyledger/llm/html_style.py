"""What the style sheets of a page say of ``display`` and ``visibility`` on a screen, by the cascade."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

from skyledger.llm.html_tree import Node

#: The screen that pages are laid out on: a desktop's, in CSS pixels; no scripts run.
WIDTH, HEIGHT = 1280, 720
MEASURES = {
    "width": WIDTH, "height": HEIGHT, "device-width": WIDTH, "device-height": HEIGHT, "resolution": 1,
    "device-pixel-ratio": 1, "aspect-ratio": WIDTH / HEIGHT, "device-aspect-ratio": WIDTH / HEIGHT,
    "color": 8, "color-index": 0, "monochrome": 0, "grid": 0,
}
STATES = {
    "orientation": "landscape", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine",
    "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "prefers-contrast": "no-preference",
    "prefers-reduced-data": "no-preference", "prefers-reduced-transparency": "no-preference", "forced-colors": "none",
    "inverted-colors": "none", "scripting": "none", "update": "fast", "overflow-block": "scroll",
    "overflow-inline": "scroll", "display-mode": "browser", "color-gamut": "srgb", "dynamic-range": "standard",
}
UNITS = {
    "": 1, "px": 1, "em": 16, "rem": 16, "in": 96, "cm": 96 / 2.54, "mm": 96 / 25.4, "pt": 96 / 72, "pc": 16,
    "dppx": 1, "x": 1, "dpi": 1 / 96, "dpcm": 2.54 / 96,
}
SIZE = re.compile(r"([+-]?(?:\d+\.?\d*|\.\d+))([a-z]*)")
PLAIN = re.compile(r"(?:-webkit-|-moz-)?(?:(min|max)-{1,2}(?:moz-)?)?([a-z-]+?)\s*(?::\s*(.+))?")
RANGE = re.compile(r"(?:([\w.+/-]+)\s*([<>]=?|=)\s*)?([a-z-]+)(?:\s*([<>]=?|=)\s*([\w.+/-]+))?")
COMPARE = {
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "=": lambda a, b: a == b,
}

SETTLING = re.compile(r"display|visibility|\\", re.IGNORECASE)
PIECE = re.compile(
    r"/\*.*?(?:\*/|\Z)|\"(?:[^\"\\\n]|\\.)*\"?|'(?:[^'\\\n]|\\.)*'?|url\(\s*[^\"'\s)][^)]*\)?|<!--|-->|\\.|[(){}\[\];]"
    r"|[^/\"'u<\\(){}\[\];-]+|.",
    re.DOTALL | re.IGNORECASE,
)
NAME = r"(?:[\w-]|[^\x00-\x7f]|\\[0-9a-fA-F]{1,6}\s?|\\[^0-9a-fA-F\n])+"
STEP = re.compile(
    rf"\s*(?P<link>[>+~])\s*|(?P<below>\s+)|(?P<any>\*)|(?P<own>&)|(?P<mark>[.#]?)(?P<name>{NAME})"
    rf"|\[\s*(?P<key>{NAME})\s*(?:(?P<how>[~|^$*]?=)\s*(?P<value>\"[^\"]*\"|'[^']*'|{NAME})\s*(?P<flag>[iIsS])?\s*)?\]"
    rf"|(?P<colons>::?)(?P<pseudo>{NAME})(?P<open>\()?"
)
ESCAPE = re.compile(r"\\(?:([0-9a-fA-F]{1,6})\s?|(.))", re.DOTALL)
NTH = re.compile(r"(?:([+-]?\d{0,9})n)?\s*([+-]?\s*\d{1,9})?")
#: Known pseudo-classes that no element has before a reader acts.
NEVER = frozenset(
    "hover focus active visited focus-within focus-visible target target-within current past future fullscreen"
    " modal popover-open autofill -webkit-autofill user-valid user-invalid playing picture-in-picture host".split()
)
DISPLAYS = frozenset(
    "none block inline inline-block flex inline-flex grid inline-grid table inline-table table-row table-cell"
    " table-row-group table-header-group table-footer-group table-column table-column-group table-caption list-item"
    " contents flow flow-root run-in ruby ruby-base ruby-text math -webkit-box -webkit-inline-box -webkit-flex"
    " -webkit-inline-flex -moz-box -ms-flexbox -ms-grid inherit initial unset revert revert-layer".split()
)
VISIBILITIES = frozenset("visible hidden collapse inherit initial unset revert revert-layer".split())


# -- conditions -----------------------------------------------------------------


def _number(text: str) -> float | None:
    top, _, bottom = text.partition("/")
    found = SIZE.fullmatch(top.strip())
    if not found or found.group(2) not in UNITS:
        return None
    value = float(found.group(1)) * UNITS[found.group(2)]
    if bottom:
        under = _number(bottom)
        return value / under if under else None
    return value


def _feature(text: str) -> bool | None:
    found = PLAIN.fullmatch(text)
    if found:
        bound, name, value = found.groups()
        if value is None:
            return bool(MEASURES[name]) if name in MEASURES else STATES[name] not in ("none", "no-preference") if name in STATES else None
        if name in STATES:
            return STATES[name] == value
        number = _number(value)
        if name not in MEASURES or number is None:
            return None
        return COMPARE[{"min": ">=", "max": "<=", None: "="}[bound]](MEASURES[name], number)
    found = RANGE.fullmatch(text)
    if not found or found.group(3) not in MEASURES:
        return None
    low, first, name, second, high = found.groups()
    own, answers = MEASURES[name], []
    for sign, other, turned in ((first, low, True), (second, high, False)):
        if sign:
            number = _number(other)
            if number is None:
                return None
            answers.append(COMPARE[sign](number, own) if turned else COMPARE[sign](own, number))
    return all(answers) if answers else None


def _supported(text: str) -> bool | None:
    return not text.startswith(("-ms-", "-moz-", "-o-", "-khtml-"))


def _all(values: list[bool | None]) -> bool | None:
    return False if False in values else None if None in values else True


def _condition(text: str, leaf: Callable[[str], bool | None]) -> bool | None:
    """The truth of ``not``, ``and``, ``or`` and brackets; None where a part is unknown."""
    values, negate, either, at = [], False, False, 0
    while at < len(text):
        if text[at] == "(":
            end, level = at, 0
            while end < len(text):
                level += {"(": 1, ")": -1}.get(text[end], 0)
                end += 1
                if level == 0:
                    break
            inner = text[at + 1 : end - (level == 0)].strip()
            value = _condition(inner, leaf) if re.match(r"\(|not\b", inner) else leaf(inner)
            values.append(value if not negate or value is None else not value)
            negate, at = False, end
            continue
        word = re.compile(r"\s+|[^\s(]+").match(text, at).group()
        if word == "not":
            negate = True
        elif word == "or":
            either = True
        elif word.strip() and word not in ("and", "selector"):
            return None
        at += len(word)
    if not values:
        return None
    if either:
        return True if True in values else None if None in values else False
    return _all(values)


def on_screen(query: str) -> bool:
    """Whether a media query list holds on the screen."""
    query = query.strip().lower()
    if not query:
        return True
    for one in query.split(","):
        found = re.fullmatch(r"(?:(not|only)\s+)?([a-z-]+)(?:\s+and\b\s*(.+))?", one.strip(), re.DOTALL)
        if found and found.group(2) not in ("not", "only"):
            turn, kind, rest = found.groups()
            held = _all([kind in ("all", "screen"), _condition(rest, _feature) if rest else True])
            if held is not None and turn == "not":
                held = not held
        else:
            held = _condition(one.strip(), _feature)
        if held:
            return True
    return False


# -- selectors ------------------------------------------------------------------


class Compound:
    __slots__ = ("attributes", "classes", "ids", "never", "pseudos", "tag", "within")

    def __init__(self) -> None:
        self.tag, self.ids, self.classes, self.attributes, self.pseudos = "", [], [], [], []
        self.within: list[tuple[bool, list[Selector]]] = []  # :is and :not
        self.never = False


class Selector:
    __slots__ = ("links", "parts", "weight")

    def __init__(self, parts: list[Compound], links: list[str], weight: tuple[int, int, int]):
        self.parts, self.links, self.weight = parts, links, weight
        #: Compounds one after another, with those of the longest selector within.


def _unescaped(name: str) -> str:
    def plain(found: re.Match) -> str:
        code = int(found.group(1), 16) if found.group(1) else 0
        return found.group(2) or (chr(code) if 0 < code < 0x110000 else "\ufffd")

    return ESCAPE.sub(plain, name) if "\\" in name else name


def _split(text: str) -> list[str]:
    """At commas outside of brackets and quotes."""
    out, level, start = [], 0, 0
    for found in re.finditer(r"\"[^\"]*\"|'[^']*'|\\.|[()\[\],]", text):
        mark = found.group()
        if mark in "([":
            level += 1
        elif mark in ")]":
            level -= 1
        elif mark == "," and level == 0:
            out.append(text[start : found.start()])
            start = found.end()
    return [*out, text[start:]]


def selectors(text: str, own: list[Selector] | None = None, depth: int = 0) -> list[Selector]:
    """The selectors of a list that are understood. ``own``: what ``&`` stands for."""
    found = [_selector(x.strip(), own, depth) for x in _split(text)]
    return [x for x in found if x is not None]


def _selector(text: str, own: list[Selector] | None, depth: int) -> Selector | None:
    if not text:
        return None
    parts, links, weight, at = [Compound()], [], [0, 0, 0], 0
    if own is not None and depth == 0:
        if text[0] in ">+~":
            text = "& " + text
        elif "&" not in text:
            text = "& " + text
    while at < len(text):
        step = STEP.match(text, at)
        if not step:
            return None
        at, part = step.end(), parts[-1]
        if step["link"] or step["below"]:
            links.append(step["link"] or " ")
            parts.append(Compound())
        elif step["own"]:
            if own is None:
                return None
            part.within.append((True, own))
            top = max((x.weight for x in own), default=(0, 0, 0))
            weight = [a + b for a, b in zip(weight, top, strict=True)]
        elif step["name"]:
            name = _unescaped(step["name"])
            if step["mark"] == "#":
                part.ids.append(name)
                weight[0] += 1
            elif step["mark"] == ".":
                part.classes.append(name)
                weight[1] += 1
            else:
                part.tag = name.lower()
                weight[2] += 1
        elif step["key"]:
            value = step["value"]
            if value is not None:
                value = _unescaped(value[1:-1] if value[0] in "\"'" else value)
            part.attributes.append((_unescaped(step["key"]).lower(), step["how"], value, (step["flag"] or "").lower() == "i"))
            weight[1] += 1
        elif step["pseudo"]:
            inside = None
            if step["open"]:
                end, level = at, 1
                while end < len(text) and level:
                    level += {"(": 1, ")": -1}.get(text[end], 0)
                    end += 1
                if level:
                    return None
                inside, at = text[at : end - 1].strip(), end
            name = step["pseudo"].lower()
            if step["colons"] == "::" or name in ("before", "after", "first-line", "first-letter"):
                part.never = True  # not the element itself
            elif name in ("not", "is", "where", "matches", "-webkit-any", "-moz-any") and inside is not None:
                inner = selectors(inside, own, depth + 1)
                if name == "not" and len(inner) < len(_split(inside)):
                    return None
                part.within.append((name != "not", inner))
                if name != "where":
                    top = max((x.weight for x in inner), default=(0, 0, 0))
                    weight = [a + b for a, b in zip(weight, top, strict=True)]
            elif name in NEVER:
                part.never = True
                weight[1] += 1
            else:
                test = _pseudo(name, inside)
                if test is None:
                    return None
                part.pseudos.append(test)
                weight[1] += 1
    return Selector(parts, links, tuple(weight))


def _pseudo(name: str, inside: str | None) -> Callable[[Node, Sheets], bool] | None:
    has = lambda key: lambda node, page: key in node.attributes
    simple = {
        "root": lambda node, page: node is page.root,
        "scope": lambda node, page: node is page.root,
        "empty": lambda node, page: not node.children,
        "link": lambda node, page: node.tag in ("a", "area") and "href" in node.attributes,
        "any-link": lambda node, page: node.tag in ("a", "area") and "href" in node.attributes,
        "checked": lambda node, page: ("selected" if node.tag == "option" else "checked") in node.attributes,
        "disabled": has("disabled"),
        "required": has("required"),
        "open": has("open"),
        "enabled": lambda node, page: node.tag in ("input", "button", "select", "textarea", "option")
        and "disabled" not in node.attributes,
        "defined": lambda node, page: "-" not in node.tag,
        "only-child": lambda node, page: len(page.family(node, False)) == 1,
        "only-of-type": lambda node, page: len(page.family(node, True)) == 1,
    }
    if inside is None and name in simple:
        return simple[name]
    found = re.fullmatch(r"(first|last|nth|nth-last)-(child|of-type)", name)
    if not found or (inside is None) != (found.group(1) in ("first", "last")):
        return None
    step, first = 0, 1
    if inside is not None:
        text = {"odd": "2n+1", "even": "2n"}.get(inside.lower(), inside.lower())
        shape = NTH.fullmatch(text.strip())
        if not shape or shape.group(1) is None and shape.group(2) is None:
            return None
        step = 0 if shape.group(1) is None else int(shape.group(1) + ("1" if shape.group(1) in ("", "+", "-") else ""))
        first = int(re.sub(r"\s", "", shape.group(2) or "0"))
    same, back = found.group(2) == "of-type", "last" in found.group(1)

    def test(node: Node, page: Sheets) -> bool:
        family = page.family(node, same)
        place = family[id(node)]
        place = len(family) - place if back else place + 1
        return place == first if step == 0 else (place - first) % step == 0 and (place - first) // step >= 0

    return test


# -- sheets ---------------------------------------------------------------------


def _declared(text: str) -> tuple[str, str, bool] | None:
    """Property, value and whether it is important, of a declaration that a browser takes."""
    name, colon, value = text.partition(":")
    name = name.strip().lower()
    if not colon or name not in ("display", "visibility"):
        return None
    value = value.strip().lower()
    strong = re.search(r"!\s*important\s*$", value)
    value = value[: strong.start()].strip() if strong else value
    known = DISPLAYS if name == "display" else VISIBILITIES
    if "var(" not in value and not (value and all(x in known for x in value.split())):
        return None
    return name, value, bool(strong)


def _pieces(text: str) -> Iterator[str]:
    for found in PIECE.finditer(text):
        piece = found.group()
        if piece.startswith("/*"):
            yield " "
        elif piece not in ("<!--", "-->"):
            yield piece


def inline(text: str) -> list[tuple[str, str, bool]]:
    """The declarations of a style attribute."""
    out, parts, level = [], [], 0
    for piece in [*_pieces(text), ";"]:
        if piece in "([{":
            level += 1
        elif piece in ")]}":
            level = max(level - 1, 0)
        if piece == ";" and level == 0:
            found = _declared("".join(parts))
            if found:
                out.append(found)
            parts = []
        else:
            parts.append(piece)
    return out


class Sheets:
    """The rules of a page's style sheets that apply on the screen."""

    def __init__(self, root: Node):
        self.root = root
        self.n = 0
        self.layers: dict[str, int] = {}
        #: By what the last compound asks for and by property, the strongest first.
        self.rules: dict[tuple[str, str], dict[str, list[tuple[tuple, Selector, str]]]] = {}
        todo = [root]
        while todo:
            node = todo.pop()
            if node.tag == "style":
                if node.attributes.get("type", "").strip().lower() in ("", "text/css") and on_screen(node.attributes.get("media", "")):
                    for sheet in node.children:
                        if isinstance(sheet, str) and SETTLING.search(sheet):
                            self._read(sheet)
            elif node.tag != "template":
                todo += [c for c in reversed(node.children) if isinstance(c, Node)]
        if self.rules:
            self._link()

    def _read(self, sheet: str) -> None:
        # open blocks: what they select (None: rules stand in them), whether they apply, their layer
        stack: list[tuple[list[Selector] | None, bool, str]] = [(None, True, "")]
        parts: list[str] = []
        level = 0
        for piece in [*_pieces(sheet), ";"]:
            chosen, applies, layer = stack[-1]
            if piece in "([":
                level += 1
            elif piece in ")]":
                level = max(level - 1, 0)
            if piece == "{" and level == 0:
                stack.append(self._open("".join(parts).strip(), chosen, applies, layer))
                parts = []
            elif piece == "}" or piece == ";" and level == 0:
                text, parts, level = "".join(parts).strip(), [], 0
                if chosen is not None and applies:
                    self._declare(text, chosen, layer)
                elif chosen is None and applies and text.lower().startswith("@layer"):
                    for name in text[6:].split(","):
                        self.layers.setdefault(f"{layer}.{name.strip()}", len(self.layers))
                if piece == "}" and len(stack) > 1:
                    stack.pop()
            else:
                parts.append(piece)
        for chosen, applies, layer in reversed(stack):  # blocks that never end
            if chosen is not None and applies and parts:
                self._declare("".join(parts), chosen, layer)
            parts = []

    def _open(self, head: str, chosen: list[Selector] | None, applies: bool, layer: str):
        if not applies:
            return chosen, False, layer
        if not head.startswith("@"):
            return selectors(head, chosen), True, layer
        found = re.match(r"@([\w-]+)\s*(.*)", head, re.DOTALL)
        kind, rest = (found.group(1).lower(), found.group(2)) if found else ("", "")
        if kind == "media":
            return chosen, on_screen(rest), layer
        if kind == "supports":
            return chosen, bool(_condition(rest.lower(), _supported)), layer
        if kind == "layer":
            layer = f"{layer}.{rest.strip() or len(self.layers)}"
            self.layers.setdefault(layer, len(self.layers))
            return chosen, True, layer
        return chosen, False, layer

    def _declare(self, text: str, chosen: list[Selector], layer: str) -> None:
        found = _declared(text)
        if not found:
            return
        name, value, strong = found
        rank = self.layers[layer] if layer else math.inf
        self.n += 1
        for selector in chosen:
            key = (strong, -rank if strong else rank, selector.weight, self.n)
            last = selector.parts[-1]
            if last.never:
                continue
            if last.ids:
                where = ("#", last.ids[0])
            elif last.classes:
                where = (".", last.classes[0])
            else:
                where = ("", last.tag)
            self.rules.setdefault(where, {}).setdefault(name, []).append((key, selector, value))

    def _link(self) -> None:
        self.parent: dict[int, tuple[Node | None, int]] = {id(self.root): (None, 0)}
        self.children: dict[int, list[Node]] = {}
        self.met: dict[tuple[int, int, int], bool] = {}
        self.first: dict[tuple[int, int, int], tuple[int, bool]] = {}
        self.families: dict[tuple[int, str], dict[int, int]] = {}
        for by_name in self.rules.values():
            for found in by_name.values():
                found.sort(key=lambda rule: rule[0], reverse=True)
        todo = [self.root]
        while todo:
            node = todo.pop()
            inner = [c for c in node.children if isinstance(c, Node)]
            self.children[id(node)] = inner
            for i, child in enumerate(inner):
                self.parent[id(child)] = (node, i)
            todo += inner

    def family(self, node: Node, same: bool) -> dict[int, int]:
        """Places of the element's siblings and itself, or of those of its tag."""
        parent = self.parent[id(node)][0]
        key = (id(parent), node.tag if same else "")
        if key not in self.families:
            inner = self.children[id(parent)] if parent is not None else [node]
            self.families[key] = {id(x): i for i, x in enumerate(y for y in inner if not same or y.tag == node.tag)}
        return self.families[key]

    def settled(self, node: Node) -> dict[str, tuple[tuple, str]]:
        """By property the strongest declaration that rules make for an element."""
        if not self.rules or id(node) not in self.parent:
            return {}
        keys = [("", node.tag), ("", "")]
        if node.raw:
            keys += [(".", x) for x in set(node.attributes.get("class", "").split())]
            keys.append(("#", node.attributes.get("id", "")))
        best: dict[str, tuple[tuple, str]] = {}
        for where in keys:
            for name, found in self.rules.get(where, {}).items():
                for key, selector, value in found:
                    if name in best and key < best[name][0]:
                        break
                    if self._meets(selector, len(selector.parts) - 1, node):
                        best[name] = (key, value)
                        break
        return best

    def _meets(self, selector: Selector, k: int, node: Node) -> bool:
        key = (id(selector), k, id(node))
        if key not in self.met:
            self.met[key] = self._fits(selector.parts[k], node) and (k == 0 or self._linked(selector, k - 1, node))
        return self.met[key]

    def _linked(self, selector: Selector, k: int, node: Node) -> bool:
        parent, place = self.parent[id(node)]
        if parent is None:
            return False
        link = selector.links[k]
        if link == ">":
            return self._meets(selector, k, parent)
        if link == "+":
            return place > 0 and self._meets(selector, k, self.children[id(parent)][place - 1])
        if link == "~":
            at, found = self.first.get((id(selector), k, id(parent)), (0, False))
            siblings = self.children[id(parent)]
            while not found and at < place:
                found = self._meets(selector, k, siblings[at])
                at += not found
            self.first[(id(selector), k, id(parent))] = (at, found)
            return found and at < place
        while parent is not None:
            if self._meets(selector, k, parent):
                return True
            parent = self.parent[id(parent)][0]
        return False

    def _fits(self, part: Compound, node: Node) -> bool:
        if part.never or part.tag and part.tag != node.tag:
            return False
        if part.ids or part.classes or part.attributes:
            if not node.raw:
                return False
            own = node.attributes
            if part.ids and any(x != own.get("id") for x in part.ids):
                return False
            if part.classes and not set(part.classes) <= set(own.get("class", "").split()):
                return False
            if not all(_attribute(own.get(key), how, value, fold) for key, how, value, fold in part.attributes):
                return False
        return all(test(node, self) for test in part.pseudos) and all(
            any(self._meets(x, len(x.parts) - 1, node) for x in inner) == wanted for wanted, inner in part.within
        )


def _attribute(own: str | None, how: str | None, value: str | None, fold: bool) -> bool:
    if own is None or how is None:
        return own is not None
    if fold:
        own, value = own.lower(), value.lower()
    if how == "=":
        return own == value
    if how == "~=":
        return value in own.split()
    if how == "|=":
        return own == value or own.startswith(value + "-")
    if not value:
        return False
    return own.startswith(value) if how == "^=" else own.endswith(value) if how == "$=" else value in own
