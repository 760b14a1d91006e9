"""A small document tree on the standard library's HTML parser, with the selectors that extraction rules use.

Tags close as written: an end tag closes the nearest open element of its name and all inside it, and
nothing closes by implication. Void elements hold nothing. Text of script and style and comments are
not part of the text of an element.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

# Elements without content, and elements whose text is no text of the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(("script", "style", "template"))


class Element:
    __slots__ = ("attributes", "children", "name", "parent")

    def __init__(self, name: str, attributes: dict[str, str], parent: Element | None) -> None:
        self.name, self.attributes, self.parent = name, attributes, parent
        self.children: list[Element | str] = []

    @property
    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()

    def walk(self) -> Iterator[Element]:
        """All elements below, in document order; without recursion, as documents nest deeply."""
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, Element):
                    yield child
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()

    def strings(self) -> Iterator[str]:
        """The visible strings below, stripped, without empty ones."""
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, str):
                    if s := child.strip():
                        yield s
                elif child.name not in HIDDEN:
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()

    def text(self) -> str:
        return " ".join(self.strings())

    def raw(self) -> str:
        """All strings directly inside, as written: the body of a script."""
        return "".join(c for c in self.children if isinstance(c, str))

    def inner_html(self) -> str:
        out: list[str] = []
        stack: list[Element | str] = [*reversed(self.children)]
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                out.append(c)
                continue
            out.append("<" + c.name + "".join(f' {k}="{v}"' for k, v in c.attributes.items()) + ("/>" if c.name in VOID else ">"))
            if c.name not in VOID:
                stack.append(f"</{c.name}>")
                stack.extend(reversed(c.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        own = {}
        for k, v in attrs:
            own.setdefault(k, v or "")
        e = Element(tag, own, self.at)
        self.at.children.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        e: Element | None = self.at
        while e is not None and e.name != tag:
            e = e.parent
        if e is not None and e.parent is not None:
            self.at = e.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    """The tree of a document; null and empty text give an empty one, and broken markup what can be read of it."""
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


# --- selectors: type, .class, #id, [attr], [attr=value], compounds of them, descendants, lists ------

_SIMPLE = re.compile(r"""(?P<type>\*|[A-Za-z][\w-]*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~|^$*]?=)\s*(?:"(?P<q>[^"]*)"|'(?P<s>[^']*)'|(?P<v>[^\]\s]+))\s*)?\]""")


def _compound(text: str) -> list[tuple[str, str, str]]:
    tests, at = [], 0
    while at < len(text):
        if not (m := _SIMPLE.match(text, at)):
            raise ValueError(f"selector not supported: {text!r}")
        if m["type"]:
            tests.append(("type", m["type"].lower(), ""))
        elif m["cls"]:
            tests.append(("class", m["cls"], ""))
        elif m["id"]:
            tests.append(("id", m["id"], ""))
        else:
            tests.append(("attr" + (m["op"] or ""), m["attr"].lower(), next((x for x in (m["q"], m["s"], m["v"]) if x is not None), "")))
        at = m.end()
    return tests


def _holds(e: Element, tests: list[tuple[str, str, str]]) -> bool:
    for kind, a, b in tests:
        v = e.attributes.get(a)
        ok = {
            "type": lambda a=a: a in ("*", e.name),
            "class": lambda a=a: a in e.classes,
            "id": lambda a=a: e.attributes.get("id") == a,
            "attr": lambda v=v: v is not None,
            "attr=": lambda v=v, b=b: v == b,
            "attr~=": lambda v=v, b=b: v is not None and b in v.split(),
            "attr|=": lambda v=v, b=b: v is not None and (v == b or v.startswith(b + "-")),
            "attr^=": lambda v=v, b=b: bool(b) and v is not None and v.startswith(b),
            "attr$=": lambda v=v, b=b: bool(b) and v is not None and v.endswith(b),
            "attr*=": lambda v=v, b=b: bool(b) and v is not None and b in v,
        }[kind]()
        if not ok:
            return False
    return True


class Selector:
    """A compiled selector list; `select` gives the matching elements below a scope in document order."""

    def __init__(self, text: str) -> None:
        self.chains = [[_compound(part) for part in re.findall(r"(?:\[[^\]]*\]|\S)+", chain)] for chain in re.split(r",(?![^\[]*\])", text) if chain.strip()]

    def _matches(self, e: Element, chain: list, scope: Element) -> bool:
        if not _holds(e, chain[-1]):
            return False
        i, up = len(chain) - 2, e.parent
        while i >= 0 and up is not None:
            if up.parent is not None and _holds(up, chain[i]):
                i -= 1
            up = up.parent
        return i < 0

    def select(self, scope: Element) -> list[Element]:
        return [e for e in scope.walk() if any(self._matches(e, c, scope) for c in self.chains)]
