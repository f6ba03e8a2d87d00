"""An allow-list for markup, by HTML's rules of tree construction (STR-12).

Tags change a stack of open elements and a list of active formatting elements, as the HTML standard has it for the
content of a body: start tags imply end tags (a block ends an open paragraph, an item the item before), end tags close
what is open within their scope, formatting elements go on after the block that they were open in (they are opened
again before the next text), and those that overlap with blocks are adopted by them.  The tree is then written with the
allowed elements and attributes; what stands in others stays, but for elements that go with their content.

Not followed: the placing of misnested content before tables, and the modes of templates, frames and select lists; their
tags are ordinary elements here.  One document at a time, in memory linear in it.
"""

from __future__ import annotations

from html import escape
from html.parser import HTMLParser

# What the sanitiser lets through.
ALLOWED_TAGS = ["b", "i", "em", "strong", "a", "p", "br", "ul", "ol", "li", "span", "div", "mark", "sub", "sup", "blockquote"]
ALLOWED_ATTRIBUTES = ["href", "class", "target", "rel"]
# Schemes of addresses that the sanitiser lets through.
ALLOWED_SCHEMES = ["http", "https", "ftp", "ftps", "mailto", "tel", "callto", "sms", "cid", "xmpp", "matrix"]
#: Elements whose content goes with them.
DROPPED_WHOLE = ["script", "style", "template", "iframe", "noscript", "noembed", "noframes", "object", "svg", "math", "title", "textarea", "xmp"]

# Groups of elements in HTML's rules.
BLOCKS = ["address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "header", "hgroup", "main", "menu", "nav", "ol", "p", "pre", "listing", "search", "section", "summary", "ul"]
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
FORMATTING = ["a", "b", "big", "code", "em", "font", "i", "nobr", "s", "small", "strike", "strong", "tt", "u"]
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
IMPLIED_END = ["dd", "dt", "li", "optgroup", "option", "p", "rb", "rp", "rt", "rtc"]
OUTER = ["html", "head", "body"]
SCOPE = ["applet", "caption", "marquee", "table", "td", "th", ""]
SPECIAL = [*BLOCKS, *HEADINGS, "applet", "button", "caption", "colgroup", "dd", "dt", "li", "marquee", "plaintext", "select", "table", "tbody", "td", "tfoot", "th", "thead", "tr", ""]


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: tuple = ()):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], None

    def add(self, child: Node | str) -> None:
        if isinstance(child, Node):
            child.parent = self
        self.children.append(child)


class Tree(HTMLParser):
    """Builds the tree of a body's content; the standard parser of the language only finds the tags."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]
        self.active: list[Node] = []
        self.skipped: list[str] = []

    # what is open

    def _within(self, tags: list[str], *more: str) -> bool:
        """Whether one of ``tags`` is open, inside the nearest element that bounds its scope."""
        for node in reversed(self.open):
            if node.tag in tags:
                return True
            if node.tag in SCOPE or node.tag in more:
                return False
        return False

    def _imply(self, but: str = "") -> None:
        while self.open[-1].tag in IMPLIED_END and self.open[-1].tag != but:
            self.open.pop()

    def _pop_to(self, tags: list[str]) -> None:
        while self.open.pop().tag not in tags:
            pass

    def _close(self, tag: str) -> None:
        self._imply(tag)
        self._pop_to([tag])

    def _close_p(self) -> None:
        if self._within(["p"], "button"):
            self._close("p")

    def _insert(self, tag: str, attrs: tuple = ()) -> Node:
        node = Node(tag, attrs)
        self.open[-1].add(node)
        self.open.append(node)
        return node

    # formatting

    def _activate(self, node: Node) -> None:
        same = [n for n in self.active if n.tag == node.tag and n.attrs == node.attrs]
        if len(same) >= 3:
            self._forget(same[0])
        self.active.append(node)

    def _forget(self, node: Node) -> None:
        self.active = [n for n in self.active if n is not node]

    def _is_open(self, node: Node) -> bool:
        return any(n is node for n in reversed(self.open))

    def _reopen(self) -> None:
        first = len(self.active)
        while first and not self._is_open(self.active[first - 1]):
            first -= 1
        for k in range(first, len(self.active)):
            self.active[k] = self._insert(self.active[k].tag, self.active[k].attrs)

    def _adopt(self, tag: str) -> None:
        """The end of a formatting element, which may be inside of blocks that it was opened before."""
        if self.open[-1].tag == tag and not any(n is self.open[-1] for n in self.active):
            self.open.pop()
            return
        for _ in range(8):
            node = next((n for n in reversed(self.active) if n.tag == tag), None)
            if node is None:
                self._other_end(tag)
                return
            if not self._is_open(node):
                self._forget(node)
                return
            if not self._within_scope(node):
                return
            at = next(k for k, n in enumerate(self.open) if n is node)
            block = next((k for k in range(at + 1, len(self.open)) if self.open[k].tag in SPECIAL), None)
            if block is None:
                del self.open[at:]
                self._forget(node)
                return
            furthest, above = self.open[block], self.open[at - 1]
            place = next(k for k, n in enumerate(self.active) if n is node)
            last, kept = furthest, []
            for k in range(block - 1, at, -1):
                between = self.open[k]
                if not any(n is between for n in self.active) or block - k > 3:
                    self._forget(between)
                    continue
                copy = Node(between.tag, between.attrs)
                where = next(j for j, n in enumerate(self.active) if n is between)
                self.active[where] = copy
                if last is furthest:
                    place = where + 1
                self._move(last, copy)
                kept.append(copy)
                last = copy
            self._move(last, above)
            copy = Node(node.tag, node.attrs)
            for child in furthest.children:
                copy.add(child)
            furthest.children = []
            furthest.add(copy)
            before = sum(1 for n in self.active[:place] if n is node)
            self._forget(node)
            self.active.insert(min(place - before, len(self.active)), copy)
            self.open[at : block + 1] = [*reversed(kept), furthest, copy]

    def _within_scope(self, node: Node) -> bool:
        for n in reversed(self.open):
            if n is node:
                return True
            if n.tag in SCOPE:
                return False
        return False

    @staticmethod
    def _move(node: Node, to: Node) -> None:
        if node.parent is not None:
            node.parent.children = [c for c in node.parent.children if c is not node]
        to.add(node)

    def _other_end(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                self._imply(tag)
                del self.open[min(k, len(self.open) - 1) :]
                return
            if self.open[k].tag in SPECIAL:
                return

    # tags

    def handle_starttag(self, tag, attrs):
        if tag in DROPPED_WHOLE:
            self.skipped.append(tag)
        if self.skipped or tag in OUTER:
            return
        attrs = tuple((k, v or "") for k, v in attrs)
        if tag in BLOCKS or tag == "hr":
            self._close_p()
        elif tag in HEADINGS:
            self._close_p()
            if self.open[-1].tag in HEADINGS:
                self.open.pop()
        elif tag in ("li", "dd", "dt"):
            for node in reversed(self.open):
                if node.tag == tag or (tag != "li" and node.tag in ("dd", "dt")):
                    self._close(node.tag)
                    break
                if node.tag in SPECIAL and node.tag not in ("address", "div", "p"):
                    break
            self._close_p()
        else:
            if tag in ("a", "nobr") and any(n.tag == tag for n in self.active):
                node = next(n for n in reversed(self.active) if n.tag == tag)
                self._adopt(tag)
                self._forget(node)
                self.open = [n for n in self.open if n is not node]
            self._reopen()
        node = self._insert(tag, attrs)
        if tag in VOID:
            self.open.pop()
        elif tag in FORMATTING:
            self._activate(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in DROPPED_WHOLE:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.skipped:
            if tag == self.skipped[-1]:
                self.skipped.pop()
        elif tag == "p":
            if not self._within(["p"], "button"):
                self._insert("p")
            self._close("p")
        elif tag == "br":
            self.handle_starttag("br", [])
        elif tag == "li":
            if self._within(["li"], "ol", "ul"):
                self._close("li")
        elif tag in BLOCKS or tag in ("dd", "dt"):
            if self._within([tag]):
                self._close(tag)
        elif tag in HEADINGS:
            if self._within(HEADINGS):
                self._imply()
                self._pop_to(HEADINGS)
        elif tag in FORMATTING:
            self._adopt(tag)
        elif tag not in OUTER:
            self._other_end(tag)

    def handle_data(self, data):
        if data and not self.skipped:
            self._reopen()
            self.open[-1].add(data)

    def result(self) -> str:
        """The tree as text, allowed elements and attributes only."""
        self.close()
        out: list[str] = []
        todo: list[Node | str] = [self.root]
        while todo:  # tags to write stand in a list of one
            x = todo.pop()
            if isinstance(x, list):
                out += x
            elif isinstance(x, str):
                out.append(_written(x))
            else:
                if x.tag in ALLOWED_TAGS:
                    kept = "".join(f' {k}="{_written(v).replace(chr(34), "&quot;")}"' for k, v in x.attrs if k in ALLOWED_ATTRIBUTES and _safe(k, v))
                    out.append(f"<{x.tag}{kept}>")
                    if x.tag not in VOID:
                        todo.append([f"</{x.tag}>"])
                todo += reversed(x.children)
        return "".join(out)


def _written(text: str) -> str:
    return escape(text, quote=False).replace("\xa0", "&nbsp;")


def _safe(name: str, value: str) -> bool:
    """An address within the site, or one whose scheme is allowed.  Blanks and controls do not hide a scheme."""
    if name != "href":
        return True
    address = "".join(c for c in value if c.isprintable() and not c.isspace())
    scheme, colon, _ = address.partition(":")
    has_scheme = colon and not any(mark in scheme for mark in "/?#")
    return not has_scheme or scheme.lower() in ALLOWED_SCHEMES


def sanitise(html: str | None) -> str:
    """One document through the allow-list; null and empty give the empty string."""
    if not html:
        return ""
    if "<" not in html:
        return html
    tree = Tree()
    tree.feed(html)
    return tree.result()
