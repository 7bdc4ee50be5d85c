"""Links, images, labelled values and text of stored pages: one small parser inside UDTFs."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql.functions import pandas_udf, udtf

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_SILENT = {"script", "style", "template", "noscript"}
_LABEL_TAGS = {"th", "dt", "strong", "span", "p", "li"}


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            if isinstance(n, Node):
                stack += reversed(n.children)

    def text(self, sep: str = " ") -> str:
        parts = [x.strip() for x in self.walk() if isinstance(x, str)]
        return sep.join(p for p in parts if p)


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        if self.at.tag not in _SILENT:
            self.at.children.append(data)


def parse(html: str | None) -> Node:
    t = _Tree()
    t.feed(html or "")
    t.close()
    return t.root


def _path(n: Node, depth: int = 6) -> str:
    out = []
    while n is not None and n.tag and len(out) < depth:
        out.append(n.tag)
        n = n.parent
    return ">".join(reversed(out))


@udtf(returnType="position: int, href: string, text: string")
class Links:
    """Anchors whose address holds `needle`; without text, an image's alt."""

    def eval(self, html: str, needle: str):
        i = 0
        for n in parse(html).walk():
            if isinstance(n, Node) and n.tag == "a" and (needle or "") in n.attrs.get("href", "") and "href" in n.attrs:
                text = n.text() or next((x.attrs["alt"].strip() for x in n.walk() if isinstance(x, Node) and x.tag == "img" and x.attrs.get("alt")), "")
                yield i, n.attrs["href"], text or None
                i += 1


@udtf(returnType="position: int, src: string, alt: string, class_name: string, dom_path: string, width: string, height: string")
class Images:
    def eval(self, html: str):
        i = 0
        for n in parse(html).walk():
            if isinstance(n, Node) and n.tag == "img":
                a = n.attrs
                yield i, a.get("src") or a.get("data-src"), a.get("alt"), a.get("class"), _path(n), a.get("width"), a.get("height")
                i += 1


def labelled_value(root: Node, labels: list[str]) -> str | None:
    """For each label in order: what follows the first element that holds it, or else its parent's other text."""
    for label in labels:
        for n in root.walk():
            if not (isinstance(n, Node) and n.tag in _LABEL_TAGS and label in n.text()):
                continue
            siblings = [s for s in n.parent.children if isinstance(s, Node)]
            after = siblings[siblings.index(n) + 1 :]
            value = after[0].text() if after else n.parent.text().replace(n.text(), "", 1).strip()
            if value:
                return value
            break
    return None


def title_of(root: Node) -> str | None:
    """The first heading, or else the page title up to a bar."""
    for tag in ("h1", "h2"):
        for n in root.walk():
            if isinstance(n, Node) and n.tag == tag and n.text():
                return n.text()
    for n in root.walk():
        if isinstance(n, Node) and n.tag == "title" and n.text():
            return n.text().split("|")[0].strip() or None
    return None


def page_udf(labels: list[str]):
    """html -> struct(title, value of the labels, text of the body or else of the page)."""
    @pandas_udf("title string, value string, text string")
    def run(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for html in pages:
            root = parse(html)
            body = next((n for n in root.walk() if isinstance(n, Node) and n.tag == "body"), root)
            rows.append((title_of(root), labelled_value(root, labels), body.text("\n")))
        return pd.DataFrame(rows, columns=["title", "value", "text"])

    return run
