"""Page parser: one pass over a page's HTML, used on Arrow batches inside tasks.

Tolerates unclosed tags: a new paragraph, list item, table part or option closes an open one.
"""

from __future__ import annotations

from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SILENT = {"script", "style", "template"}
CLOSED_BY_BLOCK = {"p"}
BLOCKS = {
    "p", "div", "ul", "ol", "li", "table", "section", "article", "header", "footer", "nav", "main",
    "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "form", "dl", "hr", "aside", "figure",
}
SAME = {"li": {"li"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
HEADINGS = {"h1", "h2", "h3", "strong"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs=None, parent=None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], parent

    def walk(self):
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            if isinstance(node, Node):
                stack.extend(reversed(node.children))

    def text(self) -> str:
        """Text pieces, each trimmed, joined by one space; scripts and styles left out."""
        pieces, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                piece = node.strip()
                if piece:
                    pieces.append(piece)
            elif node is self or node.tag not in SILENT:
                stack.extend(reversed(node.children))
        return " ".join(pieces)

    def get(self, name: str) -> str:
        return (self.attrs.get(name) or "").strip()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page")
        self.open = self.root

    def _close_implied(self, tag):
        stop = SAME.get(tag, set()) | (CLOSED_BY_BLOCK if tag in BLOCKS else set())
        node = self.open
        while node is not self.root and node.tag not in {"div", "table", "ul", "ol", "article", "section", "body"}:
            if node.tag in stop:
                self.open = node.parent
                if node.tag not in SAME.get("tr", set()):
                    return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        self._close_implied(tag)
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.open.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.open))

    def handle_endtag(self, tag):
        node = self.open
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.open = node.parent

    def handle_data(self, data):
        # Adjacent pieces are one text, as in the page.
        if self.open.children and isinstance(self.open.children[-1], str):
            self.open.children[-1] += data
        else:
            self.open.children.append(data)


def page(html: str) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def elements(root: Node, *tags: str) -> list[Node]:
    return [n for n in root.walk() if isinstance(n, Node) and n.tag in tags]


def _metas(root: Node, key: str) -> list[str]:
    metas = elements(root, "meta")
    return [m.get("content") for m in metas if m.attrs.get("name") == key] or [
        m.get("content") for m in metas if m.attrs.get("property") == key
    ]


def _after_heading(root: Node) -> str:
    """Text of the siblings after the first heading that names the abstract, up to the next heading."""
    for node in elements(root, "h2", "h3", "strong"):
        if "abstract" in node.text().lower():
            siblings = [c for c in node.parent.children if isinstance(c, Node)]
            parts = []
            for sibling in siblings[siblings.index(node) + 1:]:
                if sibling.tag in HEADINGS:
                    break
                piece = sibling.text() if sibling.tag not in SILENT else ""
                if piece:
                    parts.append(piece)
            return " ".join(parts).strip()
    return ""


def facts(html: str) -> dict:
    """The raw pieces a record is assembled from; choices among them are Spark expressions."""
    root = page(html)
    first = lambda tag: next((n.text() for n in elements(root, tag)), "")
    one = lambda key: next(iter(_metas(root, key)), "")
    anchors = elements(root, "a")
    return {
        "h1": first("h1"),
        "title_tag": first("title"),
        "page_text": root.text(),
        "abstract_block": _after_heading(root),
        "meta_title": one("citation_title"),
        "meta_og_title": one("og:title"),
        "meta_date": one("citation_publication_date") or one("citation_date"),
        "meta_abstract": one("citation_abstract") or one("description"),
        "meta_authors": [m.get("content") for m in elements(root, "meta") if m.attrs.get("name") == "citation_author"],
        "anchors": [
            {"href": a.get("href"), "label": a.text(), "title": a.get("title"), "aria": a.get("aria-label")}
            for a in anchors if "href" in a.attrs
        ],
    }
