"""HTML as a tree of elements, for Arrow batches of pages.

A tokenizer and a stack of open elements, by the rules that decide where elements end: void elements,
raw text up to its end tag, end tags that a later element implies, and end tags that close all open elements up
to theirs or, without one, nothing. Unclosed elements end with their parent. The module stands alone and travels with the
functions that use it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

#: Fixed values of HTML: elements without content, with raw text, and those whose end another start tag implies.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
_BLOCKS = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), **{b: ({"p"}, {"button", "td", "th", "article", "div", "section"}) for b in _BLOCKS}}


class Tree:
    """Elements in page order: tag, attributes, parent, and where each begins, its content begins and ends, and it ends."""

    def __init__(self, html: str):
        self.html = html
        self.tags: list[str] = []
        self.attributes: list[dict[str, str]] = []
        self.parents: list[int] = []
        self.spans: list[list[int]] = []
        self.texts: list[tuple[int, int, int, bool]] = []  # element, from, to, raw
        self.depth = 0
        self._build()

    def _build(self) -> None:
        html, at, n = self.html, 0, len(self.html)
        stack: list[int] = []

        def text(a: int, b: int, raw: bool = False) -> None:
            if a < b:
                self.texts.append((stack[-1] if stack else -1, a, b, raw))

        def close(k: int, inner: int, end: int) -> None:
            """Ends the k-th open element, whose end tag ends at `end`, and those inside, which have none."""
            for element in stack[k + 1 :]:
                self.spans[element][2:] = [inner, inner]
            self.spans[stack[k]][2:] = [inner, end]
            del stack[k:]

        while at < n:
            m = _TOKEN.search(html, at)
            if m is None:
                break
            text(at, m.start())
            at = m.end()
            if m[1]:
                name = m[1].lower()
                k = next((k for k in range(len(stack) - 1, -1, -1) if self.tags[stack[k]] == name), None)
                if k is not None:
                    close(k, m.start(), m.end())
            elif m[2]:
                name = m[2].lower()
                gone, stop = ENDS.get(name, ((), ()))
                for k in range(len(stack) - 1, -1, -1):
                    if (tag := self.tags[stack[k]]) in stop:
                        break
                    if tag in gone:
                        close(k, m.start(), m.start())
                        if name != "tr":
                            break
                element = len(self.tags)
                self.tags.append(name)
                found: dict[str, str] = {}
                for a in _ATTRIBUTE.finditer(m[3]):
                    found.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
                self.attributes.append(found)
                self.parents.append(stack[-1] if stack else -1)
                self.spans.append([m.start(), m.end(), m.end(), m.end()])
                self.depth = max(self.depth, len(stack) + 1)
                if name in RAW:
                    end = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(html, at)
                    stop_at = end.start() if end else n
                    stack.append(element)
                    text(at, stop_at, name in ("script", "style"))
                    close(len(stack) - 1, stop_at, end.end() if end else n)
                    at = end.end() if end else n
                elif name not in VOID:
                    stack.append(element)
        text(at, n)
        if stack:
            close(0, n, n)

    def inside(self, root: int | None = None) -> Iterator[int]:
        """Elements below root, in page order; all without one."""
        if root is None:
            yield from range(len(self.tags))
            return
        end = self.spans[root][3]
        k = root + 1
        while k < len(self.tags) and self.spans[k][0] < end:
            yield k
            k += 1

    def find(self, root: int | None = None, tag: str | None = None, **attributes: str | None) -> Iterator[int]:
        """Elements below root of that tag and attributes; None: any value. An underscore stands for a hyphen."""
        want = {k.replace("_", "-"): v for k, v in attributes.items()}
        for k in self.inside(root):
            own = self.attributes[k]
            if (tag is None or self.tags[k] == tag) and all(name in own and (v is None or own[name] == v) for name, v in want.items()):
                yield k

    def ancestors(self, element: int) -> Iterator[int]:
        while (element := self.parents[element]) >= 0:
            yield element

    def text(self, element: int) -> str:
        """Text below an element, scripts and styles left out, with a blank for a line break; white space collapsed and trimmed."""
        begin, end = self.spans[element][1:3]
        out = []
        for _, a, b, raw in self.texts:
            if begin <= a and b <= end and not raw:
                out.append((a, unescape(self.html[a:b])))
        out += [(self.spans[k][0], " ") for k in self.inside(element) if self.tags[k] in ("br", "p", "div", "li")]
        return re.sub(r"\s+", " ", "".join(t for _, t in sorted(out))).strip()

    def outer(self, element: int) -> str:
        return self.html[self.spans[element][0] : self.spans[element][3]]


def articles(html: str | None) -> list[str]:
    """Each post element of a page, one inside another too."""
    if not html or "tweet" not in html:
        return []
    tree = Tree(html)
    return [tree.outer(k) for k in tree.find(tag="article", data_testid="tweet")]


def post_parts(html: str | None) -> dict:
    """What a post element shows: its time, the link around the time, its text, links of its author, and labels of its numbers."""
    tree = Tree(html or "")
    own = next(tree.find(tag="article"), None)
    time = next(tree.find(own, "time", datetime=None), None)
    link = next((k for k in tree.ancestors(time) if tree.tags[k] == "a" and "/status/" in tree.attributes[k].get("href", "")), None) if time is not None else None
    content = next(tree.find(own, data_testid="tweetText"), None)
    names = [tree.attributes[a]["href"] for n in tree.find(own, data_testid="User-Name") for a in tree.find(n, "a", href=None) if tree.attributes[a]["href"].startswith("/")]

    def label(k: int | None) -> str | None:
        return None if k is None else tree.attributes[k].get("aria-label") or tree.text(k)

    views = next((a for a in tree.find(own, "a", href=None) if tree.attributes[a]["href"].endswith("/analytics")), None)
    return {
        "time": tree.attributes[time]["datetime"] if time is not None else None, "href": tree.attributes[link]["href"] if link is not None else None,
        "content": tree.text(content) if content is not None else "", "names": names, "views": label(views),
        **{name: label(next(tree.find(own, data_testid=name), None)) for name in ("reply", "retweet", "like", "bookmark")},
    }


def outline(html: str | None) -> dict:
    """Title, first heading, targets of links, number of elements and depth of a page."""
    tree = Tree(html or "")
    title, heading = next(tree.find(tag="title"), None), next(tree.find(tag="h1"), None)
    return {
        "title": tree.text(title) if title is not None else None, "heading": tree.text(heading) if heading is not None else None,
        "links": [tree.attributes[a]["href"] for a in tree.find(tag="a", href=None)], "n_elements": len(tree.tags), "depth": tree.depth,
    }
