"""A small DOM of a page, and what its nodes look like to the classifier."""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np

# Element names of the HTML standard.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
UNSHOWN = {"head", "title", "script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas",
           "audio", "video", "select", "datalist", "textarea", "map"}
BLOCK = {"html", "body", "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div",
         "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
         "hgroup", "hr", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search",
         "section", "summary", "table", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: An opening tag of the key closes an open one of the values, up to the
#: nearest of the last entry.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Groups of tags the classifier tells apart.
TAG_GROUPS = (
    ("article", "main"), ("section",), ("div",), ("nav", "menu"), ("aside",), ("header",), ("footer", "address"),
    ("form", "fieldset", "dialog"), ("p", "blockquote", "pre"), ("h1",), ("h2", "h3", "h4", "h5", "h6"),
    ("ul", "ol", "dl"), ("li", "dt", "dd"), ("a",), ("table", "tbody", "tr", "td", "th"),
    ("figure", "figcaption"), ("button", "label", "input"), ("html", "body"),
)
#: Groups of words in class, id, role and label attributes.
TOKEN_GROUPS = (
    ("article", "articlebody", "content", "main", "post", "story", "entry", "body", "text", "page", "blog"),
    ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "tabs"),
    ("ad", "ads", "adv", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion", "adsense"),
    ("sidebar", "side", "aside", "widget", "widgets", "rail", "related", "recommended", "trending", "popular", "more"),
    ("footer", "foot", "bottom", "copyright", "legal", "contentinfo"),
    ("header", "head", "masthead", "top", "topbar", "logo", "site"),
    ("comment", "comments", "reply", "replies", "disqus", "discussion", "respond", "reader"),
    ("form", "login", "signup", "subscribe", "newsletter", "search", "contact", "register"),
    ("cookie", "cookies", "notice", "consent", "gdpr", "alert", "popup", "modal", "overlay", "privacy", "message"),
    ("share", "social", "sharing", "follow", "meta", "byline", "tags", "tools"),
)
_TAG_OF = {t: k for k, group in enumerate(TAG_GROUPS) for t in group}
_TOKEN_OF = {t: k for k, group in enumerate(TOKEN_GROUPS) for t in group}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARKS = re.compile(r"[.,;:!?]")
_SPACE = re.compile(r"\s+")
N_FEATURES = 20 + 2 * len(TAG_GROUPS) + 2 * len(TOKEN_GROUPS)


class Dom(HTMLParser):
    """Elements in page order; children follow their parent. ``texts`` holds
    ``(element, block, text)``; blocks are numbered in page order."""

    def __init__(self, html: str, label: str | None = None):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.depths, self.tokens, self.labels = ["html"], [-1], [0], [0], [None]
        self.texts: list[tuple[int, int, str]] = []
        self.stack, self.open, self.block, self.hidden = [0], {"html": 1}, 0, 0
        self.label = label
        self.feed(html)
        self.close()

    def _pop(self) -> str:
        tag = self.tags[self.stack.pop()]
        self.open[tag] -= 1
        if tag in BLOCK:
            self.block += 1
        if tag in UNSHOWN:
            self.hidden -= 1
        return tag

    def _close_to(self, tags: set[str], scope: set[str]) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.tags[self.stack[k]]
            if tag in tags:
                while len(self.stack) > k:
                    self._pop()
                return
            if tag in scope:
                return

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "html" or (tag == "body" and self.open.get("body")):
            return
        if tag == "body" and self.open.get("head"):
            self._close_to({"head"}, set())
        if tag == "br":
            self.texts.append((self.stack[-1], self.block, " "))
            return
        if tag in BLOCK:
            if self.open.get("p"):
                self._close_to({"p"}, {"td", "th", "button", "table", "caption"})
            if tag in CLOSES and any(self.open.get(t) for t in CLOSES[tag][0]):
                self._close_to(*CLOSES[tag])
            self.block += 1
        if tag in VOID:
            return
        found, own = 0, None
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop", "aria-label"):
                for word in _WORDS.findall(value or ""):
                    k = _TOKEN_OF.get(word.lower())
                    if k is not None:
                        found |= 1 << k
            elif name == self.label:
                own = value
        parent = self.stack[-1]
        self.stack.append(len(self.tags))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.hidden += tag in UNSHOWN
        self.tags.append(tag)
        self.parents.append(parent)
        self.depths.append(self.depths[parent] + 1)
        self.tokens.append(found)
        self.labels.append(own if own is not None else self.labels[parent])

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing on an element that can hold text

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and not self.open.get("p"):
            self.block += 1
        elif tag != "html" and self.open.get(tag):
            while self._pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.texts.append((self.stack[-1], self.block, data))

    def features(self) -> np.ndarray:
        """A row per element."""
        n = len(self.tags)
        own, link, marks, words = [0] * n, [0] * n, [0] * n, [0] * n
        linked = [False] * n
        for i in range(1, n):
            linked[i] = self.tags[i] == "a" or linked[self.parents[i]]
        seen = 0
        first = [None] * n
        for i, _, text in self.texts:
            size = len(text) if len(text.strip()) else 0
            if first[i] is None:
                first[i] = seen
            own[i] += size
            link[i] += size if linked[i] else 0
            marks[i] += len(_MARKS.findall(text))
            words[i] += text.count(" ") + 1 if size else 0
            seen += size
        text, subtree, children, order = own[:], [1] * n, [0] * n, [0] * n
        links, stops, counts, most = link[:], marks[:], words[:], [0] * n
        for i in range(1, n):
            p = self.parents[i]
            order[i] = children[p]
            children[p] += 1
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            text[p] += text[i]
            links[p] += links[i]
            stops[p] += stops[i]
            counts[p] += counts[i]
            subtree[p] += subtree[i]
            most[p] = max(most[p], text[i])
            if first[i] is not None and (first[p] is None or first[i] < first[p]):
                first[p] = first[i]
        total = max(1, text[0])
        above_tags, above_tokens = [0] * n, [0] * n
        groups = [_TAG_OF.get(t, -1) for t in self.tags]
        out = np.zeros((n, N_FEATURES), np.float32)
        rows = []
        for i in range(n):
            p = max(self.parents[i], 0)
            if i:
                above_tags[i] = above_tags[p] | (1 << groups[p] if groups[p] >= 0 else 0)
                above_tokens[i] = above_tokens[p] | self.tokens[p]
            size, beside = text[i], max(1, children[p] if i else 1)
            rows.append(
                (
                    math.log1p(size),
                    math.log1p(own[i]),
                    links[i] / max(1, size),
                    size / subtree[i],
                    size / total,
                    stops[i] / max(1, size),
                    counts[i] / max(1, subtree[i]),
                    self.depths[i],
                    math.log1p(children[i]),
                    math.log1p(subtree[i]),
                    order[i] / beside,
                    math.log1p(beside),
                    size / max(1, text[p]),
                    (text[p] - size) / beside,
                    size / max(1, most[p]),
                    links[p] / max(1, text[p]),
                    text[p] / total,
                    (first[i] if first[i] is not None else total) / total,
                    own[i] / max(1, size),
                    most[i] / max(1, size),
                )
            )
        if n:
            out[:, :20] = rows
        at = 20
        for bits, width in (
            ([1 << g if g >= 0 else 0 for g in groups], len(TAG_GROUPS)),
            (above_tags, len(TAG_GROUPS)),
            (self.tokens, len(TOKEN_GROUPS)),
            (above_tokens, len(TOKEN_GROUPS)),
        ):
            out[:, at : at + width] = (np.array(bits, np.int64)[:, None] >> np.arange(width)) & 1
            at += width
        return out

    def decode(self, margin: np.ndarray) -> list[bool]:
        """The likeliest choice of kept elements in which nothing is kept
        below a dropped one: sums of log probabilities from the leaves up,
        choices from the root down."""
        keep = (-np.logaddexp(0, -margin)).tolist()
        drop = (-np.logaddexp(0, margin)).tolist()
        for i in range(len(keep) - 1, 0, -1):  # children come after their parent
            p = self.parents[i]
            keep[p] += max(keep[i], drop[i])
            drop[p] += drop[i]
        kept = [keep[0] >= drop[0]]
        for i in range(1, len(keep)):
            kept.append(kept[self.parents[i]] and keep[i] >= drop[i])
        return kept

    def text_of(self, kept: list[bool]) -> str:
        """The kept elements' text: white space inside a block is one blank,
        blocks are parted by a line end."""
        blocks: dict[int, list[str]] = {}
        for i, block, text in self.texts:
            if kept[i]:
                blocks.setdefault(block, []).append(text)
        found = (_SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
        return "\n".join(t for t in found if t)
