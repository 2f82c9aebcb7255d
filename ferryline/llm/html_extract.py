"""Main-text extraction from web pages.

Every element of a page's DOM is scored by gradient-boosted trees over its
subtree's density, attribute tokens, depth and siblings; a decoding over the
tree then chooses the likeliest set of elements in which nothing is kept
below something dropped. The trees are trained on pages that are made by
rule, with every region's label known, from a fixed seed.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.boosting import Trees, fit
from ferryline.llm.common import quoted
from ferryline.llm.html_dom import Dom

#: Pages made to train on, and their seed.
TRAINING_PAGES, SEED = 700, 11
_LABEL = "data-label"


class PageMaker:
    """Pages with ``data-label`` on every region: ``keep`` or ``drop``."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice("aeiou") + self.r.choice("bcdfglmnprst") for _ in range(self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 1, high: int = 18) -> str:
        text = self.words(low, high)
        if self.r.random() < 0.3:
            text = text.replace(" ", ", ", 1)
        if self.r.random() < 0.05:
            text += " &amp; " + self.word()
        return text.capitalize() + "."

    def prose(self, sentences: int) -> str:
        text = " ".join(self.sentence() for _ in range(sentences))
        if self.r.random() < 0.15:  # junk marks, or all capitals
            text = " ".join(w + self.r.choice(["$$$", "###", "%%%", "***", "!!"]) for w in text.split())
        return text.upper() if self.r.random() < 0.05 else text

    def links(self, n: int) -> str:
        items = (f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(n))
        how = self.r.random()
        if how < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return (" | " if how < 0.8 else " ").join(items)

    def region(self, tags, names, inside: str, label: str, bare: float = 0.15) -> str:
        tag, name = self.r.choice(tags), self.r.choice(names)
        where = self.r.choice(["class", "class", "id"])
        attrs = f' {where}="{name}"' if tag == "div" and self.r.random() > bare or self.r.random() < 0.4 else ""
        return f'<{tag}{attrs} {_LABEL}="{label}">{inside}</{tag}>'

    def nav(self) -> str:
        names = ["nav", "menu", "main-menu", "navbar", "breadcrumbs"]
        return self.region(["nav", "nav", "div", "ul"], names, self.links(self.r.randint(3, 12)), "drop")

    def header(self) -> str:
        plain = f'<a href="/">{self.words(1, 2)}</a>'
        inside = self.r.choice([f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.sentence(2, 6)}</p>", plain])
        inside += self.nav() if self.r.random() < 0.5 else ""
        return self.region(["header", "header", "div"], ["header", "site-header", "masthead", "top"], inside, "drop")

    def advert(self) -> str:
        text = self.sentence(3, 14)
        text = text if self.r.random() < 0.6 else f'<a href="/{self.word()}">{text}</a>'
        text = f"<p>{text}</p>" if self.r.random() < 0.3 else text
        names = ["ad", "ads", "advert", "banner", "sponsored", "promo-box"]
        return self.region(["div", "div", "aside"], names, text, "drop", 0)

    def notice(self) -> str:
        text = f"<p>{self.prose(self.r.randint(1, 3))}</p><button>{self.word()}</button>"
        names = ["cookie-notice", "notice", "consent", "alert", "popup"]
        return self.region(["div", "div", "dialog"], names, text, "drop", 0)

    def form(self) -> str:
        inside = "".join(f"<label>{self.words(1, 3)}</label><input name=x>" for _ in range(self.r.randint(1, 4)))
        inside = f"<p>{self.sentence(3, 10)}</p>" * self.r.randint(0, 1) + inside + f"<button>{self.word()}</button>"
        return f'<form {_LABEL}="drop">{inside}</form>'

    def sidebar(self) -> str:
        widgets = "".join(
            f'<div class="widget"><h3>{self.words(1, 3)}</h3>'
            + (
                self.links(self.r.randint(3, 8))
                if self.r.random() < 0.7
                else f"<p>{self.prose(self.r.randint(1, 3))}</p>"
            )
            + "</div>"
            for _ in range(self.r.randint(1, 4))
        )
        names = ["sidebar", "side", "related", "widgets", "trending"]
        return self.region(["aside", "aside", "div"], names, widgets, "drop", 0.05)

    def comments(self) -> str:
        each = self.r.choice(["div", "li", "article"])
        items = "".join(
            f'<{each} class="comment"><b>{self.word()}</b><p>{self.prose(self.r.randint(1, 5))}</p></{each}>'
            for _ in range(self.r.randint(1, 8))
        )
        head = f"<h3>{self.words(1, 2)}</h3>" if self.r.random() < 0.7 else ""
        names = ["comments", "comment-list", "replies", "discussion"]
        return self.region(["div", "section", "div"], names, head + items, "drop", 0)

    def share(self) -> str:
        names = ["share", "social", "share-tools"]
        return self.region(["div", "ul"], names, self.links(self.r.randint(2, 5)), "drop", 0)

    def footer(self) -> str:
        inside = f"&copy; {self.words(1, 3)} &middot; {self.prose(self.r.randint(1, 2))}"
        inside = f"<p>{inside}</p>" if self.r.random() < 0.4 else inside
        inside += self.links(self.r.randint(2, 6)) if self.r.random() < 0.3 else ""
        names = ["footer", "site-footer", "bottom", "copyright"]
        return self.region(["footer", "footer", "footer", "div"], names, inside, "drop", 0.05)

    def inline(self, text: str) -> str:
        how, words = self.r.random(), text.split(" ")
        if how < 0.6 or len(words) < 4:
            return text
        tag = self.r.choice(["b", "i", "em", "strong", "span", "a href='/x'", "code"])
        k = self.r.randrange(len(words) - 2)
        words[k] = f"<{tag}>{words[k]}"
        words[k + 1] += f"</{tag.split()[0]}>"
        return " ".join(words)

    def article(self) -> str:
        parts = [f"<h1>{self.sentence(1, 12)}</h1>"] if self.r.random() < 0.8 else []
        size = self.r.choice([1, 1, 2, 3, 5, 8, 12, 20, 40])
        for _ in range(size):
            text = self.inline(self.prose(self.r.choice([1, 1, 1, 2, 3, 6, 12])))
            how = self.r.random()
            if how < 0.55:
                parts.append(f"<p>{text}</p>")
            elif how < 0.65:
                parts.append(f"<p>{text}")
            elif how < 0.75:
                parts.append(f"<p><b>{text}<br>")
            elif how < 0.8:
                level = self.r.randint(2, 4)
                parts.append(f"<h{level}>{self.words(1, 6)}</h{level}>")
            elif how < 0.85:
                items = (f"<li>{self.inline(self.sentence())}</li>" for _ in range(self.r.randint(2, 6)))
                parts.append("<ul>" + "".join(items) + "</ul>")
            elif how < 0.89:
                parts.append(f"<blockquote><p>{text}</p></blockquote>")
            elif how < 0.92:
                row = f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr>"
                parts.append(f"<table>{row * self.r.randint(1, 4)}</table>")
            elif how < 0.95:
                parts.append(f"<div>{text}</div>")
            else:
                parts.append(self.r.choice([self.advert, self.share, self.form])())
                parts.append(f"<p>{text}</p>")
        inside = "".join(parts)
        if self.r.random() < 0.2:
            inside = f'<div class="{self.r.choice(["text", "entry-content", "article-body", "inner"])}">{inside}</div>'
        if self.r.random() < 0.1:
            inside += self.comments()
        names = ["content", "post", "article", "entry", "story", "main-content"]
        return self.region(["article", "article", "article", "main", "div", "section"], names, inside, "keep", 0.3)

    def page(self) -> str:
        some = lambda share, make: [make()] if self.r.random() < share else []
        before = some(0.5, self.header) + some(0.75, self.nav) + some(0.55, self.advert) + some(0.2, self.notice)
        after = some(0.25, self.share) + some(0.3, self.sidebar) + some(0.3, self.comments) + some(0.25, self.form)
        after += some(0.2, self.advert) + some(0.1, self.notice)
        if self.r.random() < 0.3:
            self.r.shuffle(before)
        self.r.shuffle(after)
        if self.r.random() < 0.15:
            before += some(1, self.sidebar)
        main = self.article() if self.r.random() < 0.97 else ""
        inside = main + "".join(after)
        for _ in range(self.r.choice([0, 0, 1, 2])):
            inside = f'<div class="{self.r.choice(["wrapper", "container", "row", "col-8", "layout"])}">{inside}</div>'
        body = "".join(before) + inside + "".join(some(0.85, self.footer))
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 5)}</title></head><body>{body}</body></html>"


def labelled(html: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a made page's elements: an element is to be
    kept if its subtree shows any text that is."""
    dom = Dom(html, _LABEL)
    keep = np.zeros(len(dom.tags))
    for i, _, text in dom.texts:
        if text.strip() and dom.labels[i] == "keep":
            keep[i] = 1
    for i in range(len(keep) - 1, 0, -1):
        keep[dom.parents[i]] = max(keep[dom.parents[i]], keep[i])
    return dom.features(), keep


@lru_cache(maxsize=2)
def trained(pages: int = TRAINING_PAGES, seed: int = SEED) -> Trees:
    """The classifier, fitted on ``pages`` made pages (a documented bound;
    the pages extracted from are not learned from)."""
    maker = PageMaker(seed)
    rows = [labelled(maker.page()) for _ in range(pages)]
    x, y = (np.concatenate(part) for part in zip(*rows, strict=True))
    weight = np.concatenate([np.full(len(own), 1 / np.sqrt(len(own))) for _, own in rows])
    return fit(x.astype(np.float64), y, weight / weight.mean())


def main_text(html: str, trees: Trees) -> str:
    dom = Dom(html)
    return dom.text_of(dom.decode(trees.margin(dom.features())))


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    trees: Trees | None = None,
) -> DataFrame:
    """``page_id, url, text`` of every row: the main text, blocks in page
    order, one a line.

    NULL and empty html, and a page of which nothing is kept, give an empty
    text. Broken markup is closed as browsers do; pages of any length are
    parsed whole. NULL identifiers and urls and repeated rows stay as they
    are; an empty table gives no rows; other columns are not read.
    """
    trees = trees or trained()
    # plain arrays: executors need not know the class
    sent = pages.sparkSession.sparkContext.broadcast((trees.base, trees.features, trees.thresholds, trees.leaves))
    rows = pages.select(
        quoted(id_col).cast("long").alias("page_id"),
        quoted(url_col).cast("string").alias("url"),
        F.coalesce(quoted(html_col).cast("string"), F.lit("")).alias("html"),
    )

    def texts(batches):
        trees = Trees(*sent.value)
        for batch in batches:
            found, held = [], []

            def settle(held=held, found=found):
                # one pass of the trees over the elements of many pages
                features = [dom.features() for dom in held]
                margins = np.split(trees.margin(np.concatenate(features)), np.cumsum([len(f) for f in features])[:-1])
                found.extend(dom.text_of(dom.decode(m)) for dom, m in zip(held, margins, strict=True))
                held.clear()

            size = 0
            for html in batch.column("html"):
                held.append(Dom(html.as_py()))
                size += len(held[-1].tags)
                if size > 20_000:
                    settle()
                    size = 0
            if held:
                settle()
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())], ["page_id", "url", "text"]
            )

    return rows.mapInArrow(texts, "page_id long, url string, text string")


def digest(out: DataFrame) -> DataFrame:
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
