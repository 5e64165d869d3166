"""Main-text extraction: flat text blocks, each judged by a decision tree over itself and its neighbours.

A page is cut into blocks at block-level tags. A block's features are its words and link density, those of the block
before and after, whether it is a heading, and the kind of the regions that enclose it. A decision tree, trained on a
small table of labelled pages, says which blocks are main text. A third of those pages have no telling names
or semantic tags, so that there the tree has to go by words and links alone.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import only

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|noscript|template|iframe|textarea|select|title)\b(?:"[^"]*"|'[^']*'|[^>"'])*>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9:-]*)((?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_CLOSED = re.compile(r"""(?:^|[\s"'])/$""")
#: HTML's block-level elements, elements without content, and elements that never hold main text.
BLOCKS = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav aside footer form button dialog menu fieldset label".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FOREIGN = ("svg", "math")  # only there "/>" closes an element
#: Words in class, id and role names that speak against and for main text.
AGAINST = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promos promoted promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login signin search share sharing social related recommended recommendations suggestions sidebar side aside rail menu nav navbar navigation breadcrumb breadcrumbs toolbar topbar header masthead footer foot copyright legal disclaimer comment comments commentlist discussion disqus reply replies respond response responses widget widgets pagination pager paging hidden complementary contentinfo dialog skip donate cta outbrain taboola feedback reactions rating toc".split()
)
FOR = frozenset("article content post entry story main prose articlebody text body".split())
WALLS = ("td", "th", "table", "body")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: int
    region: int  # -1 enclosed by a side region, 1 by main content only, 0 neither


def _kind(tag: str, attributes: str, inside_main: bool) -> int:
    """-1, 0 or 1 for the element an opening tag opens."""
    kind = 0
    if tag in ASIDE or tag == "header" and not inside_main:
        kind = -1
    elif tag in ("article", "main"):
        kind = 1
    if attributes and ("=" in attributes or "hidden" in attributes.lower()):
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return -1
            if name in ("class", "id", "role", "itemprop"):
                parts = {p.lower() for p in _NAME.findall(value)}
                if parts & AGAINST and not (inside_main and parts & AGAINST <= {"header", "masthead"}) and tag != "body" and tag != "html":
                    return -1
                if parts & FOR and not kind and tag not in ("body", "html"):
                    kind = 1
    return kind


def blocks(page: str) -> list[Block]:
    """The flat blocks of a page that have text, in page order."""
    out: list[Block] = []
    text: list[str] = []
    linked: list[str] = []
    open_tags: list[tuple[str, int]] = []
    places: dict[str, list[int]] = {}  # where each tag is open
    walls: list[int] = []
    against = main = links = heading = foreign = 0
    in_head = False

    def close() -> None:
        if not text:
            return
        words = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if words:
            n = words.count(" ") + 1
            marked = min(n, len(html.unescape(" ".join(linked)).split()))
            out.append(Block(words, n, marked, int(heading > 0), -1 if against else 1 if main else 0))
        linked.clear()

    def say(piece: str) -> None:
        if piece and not in_head:
            text.append(piece)
            if links:
                linked.append(piece)

    def drop(k: int) -> None:
        nonlocal against, main, links, heading, foreign
        for tag, kind in open_tags[k:]:
            places[tag].pop()
            if tag in WALLS:
                walls.pop()
            against -= kind < 0
            main -= kind > 0
            links -= tag == "a"
            heading -= tag in HEADINGS
            foreign -= tag in FOREIGN
        del open_tags[k:]

    at = 0
    for m in _TAG.finditer(page):
        say(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            if m[1] and m[1].lower() not in ("script", "style", "noscript", "template", "title"):
                text.append(" ")
            continue
        if tag in BLOCKS:
            close()
        if tag == "head":
            in_head = not m[2]
            continue
        if m[2]:
            if places.get(tag) and (not walls or walls[-1] <= places[tag][-1] or tag in ("table", "tr", "body", "html")):
                drop(places[tag][-1])
            continue
        if tag == "body":
            in_head = False
        if tag in VOID or (foreign or tag in FOREIGN) and _CLOSED.search(m[4] or ""):
            continue
        if tag in ("p", "li", "dt", "dd", "td", "th", "tr", "option") or tag in HEADINGS:  # these close their like
            if open_tags and open_tags[-1][0] == tag:
                drop(len(open_tags) - 1)
        kind = _kind(tag, m[4] or "", main > 0)
        places.setdefault(tag, []).append(len(open_tags))
        if tag in WALLS:
            walls.append(len(open_tags))
        open_tags.append((tag, kind))
        against += kind < 0
        main += kind > 0
        links += tag == "a"
        heading += tag in HEADINGS
        foreign += tag in FOREIGN
    say(page[at:])
    close()
    return out


def rows(found: list[Block]) -> np.ndarray:
    """Features of each block: words, link density, the same of the block before and after, heading, region."""
    w = np.array([0, *[b.words for b in found], 0], float)
    d = np.array([0, *[b.linked / b.words for b in found], 0], float)
    own = [(b.heading, b.region) for b in found]
    return np.column_stack([w[1:-1], d[1:-1], w[:-2], d[:-2], w[2:], d[2:], np.array(own, float).reshape(-1, 2)])


class Tree:
    """A decision tree over numeric features, split by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 14, least: int = 3):
        self.root = self._grow(x, y, depth, least)

    def _grow(self, x, y, depth, least):
        if depth == 0 or len(y) < 2 * least or y.min() == y.max():
            return bool(2 * y.sum() >= len(y))
        best = None
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, t = x[order, f], np.cumsum(y[order])
            n = np.arange(1, len(y) + 1)
            left, right = t[:-1] / n[:-1], (t[-1] - t[:-1]) / (len(y) - n[:-1])
            cost = n[:-1] * left * (1 - left) + (len(y) - n[:-1]) * right * (1 - right)
            cost[(v[:-1] == v[1:]) | (n[:-1] < least) | (len(y) - n[:-1] < least)] = np.inf
            k = int(np.argmin(cost))
            if np.isfinite(cost[k]) and (best is None or cost[k] < best[0] - 1e-12):
                best = cost[k], f, (v[k] + v[k + 1]) / 2
        if best is None:
            return bool(2 * y.sum() >= len(y))
        low = x[:, best[1]] <= best[2]
        return best[1], best[2], self._grow(x[low], y[low], depth - 1, least), self._grow(x[~low], y[~low], depth - 1, least)

    def __call__(self, row) -> bool:
        node = self.root
        while not isinstance(node, bool):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node


_WORDS = "the river rose again in night and by morning lower fields were under water as far old mill where road bends nobody had seen ferry since noon post was late".split()


def labelled_pages(n: int = 1200, seed: int = 3) -> list[str]:
    """The labelled table: pages in which every block of main text begins with the mark §.

    Each page is drawn from a grammar of parts: menu, path, notice, heading, paragraphs of any length, lists, share bar,
    related links, comments, footer. Two of three pages name their parts by classes; the others are bare.
    """
    r = random.Random(seed)

    def say(least: int, most: int) -> str:
        words = [r.choice(_WORDS) for _ in range(r.randint(least, most))]
        return " ".join([words[0].capitalize(), *words[1:]]) + r.choice((".", ".", "", "!"))

    def links(least: int, most: int, tag: str = "li") -> str:
        return "".join(f"<{tag}><a href=/{k}>{say(1, 4)}</a></{tag}>" for k in range(r.randint(least, most)))

    def part(names: str, inner: str) -> str:
        return f"<{r.choice(names.split('|'))}>{inner}</div>" if named else f"<div>{inner}</div>"

    def paragraph() -> str:
        draw = r.random()
        text = say(1, 8) if draw < (0.4 if named else 0.15) else say(9, 30) if draw < 0.6 else say(31, 160)
        if r.random() < 0.2:
            text += f" <a href=/x>{say(1, 3)}</a>"
        return f"<p>§{text}</p>"

    def main() -> str:
        if named and r.random() < 0.25:  # a short note: its name alone tells it
            return "".join(f"<p>§{say(1, 12)}</p>" for _ in range(r.randint(1, 3)))
        out = [f"<h1>§{say(2, 14)}</h1>" if r.random() < 0.9 else f"<p>§{say(31, 160)}</p>"]
        for k in range(r.randint(1, 10)):
            draw = r.random()
            if draw < 0.08:
                out.append(f"<h2>§{say(2, 8)}</h2>")
            elif draw < 0.16:
                out.append("<ul>" + "".join(f"<li>§{say(3, 20)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif draw < 0.2 and k:
                out.append(f"<p>§{say(31, 120)}</p><p>§<a href=/y>{say(3, 12)}</a></p><p>§{say(31, 120)}</p>")
            elif draw < 0.25:
                out.append(f"<p>§{say(1 if named else 31, 120)}</p><ul>{links(3, 6)}</ul>")
            out.append(paragraph())
        return "".join(out) + f"<p>§{say(1 if named else 21, 120)}</p>"

    pages = []
    for k in range(n):
        named = k % 3 > 0
        some = lambda share, make: make() if r.random() < share else ""
        pages.append(
            "<body>"
            + some(0.3, lambda: part("div class=masthead|div id=site-header", f"<p>{say(1, 6)}</p>"))
            + some(0.7, lambda: part("div class=menu|div id=main-nav", f"<ul>{links(2, 9)}</ul>"))
            + some(0.2, lambda: f"<p><a href=/h>{say(1, 2)}</a> &gt; <a href=/g>{say(1, 2)}</a></p>")
            + some(0.6, lambda: part("div class=ad|div id=cookie-notice|div class=promo", say(2, 60 if named else 18)))
            + part("div class=content|div id=article-body", main())
            + some(0.3, lambda: part("div class=ad|div class=newsletter", f"<p>{say(2, 60)}</p>") if named else "")
            + some(0.3, lambda: part("div class=comments|div id=replies", f"<h3>{say(1, 3)}</h3>" + "".join(f"<p>{say(2, 80)}</p>" for _ in range(3))) if named else "")
            + some(0.4, lambda: part("div class=related|div class=sidebar", some(0.5, lambda: f"<h3>{say(1, 3)}</h3>") + f"<ul>{links(2, 7)}</ul>"))
            + some(0.75, lambda: part("div class=footer|div id=copyright", f"&copy; {say(2, 18)}" + some(0.3, lambda: f" <a href=/l>{say(1, 2)}</a>")))
            + "</body>"
        )
    return pages


@lru_cache(maxsize=1)
def trained() -> Tree:
    return Tree(*labelled_rows())


def labelled_rows(n: int = 1200, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels (1 main text) of the blocks of labelled_pages()."""
    x, y = [], []
    for page in labelled_pages(n, seed):
        found = blocks(page)
        x.append(rows(found))
        y += [b.text.startswith("§") for b in found]
    return np.vstack(x), np.array(y, float)


def main_text(page: str | None, tree: Tree | None = None) -> str:
    """The main blocks of a page, joined in page order by one space; empty for a null, empty or textless page."""
    found = blocks(page) if page else []
    if not found:
        return ""
    tree = tree or trained()
    return " ".join(b.text for b, row in zip(found, rows(found).tolist()) if tree(row))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row of pages (page_id, url, html); null ids and urls and repeated rows are kept.

    Other columns are ignored; an empty table gives an empty result. Whole pages are read, however long, and elements
    are tracked at any depth. A null or empty page, or one without main text, has the empty text.
    """

    tree = trained()  # once, on the driver

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([main_text(h.as_py(), tree) for h in b.column(2)], pa.string())], ["page_id", "url", "text"])

    return only(pages, page_id="long", url="string", html="string").mapInArrow(run, "page_id long, url string, text string")
