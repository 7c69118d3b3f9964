"""Main text of web pages by composite text density.

A page becomes a tree of elements. Of every element the characters and tags below it are counted, those in links apart.
Its density is characters per tag, adjusted by the share of links in it and on the whole page: menus come near zero,
paragraphs are dense. The densities of an element's children (its own text counts as one) are summed; the
block with the greatest sum is the body of the text. The least density on the path from it up to the page's body is the threshold
from which other blocks belong to the text too, if they have paragraphs or stand by the main heading with it. Where the densest block lies in an `article` or `main` element, that element is the text.

What a page says of itself comes before densities: menus, page headers, footers, sidebars, forms, scripts, styles, and
elements whose class, id or role names an advert, a notice or reader comments are never part of the text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import table

# Element names of the HTML standard by how they are read, and words by which pages name what is not their text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br button cite code data del dfn em embed font i img input ins kbd label map mark meter nobr object output"
    " progress q ruby rt rp s samp select small span strike strong sub sup svg math textarea time tt u var wbr area link meta".split())
HIDDEN = frozenset("button canvas datalist dialog iframe menu noembed noframes noscript object option rp script select style svg template textarea title xmp".split())
SILENT = INLINE | RAW | {"datalist", "noscript", "template"}  # neither begins nor ends a block of text
APART = frozenset("aside footer form header nav".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hgroup hr li main menu nav ol p pre search section summary table ul".split())
#: An opening tag closes an open one of these, unless one of the second kind was opened in between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
SCOPES = frozenset("article aside footer form header main nav section table td th".split())
NOT_TEXT = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promoted banner sidebar sidenav menu nav navbar"
    " navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices notification disclaimer alert popup modal"
    " overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments commentlist"
    " disqus respond reply replies discussion widget toolbar pagination pager copyright search complementary contentinfo dialog menubar form".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)(?:((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|([^>]*+)(?:>|\Z))", re.S)
_NAMED = re.compile(r"""\b(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_ROWS = 64


class Tree:
    """Elements of a page in document order, and its text as (element, words, or None where a block begins or ends)."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.stop, self.marks = ["body"], [0], [0], [""]
        self.flow: list[tuple[int, str | None]] = []
        self.opened: Counter[str] = Counter()
        self._read(html)

    def _read(self, html: str) -> None:
        stack, at, end = [0], 0, len(html)
        while at < end:
            found = _TOKEN.search(html, at)
            text = html[at : found.start() if found else end]
            if text:
                self.flow.append((stack[-1], unescape(text)))
            if not found:
                break
            at = found.end()
            if found[1]:
                self._close(stack, found[1].lower())
            elif found[2]:
                name, attributes = found[2].lower(), found[3] if found[3] is not None else found[4]
                self._open(stack, name, attributes)
                if name in RAW:  # what is inside is no markup
                    closing = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                    at = closing.end() if closing else end
                    self._leave(stack)
        while stack:
            self._leave(stack)

    def _open(self, stack: list[int], name: str, attributes: str) -> None:
        if name in ("html", "body", "head"):
            return
        if name in ENDS_PARAGRAPH:
            self._leave_open(stack, {"p"}, SCOPES)
        if name in CLOSES:
            self._leave_open(stack, *CLOSES[name])
        node = len(self.tag)
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.stop.append(node + 1)
        self.marks.append(attributes)
        if name not in SILENT:
            self.flow.append((node, None))
        elif name == "br":
            self.flow.append((node, "\n"))
        if name not in VOID:
            stack.append(node)
            self.opened[name] += 1

    def _leave(self, stack: list[int]) -> None:
        node = stack.pop()
        self.stop[node] = len(self.tag)
        self.opened[self.tag[node]] -= 1
        if self.tag[node] not in SILENT:
            self.flow.append((node, None))

    def _leave_open(self, stack: list[int], names: set[str], walls: frozenset[str] | set[str]) -> None:
        """Close the outermost open element of `names` above the nearest of `walls`, and all in it."""
        depth = None
        if not any(self.opened[name] > 0 for name in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if self.tag[stack[i]] in names:
                depth = i
            elif self.tag[stack[i]] in walls:
                break
        while depth is not None and len(stack) > depth:
            self._leave(stack)

    def _close(self, stack: list[int], name: str) -> None:
        if self.opened[name] <= 0:
            return
        for i in range(len(stack) - 1, 0, -1):
            if self.tag[stack[i]] == name:
                while len(stack) > i:
                    self._leave(stack)
                return
            if name in INLINE and self.tag[stack[i]] not in INLINE or self.tag[stack[i]] in SCOPES and name not in SCOPES:
                return  # a stray end tag closes nothing beyond the block it stands in


def _named(marks: str) -> tuple[set[str], bool]:
    """Words of class, id, role and itemprop; and whether the element is hidden."""
    words, hidden = set(), False
    for m in _NAMED.finditer(marks):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden":
            hidden = True
        elif key == "aria-hidden":
            hidden |= value.strip().lower() == "true"
        elif key == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        else:
            words.update(_WORDS.findall(_CAMEL.sub(" ", value).lower()))
    return words, hidden


def not_text(tree: Tree) -> np.ndarray:
    """Marks every element in what the page itself says is no text. Nothing that holds an `article` or `main` is marked; nor
    is, for its name alone, what holds the main heading."""
    n = len(tree.tag)
    kept, heading, inside, out = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64), np.zeros(n, bool), np.zeros(n, bool)
    for i, tag in enumerate(tree.tag):
        kept[i + 1] = kept[i] + (tag in ("article", "main"))
        heading[i + 1] = heading[i] + (tag == "h1")
    for i in range(1, n):
        tag, stop = tree.tag[i], tree.stop[i]
        inside[i] = inside[tree.parent[i]] or tag in ("article", "main")
        holds = kept[stop] > kept[i + 1]
        words, hidden = _named(tree.marks[i]) if tree.marks[i] else ((), False)
        if tag in HIDDEN or hidden:
            drop = True
        elif tag == "header":
            drop = not inside[i] and not holds
        elif tag in APART:
            drop = not holds and not (tag == "form" and heading[stop] > heading[i])
        else:
            drop = not NOT_TEXT.isdisjoint(words) and not holds and tag != "main" and heading[stop] == heading[i]
        out[i] = drop or out[tree.parent[i]]
    return out


def densities(tree: Tree, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Density of every element, and the sum of the densities of its children, own text as one of them. Elements `gone` add to no sum."""
    n = len(tree.tag)
    own, linked, tags, links = (np.zeros(n) for _ in range(4))
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[tree.parent[i]] or tree.tag[i] == "a"
        links[i] = tree.tag[i] == "a"
    seen = [t not in HIDDEN for t in tree.tag]
    for i in range(1, n):
        seen[i] &= seen[tree.parent[i]]
    for node, text in tree.flow:
        if text and seen[node]:
            own[node] += len(" ".join(text.split()))
            if in_link[node]:
                linked[node] += len(" ".join(text.split()))
    chars = own.copy()
    alone = (own, linked.copy())
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        chars[up] += chars[i]
        linked[up] += linked[i]
        tags[up] += tags[i] + 1
        links[up] += links[i]
    whole = linked[0] / max(chars[0], 1)

    def density(c: np.ndarray, t: np.ndarray, lc: np.ndarray, lt: np.ndarray) -> np.ndarray:
        base = np.log(np.log(c / np.maximum(c - lc, 1) * lc + whole * c + np.e))
        share = c / np.maximum(lc, 1) * np.maximum(t, 1) / np.maximum(lt, 1)
        # A page without links has base 1, whose logarithm is 0: then only characters per tag count.
        return c / np.maximum(t, 1) * np.where(base > 1e-9, np.log(np.maximum(share, 1)) / np.maximum(base, 1e-9), 1)

    of = density(chars, tags, linked, links)
    total = density(alone[0], np.ones(n), alone[1], (alone[1] > 0).astype(float))
    total[gone] = 0
    for i in range(1, n):
        if not gone[i]:
            total[tree.parent[i]] += of[i]
    return of, total


def _densest(tree: Tree, total: np.ndarray, first: int, stop: int) -> int:
    """The block from `first` to `stop` with the greatest sum; the inner one where an outer has no more."""
    best = first
    for i in range(first + 1, stop):
        if tree.tag[i] not in INLINE and (total[i] > total[best] or total[i] == total[best] and i < tree.stop[best]):
            best = i
    return best


def chosen(tree: Tree) -> np.ndarray:
    """Marks the elements whose text is the text of the page."""
    n = len(tree.tag)
    gone = not_text(tree)
    of, total = densities(tree, gone)
    total[gone] = -1
    keep = np.zeros(n, bool)
    best = _densest(tree, total, 0, n)
    path = [best]
    while path[-1]:
        path.append(tree.parent[path[-1]])
    named = _named_as_text(tree, gone, path)
    for i in named:
        keep[i : tree.stop[i]] = True
    if named:
        return keep & ~gone
    keep[best : tree.stop[best]] = True
    keep[path] = True  # text that stands between the blocks, not in one
    threshold, above = min(of[i] for i in path), set(path)
    heads, paragraphs = (np.concatenate([[0], np.cumsum([t == name and not g for t, g in zip(tree.tag, gone, strict=True)])]) for name in ("h1", "p"))
    near = next((i for i in path if heads[tree.stop[i]] > heads[i]), 0)
    i = 1
    while i < n:
        if i == best:
            i = tree.stop[i]
        elif i not in above and not gone[i] and tree.tag[i] not in INLINE and of[i] >= threshold and (
                near < i < tree.stop[near] or paragraphs[tree.stop[i]] > paragraphs[i]):
            found = _densest(tree, total, i, tree.stop[i])
            keep[found : tree.stop[found]] = True
            i = tree.stop[i]
        else:
            if tree.parent[i] in above and tree.tag[i] in INLINE:
                keep[i : tree.stop[i]] = True
            i += 1
    return keep & ~gone


def _named_as_text(tree: Tree, gone: np.ndarray, path: list[int]) -> list[int]:
    """The `article` that the densest block lies in, or else the `main`; or those inside of it, if they hold most of its text."""
    for name in ("article", "main"):
        around = [i for i in path if tree.tag[i] == name]
        if around:
            return around[-1:]
    best, stop = path[0], tree.stop[path[0]]
    held = np.zeros(len(tree.tag))
    for node, text in tree.flow:
        if text and not gone[node]:
            held[node] += len(text)
    for name in ("article", "main"):
        inside, i = [], best
        while i < stop:
            if tree.tag[i] == name and not gone[i]:
                inside.append(i)
                i = tree.stop[i]
            else:
                i += 1
        if inside and 2 * sum(held[i : tree.stop[i]].sum() for i in inside) >= held[best:stop].sum():
            return inside
    return []


def main_text(html: str | None) -> str:
    """The text of a page: character references decoded, white space made one space, blocks joined by two line feeds."""
    if not html or not html.strip():
        return ""
    tree = Tree(html)
    keep = chosen(tree)
    blocks, open_block = [], []
    for node, text in [*tree.flow, (0, None)]:
        if text is None:
            block = " ".join("".join(open_block).split())
            if block:
                blocks.append(block)
            open_block = []
        elif keep[node]:
            open_block.append(text)
    return "\n\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) to (page_id, url, text): one row per row, in no order; only these columns are read.

    Null, empty and blank pages have the empty text, as have pages that hold nothing but menus, scripts and the like. Ids and
    urls may be null or repeated. A page is worked on by itself and whole, in time and memory in proportion to its length.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part = batch.slice(at, _ROWS)
                texts = pa.array([main_text(t.as_py()) for t in part.column(2)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], ["page_id", "url", "text"])

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(scan, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def html_query(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
