"""Main text of web pages: flat blocks classified by a decision tree (operator 5).

A page is cut into flat text blocks at block-level tags. Features of a block are its
words and link density, those of the block before and of the block after, whether
the innermost enclosing element that says anything is one for text (article, main) or
for what stands around it (nav, aside, footer, ...), and the same of class, id and
role, read as whole words and as a hint only. A CART tree, trained here on the blocks
of PAGES pages that are drawn from the labelled layouts below, decides which blocks
are main text. Nothing inside script, style, title, forms' fields or comments becomes
a block. A script, style, textarea or title without end tag reaches to the end of the
page; of other elements left out, without end tag only the tag goes, as it does for
`<svg/>` and `<math/>`. The scanner looks at every character a bounded number of times.

Defined results: a null or empty page, and one without main text, give an empty
text; unclosed and stray tags are read as browsers mostly do (an end tag closes
what is open inside its element, a stray one nothing; a tag that the page ends in is
dropped); pages are read whole; repeated rows are extracted row by row; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

#: Elements that are left out whole; the raw ones reach to the end of the page where they are not closed.
_RAW = set("script style textarea title".split())
_SKIP = _RAW | set("noscript template svg math iframe object select button canvas audio video map".split())
_ENDS = {x: re.compile(rf"</{x}\s*>", re.I) for x in _SKIP}
_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile(r">|=[ \t-\r]*[\"']")
_MARK = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_TRACKED = set("address article aside blockquote body center details dialog div dl fieldset figure footer form header html li main menu nav ol section table tbody td th tr ul".split())
_AROUND = set("nav footer aside form menu dialog fieldset".split())
#: Hints: whole words of class, id and role.
_HINT_AROUND = set(
    "ad ads advert advertisement sponsored promo banner menu nav navbar navigation breadcrumb breadcrumbs sidebar footer header masthead cookie cookies cookie-notice consent notice alert popup modal newsletter subscribe share sharing related comment comments reply replies respond pagination toolbar copyright search widget complementary contentinfo".split()
)
_HINT_MAIN = set("article main content entry post story article-body post-content entry-content articlebody".split())


class _Scanner:
    """Tokens of a page from left to right: (text, None, False, None) or (None, name, is an end tag, attributes)."""

    def __init__(self, page: str) -> None:
        self.page, self.at = page, 0
        self.without: set[str] = set()  # quotes that do not occur in the rest of the page

    def __iter__(self) -> Iterator[tuple[str | None, str | None, bool, str | None]]:
        page, n = self.page, len(self.page)
        while self.at < n:
            i = self.at
            if page[i] != "<":
                j = page.find("<", i)
                self.at = n if j < 0 else j
                yield page[i : self.at], None, False, None
            elif page.startswith("<!--", i):
                j = page.find("-->", i + 4)
                self.at = n if j < 0 else j + 3
            elif m := _NAME.match(page, i + 1):
                j = self._end(m.end())
                self.at = n if j < 0 else j + 1
                if j >= 0:
                    yield None, m[2].lower(), bool(m[1]), page[m.end() : j]
            elif page.startswith(("<!", "<?", "</"), i):
                j = page.find(">", i)
                self.at = n if j < 0 else j + 1
            else:
                self.at = i + 1
                yield "<", None, False, None

    def _end(self, i: int) -> int:
        """The place of the tag's >, which a quoted value may hold too; -1 if the page ends first."""
        while m := _STOP.search(self.page, i):
            if m[0] == ">":
                return m.start()
            quote, i = m[0][-1], m.end()
            if quote not in self.without:
                j = self.page.find(quote, i)
                if j < 0:
                    self.without.add(quote)
                else:
                    i = j + 1
        return -1


#: text, words, words in links, element around (1 what stands around text, 2 text), hint of class, id or role (the same).
Block = tuple[str, int, int, int, int]


def blocks(page: str | None) -> list[Block]:
    """Every block with a word, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # name, element and hint that hold inside
    open_names: Counter[str] = Counter()
    kind = hint = in_link = 0
    parts: list[str] = []
    linked: list[str] = []

    def close() -> None:
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                out.append((" ".join(words), len(words), len(html.unescape("".join(linked)).split()), kind, hint))
            parts.clear()
            linked.clear()

    scanner = _Scanner(page or "")
    open_ended: set[str] = set()  # names with no end tag in the rest of the page
    for text, name, end, attributes in scanner:
        if text is not None:
            parts.append(text)
            if in_link:
                linked.append(text + " ")
            continue
        if name in _SKIP and not end:
            close()
            if name in ("svg", "math") and attributes.endswith("/"):
                continue
            last = None if name in open_ended else _ENDS[name].search(scanner.page, scanner.at)
            if last:
                scanner.at = last.end()
            elif name in _RAW:
                scanner.at = len(scanner.page)
            else:
                open_ended.add(name)
            continue
        if name == "a":
            in_link = 0 if end else 1
        if name in _INLINE:
            continue
        close()
        in_link = in_link if name in _VOID else 0
        if name not in _TRACKED:
            continue
        if not end:
            marks = {w for x in _MARK.findall(attributes) for w in re.split(r"[\s_]+", x.strip("\"'").lower())} if "=" in attributes else set()
            if name in ("article", "main"):
                kind = 2
            elif name in _AROUND or (name == "header" and kind != 2):
                kind = 1
            if marks & _HINT_AROUND and name not in ("body", "html"):
                hint = 1
            elif marks & _HINT_MAIN:
                hint = 2
            stack.append((name, kind, hint))
            open_names[name] += 1
        elif open_names[name]:
            while True:
                top = stack.pop()[0]
                open_names[top] -= 1
                if top == name:
                    break
            kind, hint = stack[-1][1:] if stack else (0, 0)
    close()
    return out


def features(found: list[Block]) -> np.ndarray:
    """A row a block: words and link density of it, of the one before and of the one after, element and hint for text, element and hint for what is around."""
    size = np.array([0, *[b[1] for b in found], 0], float)
    density = np.array([0, *[min(1.0, b[2] / b[1]) for b in found], 0])
    kind, hint = (np.array([b[k] for b in found]) for k in (3, 4))
    one = slice(1, -1), slice(0, -2), slice(2, None)
    return np.column_stack([*[x[k] for k in one for x in (size, density)], kind == 2, hint == 2, kind == 1, hint == 1]).astype(float)


#: Labelled layouts: opening tag, tag of each block, blocks, words of a block, share of words in links, label (1 main text).
_ABOVE = [
    ("nav", "li", (3, 8), (1, 3), 1.0, 0), ("div class=menu", "li", (3, 8), (1, 2), 1.0, 0), ("div", "li", (3, 9), (1, 3), 1.0, 0), ("ul", "li", (4, 9), (1, 3), 1.0, 0),
    ("header", "div", (1, 3), (1, 9), 0.4, 0), ("div class=header", "div", (1, 2), (1, 8), 0.5, 0), ("div class=ad", "p", (1, 2), (3, 14), 0.0, 0), ("div", "div", (1, 1), (2, 5), 0.5, 0),
    ("div class=cookie-notice", "p", (1, 2), (6, 30), 0.1, 0), ("div id=search", "div", (1, 2), (1, 3), 0.0, 0), ("form", "div", (2, 4), (1, 4), 0.0, 0),
]
_BELOW = [
    ("footer", "p", (1, 3), (3, 20), 0.2, 0), ("div class=footer", "p", (1, 3), (3, 16), 0.2, 0), ("div", "p", (1, 1), (2, 5), 0.5, 0), ("div", "li", (3, 8), (1, 4), 1.0, 0), ("aside", "p", (1, 4), (5, 60), 0.2, 0),
    ("aside", "li", (2, 6), (3, 9), 1.0, 0), ("div class=sidebar", "p", (1, 4), (4, 50), 0.1, 0), ("section class=comments", "p", (1, 5), (3, 70), 0.0, 0), ("div id=comments", "div", (1, 6), (2, 60), 0.0, 0),
    ("div class=related", "li", (2, 5), (4, 10), 1.0, 0), ("form", "div", (2, 4), (1, 4), 0.0, 0), ("div class=newsletter", "p", (1, 2), (4, 20), 0.0, 0), ("div class='social-share'", "li", (2, 4), (1, 2), 1.0, 0),
]
_MAIN = [
    ("article", "p", (1, 12), (1, 120), 0.05, 1), ("article", "p", (2, 9), (6, 60), 0.0, 1), ("article", "li", (1, 6), (1, 12), 0.1, 1), ("main", "p", (2, 9), (2, 90), 0.05, 1), ("div class=content", "p", (2, 9), (3, 90), 0.05, 1),
    ("div class='post'", "p", (1, 8), (4, 90), 0.1, 1), ("div", "p", (2, 10), (14, 110), 0.05, 1), ("div class='product-social-study'", "p", (2, 8), (14, 90), 0.05, 1), ("td", "p", (2, 8), (16, 100), 0.1, 1), ("section", "p", (3, 8), (12, 80), 0.0, 1),
]
#: What stands inside an article without being its text.
_INNER = [("div class=ad", "p", (1, 2), (3, 12), 0.0, 0), ("aside", "p", (1, 2), (4, 30), 0.3, 0), ("section class=comments", "p", (1, 4), (3, 60), 0.0, 0), ("div class=share", "li", (2, 4), (1, 2), 1.0, 0), ("nav", "li", (2, 4), (1, 3), 1.0, 0)]
#: Pages drawn from the layouts; they bound what the tree is trained on.
PAGES, DEPTH, LEAST = 160, 9, 4


def _segment(layout: tuple, rng: random.Random, inner: str = "") -> str:
    tag, each, (least, most), (few, many), link, label = layout
    out = []
    heading = label and rng.random() < 0.6
    for k in range(rng.randint(least, most) + bool(heading)):
        n = rng.randint(2, 10) if heading and not k else int(few * (many / few) ** rng.random())
        linked = n if link == 1.0 or (n < 6 and rng.random() < link / 4) else sum(rng.random() < link for _ in range(n))
        said = f"M{label}" if not linked else f"<a>M{label}</a>"
        words = [said, *["<a>w</a>" if i < linked else "w" for i in range(1, n)]]
        name = "h2" if heading and not k else each
        out.append(f"<{name}>{' '.join(words)}</{name}>")
    if inner:
        out.insert(rng.randint(1, len(out)), inner)
    return f"<{tag}>{''.join(out)}</{tag.split()[0]}>"


def labelled(pages: int = PAGES, seed: int = 5) -> np.ndarray:
    """Features and label of every block of pages drawn from the layouts."""
    rng, rows = random.Random(seed), []
    for _ in range(pages):
        main = _segment(rng.choice(_MAIN), rng, _segment(rng.choice(_INNER), rng) if rng.random() < 0.4 else "")
        found = blocks("".join([*[_segment(x, rng) for x in rng.sample(_ABOVE, rng.randint(0, 3))], main, *[_segment(x, rng) for x in rng.sample(_BELOW, rng.randint(0, 3))]]))
        rows.append(np.column_stack([features(found), [int("M1" in b[0]) for b in found]]))
    return np.concatenate(rows)


class Tree:
    """A CART tree on Gini impurity over up to 32 thresholds a feature; ties go to the feature that comes first, then to the lower threshold."""

    def __init__(self, table: np.ndarray, depth: int = DEPTH, least: int = LEAST) -> None:
        self.root = self._grow(table[:, :-1].astype(float), table[:, -1].astype(int), depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int):
        if not depth or len(y) < 2 * least or y.min() == y.max():
            return int(y.mean() >= 0.5)
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            values = values[np.unique(np.linspace(0, len(values) - 1, min(len(values), 33)).astype(int))]
            for cut in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= cut
                n, m = int(low.sum()), int((~low).sum())
                if min(n, m) < least:
                    continue
                p, q = y[low].mean(), y[~low].mean()
                gini = n * p * (1 - p) + m * q * (1 - q)
                if best is None or gini < best[0] - 1e-9:
                    best = gini, f, float(cut), low
        if best is None:
            return int(y.mean() >= 0.5)
        _, f, cut, low = best
        return f, cut, self._grow(x[low], y[low], depth - 1, least), self._grow(x[~low], y[~low], depth - 1, least)

    def predict(self, row: np.ndarray) -> int:
        node = self.root
        while not isinstance(node, int):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node


@cache
def trained() -> Tree:
    return Tree(labelled())


def main_text(page: str | None, tree: Tree | None = None) -> str:
    """The main blocks' texts, joined by one blank."""
    tree = tree or trained()
    found = blocks(page)
    return " ".join(b[0] for b, x in zip(found, features(found).tolist(), strict=True) if tree.predict(x)) if found else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page; no shuffle. The tree goes with the tasks."""
    tree = trained()

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), tree) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(body, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
