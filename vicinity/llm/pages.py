"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks of text at block-level tags. A block is described by
its words and link density, those of its two neighbours, the elements it stands in, and
what the names (class, id, role) around it hint at; a decision tree, trained on the small
labelled table of ``skeletons``, says which blocks belong to the article. Names are weak:
beside a hint that a part of the page is no article stands the share of the page's
unlinked words that this part holds, and some labelled pages have misleading names.

Scripts, styles, comments, head and hidden elements are no text. Character references
are decoded, white space inside a block becomes one space, blocks are joined by an
empty line. Null and empty pages give an empty text, broken markup is read as far as
it goes (a tag without end is text), rows with equal ids are read each for itself,
null ids and urls are kept, an empty table gives no rows. Only the three named
columns are read.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vicinity.llm.common import pieces

# Tags, comments and declarations, or the text up to the next; a quoted attribute may
# hold ">", and a "<" that opens nothing is text.
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>"""
    r"""|(?P<text><?[^<]++|<)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")

INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr img br".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = set("head script style noscript template svg math textarea select option button iframe object canvas audio video title".split())
RAW = set("script style textarea title iframe noscript".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

CONTENT_TAGS, AROUND_TAGS = {"article", "main"}, {"nav", "footer", "aside", "form", "dialog", "menu"}
CONTENT_WORDS = set("article content main post entry story prose".split())
AROUND_WORDS = set(
    "ad ads adv advert advertisement advertising banner promo promotion sponsor sponsored nav navbar navigation menu "
    "breadcrumb breadcrumbs footer sidebar aside widget related recommended share sharing social comment comments reply "
    "replies respond cookie cookies consent notice alert gdpr newsletter subscribe subscription popup modal overlay login "
    "signup form search pagination pager toolbar copyright legal skip masthead topbar".split()
)
PARTS = re.compile(r"[a-z]+")

# What a block's place is, from the innermost element that says so.
NEUTRAL, CONTENT, AROUND, HEADER, HIDDEN = range(5)
KINDS = {"p": 1, "li": 3, "dd": 3, "dt": 3, "td": 4, "th": 4, "blockquote": 5, "pre": 5} | dict.fromkeys(HEADINGS, 2)


@dataclass
class Block:
    words: list[str] = field(default_factory=list)
    linked: int = 0
    place: int = NEUTRAL
    around: bool = False
    within: bool = False
    kind: int = 0
    part: int = -1  # the outermost element whose names hint at no article
    hinted: bool = False  # an element's names hint at an article

    @property
    def text(self) -> str:
        return " ".join("".join(self.words).split())


def place_of(tag: str, attributes: str) -> tuple[int, int]:
    """What the element says of its place by its tag, and what its names hint at."""
    names: list[str] = []
    if attributes and ("class" in attributes or "id" in attributes or "hidden" in attributes or "style" in attributes or "role" in attributes):
        for name, a, b, c in ATTRIBUTE.findall(attributes.lower()):
            value = a or b or c
            if name in ("class", "id", "role"):
                names += PARTS.findall(html.unescape(value))
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                return HIDDEN, NEUTRAL
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return HIDDEN, NEUTRAL
    hint = NEUTRAL
    if tag != "body":
        around, content = AROUND_WORDS.intersection(names), CONTENT_WORDS.intersection(names)
        hint = AROUND if around else HEADER if "header" in names else CONTENT if content else NEUTRAL
    if tag in AROUND_TAGS:
        return AROUND, hint
    if tag in CONTENT_TAGS:
        return CONTENT, hint
    return HEADER if tag == "header" else NEUTRAL, hint


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page, in order."""
    done: list[Block] = []
    # open elements: name, place, whether it or one around it is AROUND, is CONTENT, and by
    # names: the part of the page that is hinted to be no article, whether an article is
    stack: list[tuple[str, int, bool, bool, int, bool]] = [("", NEUTRAL, False, False, -1, False)]
    kind, links, silent, parts = 0, 0, 0, 0
    now: Block | None = None
    at = 0
    while at < len(page):
        found = TOKEN.match(page, at)
        at = found.end()
        part = found["text"]
        if part is not None:
            if silent:
                continue
            part = html.unescape(part)
            if now is None:
                if not part.strip():
                    continue
                _, place, around, within, inside, hinted = stack[-1]
                now = Block([], 0, place, around, within, kind, inside, hinted)
            now.words.append(part)
            if links:
                now.linked += len(part.split())
            continue
        tag = found["tag"] or found["tag2"]
        if tag is None:
            continue
        tag, ends = tag.lower(), found["end"] or found["end2"]
        if tag in INLINE:
            if tag == "a":
                links = 0 if ends else 1
            elif tag == "br" and now is not None:
                now.words.append(" ")
            continue
        if now is not None:
            done.append(now)
            now = None
        kind = 0 if ends else KINDS.get(tag, 0)
        if tag in VOID:
            continue
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    silent -= sum(e[0] in NO_TEXT or e[1] == HIDDEN for e in stack[k:])
                    del stack[k:]
                    break
            links = 0
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            tail = page.find(">", at)
            at = tail + 1 if end and tail >= 0 else len(page)
            continue
        attributes = found["attrs"] if found["tag"] else found["attrs2"]
        if attributes.endswith("/") and tag not in ("p", "div"):
            continue
        if tag == "body":  # what opened in the head has ended
            silent -= sum(e[0] in NO_TEXT for e in stack)
            del stack[1:]
        if tag in ("p", "li") or tag in HEADINGS:  # these can't stand in a paragraph, nor in one another
            if stack[-1][0] in ("p", tag):
                silent -= stack[-1][1] == HIDDEN
                stack.pop()
        own, hint = place_of(tag, attributes)
        _, place, around, within, inside, hinted = stack[-1]
        silent += tag in NO_TEXT or own == HIDDEN
        place = NEUTRAL if place == HIDDEN else place
        if inside < 0 and hint in (AROUND, HEADER):
            inside, parts = parts, parts + 1
        stack.append((tag, own or place, around or own == AROUND, within or own == CONTENT, inside, hinted or hint == CONTENT))
    if now is not None:
        done.append(now)
    return [b for b in done if b.text]


def features(blocks: list[Block]) -> np.ndarray:
    """Words and link density of each block and its neighbours, the elements it stands in
    and its tag, the hints of names, the share of the page's unlinked words that its hinted
    part holds, and whether the page says anywhere else where its article is."""
    words = np.array([0, *(len("".join(b.words).split()) for b in blocks), 0], np.float64)
    linked = np.array([0, *(b.linked for b in blocks), 0], np.float64)
    density = linked / np.maximum(words, 1)
    own = np.array([(b.place, b.around, b.within, b.kind, b.hinted) for b in blocks], np.float64).reshape(len(blocks), 5)
    part = np.array([b.part for b in blocks], np.int64)
    # words in navigation, footers and the like are no rivals of an article
    plain = np.where([b.around for b in blocks], 0, (words - np.minimum(linked, words))[1:-1]) if len(blocks) else words[1:-1]
    held = np.bincount(part + 1, plain) if len(blocks) else np.zeros(1)
    share = np.where(part >= 0, held[part + 1] / max(1.0, plain.sum()), -1.0) if len(blocks) else words[1:-1]
    said = float(any(b.within and not b.around for b in blocks))
    hinted = float(any(b.hinted and b.part < 0 and not b.around for b in blocks))
    around = [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]]
    return np.column_stack([*around, own, share, np.full(len(blocks), said), np.full(len(blocks), hinted)])


# --- the labelled table -----------------------------------------------------------

# Blocks marked + are article, - are not. {n} stands for about n words, * repeats.
SKELETONS = (
    "<nav><ul><li><a>-{1}</a></li>*<li><a>-{2}</a></li></ul></nav><div class=ad>-{12}</div><article><h1>+{8}</h1><p>+{60}</p>*<p>+{1}</p><p>+{20}</p></article><footer>-{12}</footer>",
    "<header><h2>-{3}</h2><p>-{6}</p></header><main><h1>+{6}</h1><p>+{3}</p><p>+{45} <a>{2}</a> {20}</p>*</main><footer><p>-{15}</p><a>-{2}</a></footer>",
    "<div class='cookie notice'><p>-{25}</p></div><div id=content><h1>+{5}</h1><p>+{30}</p>*<ul><li>+{9}</li>*</ul><p>+{2}</p></div><div id=sidebar><h3>-{2}</h3><ul><li><a>-{4}</a></li>*</ul><p>-{20}</p></div>",
    "<div class=menu><a>-{1}</a></div><div><h1>+{7}</h1><p>+{50}</p>*<p>+{40} <a>{3}</a></p><p>+{25}</p></div><div><a>-{2}</a></div><div>-{4}</div>",
    "<article><header><h1>+{7}</h1></header><p>+{40}</p>*<blockquote>+{20}</blockquote><aside><p>-{30}</p></aside><p>+{15}</p><section class=comments><h2>-{2}</h2><p>-{25}</p>*<p>-{3}</p></section></article><form><p>-{6}</p></form>",
    "<body><div><a>-{2}</a></div><div><a>-{1}</a></div><h1>+{6}</h1><p>+{35}</p>*<p>+{40}</p><p>+{55}</p><div><a>-{3}</a></div><div><a>-{4}</a></div><div>-{5}</div></body>",
    "<div class=header><p>-{5}</p></div><nav><a>-{1}</a><a>{1}</a></nav><div class='post entry'><h2>+{5}</h2><p>+{70}</p><table><tr><td>+{2}</td></tr></table><pre>+{20}</pre><p>+{8}</p></div><div id=comments><p>-{40}</p>*</div>",
    "<main><article><h1>+{4}</h1><p>+{1}</p>*<p>+{90}</p><div class='related'><h3>-{3}</h3><a>-{6}</a></div><p>+{12}</p><div class=share><a>-{1}</a></div></article><aside><article><h2>-{4}</h2><p>-{20}</p></article></aside></main>",
    "<header><nav><a>-{1}</a></nav></header><section class=newsletter><p>-{18}</p></section><article><p>+{18}</p>*</article><section class=promo><h2>-{5}</h2><p>-{30}</p></section><footer><p>-{40}</p></footer>",
    "<article><h1>+{5}</h1><p>+{15} <a>{5}</a></p><p><a>+{3}</a></p><ul><li>+{3}</li><li>+{8}</li></ul><h2>+{2}</h2><p>+{4}</p><div>+{30}</div></article><footer><p>-{2}</p></footer>",
    "<header><h1>-{3}</h1><p>-{28}</p>*</header><div><h2>+{6}</h2><p>+{40}</p>*<p>+{30}</p></div><div><a>-{9}</a> {2}</div><div><a>-{14}</a></div><footer>-{30}</footer>",
    "<div class=header><p>-{35}</p></div><article><header><h1>+{6}</h1><p>+{25}</p></header><p>+{30}</p>*</article><div class=header>-{12}</div>",
    "<table><tr><td><a>-{2}</a></td><td><a>-{3}</a></td></tr></table><p>+{45}</p>*<p>+{30} <a>{4}</a></p><ul><li><a>-{12}</a></li>*</ul><p>-{3}</p>",
    "<article><p>+{1}</p></article>",
    "<article><p>+{2}</p>*</article>",
    "<nav><a>-{2}</a></nav><article><h1>+{3}</h1><p>+{25}</p>*<ul><li><a>+{3}</a></li>*</ul></article>",
    "<main>+{4}<p>+{50}</p><p><a>+{6}</a></p></main><div class=ad><p>-{40}</p></div>",
    "<p>-{3}</p>",
    "<div>-{4}</div><div>-{6}</div><p>-{2}</p>",
    "<p>+{50}</p><p>+{40}</p>*",
    "<div><p>-{4}</p></div><h2>+{5}</h2><p>+{60}</p>*<p>+{35}</p>",
    "<form><p>-{30}</p></form><div class=sidebar><p>-{8}</p>*</div><div>-{6}</div>",
    "<div class=menu><a>-{1}</a></div><div class=content><div class=legal><h1>+{5}</h1><p>+{50}</p>*<p>+{20}</p></div></div><div class=footer>-{8}</div>",
    "<div class=content><div class='legal notice'><p>+{70}</p>*</div></div><div class=ad>-{12}</div>",
    "<div class=menu><a>-{1}</a></div><div class='product-search results'><h1>+{5}</h1><p>+{45}</p>*</div><footer>-{8}</footer>",
    "<div class='search results'><p>+{60}</p>*<p>+{35}</p></div>",
    "<nav><a>-{2}</a></nav><div class=header><h1>+{6}</h1><p>+{60}</p>*</div><div class=share><a>-{1}</a>*</div><footer><p>-{20}</p></footer>",
    "<div class='main social form'><h1>+{6}</h1><p>+{55}</p>*<p>+{8}</p></div><div class=related><a>-{6}</a><p>-{10}</p></div>",
    "<article class='promo sponsored'><h1>+{6}</h1><p>+{40}</p>*</article><div class=comments><p>-{30}</p>*</div>",
    "<div class=nav><a>-{2}</a>*</div><div id=content><p>+{60}</p>*</div><div class=comments><p>-{45}</p>*</div>",
    "<div id=content><h1>+{4}</h1><p>+{30}</p></div><div class='related promo'><p>-{50}</p>*</div>",
    "<article><h1>+{5}</h1><p>+{12}</p></article><div class='widget legal'><p>-{60}</p>*</div>",
    "<main><p>+{30}</p>*<div class='notice'><p>-{15}</p></div><p>+{40}</p></main>",
    "<article><p>+{1}</p></article><div class=comments><p>-{10}</p></div>",
    "<article><p>+{3}</p>*</article><div class=sidebar><p>-{25}</p>*</div><div id=comments><p>-{12}</p></div>",
    "<div class=cookie><p>-{30}</p></div><div><h1>+{5}</h1><p>+{60}</p>*</div>",
    "<div class=banner><p>-{9}</p></div><article><div>+{20}</div><div>+{2}</div><h3>+{1}</h3><div>+{60}</div></article><div class='footer'><p>-{22}</p><p>-{3}</p></div>",
)


def skeletons(copies: int = 12, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The labelled table: features and label of each block, ``copies`` of each
    skeleton with other word counts."""
    rng, rows, labels = random.Random(seed), [], []
    for _ in range(copies):
        for skeleton in SKELETONS:
            page = re.sub(r"(<(\w+)[^<>]*>(?:(?!<\2).)*?</\2>)\*", lambda m: m[1] * rng.randrange(1, 5), skeleton)
            page = re.sub(r"\{(\d+)\}", lambda m: "w " * max(1, round(int(m[1]) * rng.uniform(0.5, 1.6))), page)
            blocks = blocks_of(page)
            labels += [b.text[0] == "+" for b in blocks]
            rows.append(features(blocks))
    return np.concatenate(rows), np.array(labels)


# --- the tree ---------------------------------------------------------------------


@dataclass
class Tree:
    """Node 0 is the root; a leaf has no feature (-1)."""

    feature: np.ndarray
    limit: np.ndarray
    below: np.ndarray
    above: np.ndarray
    share: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return self.share[at] >= 0.5
            value = rows[np.arange(len(rows)), np.maximum(feature, 0)]
            step = np.where(value <= self.limit[at], self.below[at], self.above[at])
            at = np.where(inner, step, at)


def train(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 4) -> Tree:
    """A binary tree by Gini impurity; leaves hold at least ``least`` rows."""
    nodes: list[list[float]] = []

    def grow(some: np.ndarray, left: int) -> int:
        at, y = len(nodes), labels[some]
        nodes.append([-1, 0.0, -1, -1, y.mean()])
        if left and 0 < y.sum() < len(y):
            best = min((split(some, f) for f in range(rows.shape[1])), key=lambda s: s[0])
            if best[0] < len(y) * impurity(y.mean()) - 1e-9:
                _, f, limit = best
                low = rows[some, f] <= limit
                nodes[at][:2] = [f, limit]
                nodes[at][2] = grow(some[low], left - 1)
                nodes[at][3] = grow(some[~low], left - 1)
        return at

    def impurity(p):
        return 2 * p * (1 - p)

    def split(some: np.ndarray, f: int) -> tuple[float, int, float]:
        order = some[np.argsort(rows[some, f], kind="stable")]
        x, y = rows[order, f], labels[order]
        n, ones = np.arange(1, len(x)), np.cumsum(y)[:-1]
        cost = n * impurity(ones / n) + (len(x) - n) * impurity((y.sum() - ones) / (len(x) - n))
        allowed = (x[1:] > x[:-1]) & (n >= least) & (len(x) - n >= least)
        if not allowed.any():
            return np.inf, f, 0.0
        i = int(np.argmin(np.where(allowed, cost, np.inf)))
        return float(cost[i]), f, float((x[i] + x[i + 1]) / 2)

    grow(np.arange(len(rows)), depth)
    feature, limit, below, above, share = map(np.array, zip(*nodes, strict=True))
    return Tree(feature.astype(int), limit, below.astype(int), above.astype(int), share)


def main_text(page: str | None, tree: Tree) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    return "\n\n".join(b.text for b, keep in zip(blocks, tree.predict(features(blocks)), strict=True) if keep)


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url, text of every page; the tree is a few arrays and goes with the task."""
    tree = tree or train(*skeletons())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            texts = [main_text(p, tree) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    out = StructType([*rows.schema.fields[:2], StructField("text", StringType())])
    return rows.mapInArrow(run, out)
