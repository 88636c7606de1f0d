"""Main text of web pages by gradient-boosted trees over DOM nodes.

Method: every element becomes a node with features: density of text, links, tags and punctuation in its subtree, tokens
of its attributes and of those above it, depth, and what its siblings are like. Gradient-boosted trees give each node a
margin for main text. They are fitted on nodes whose side is plain from the page's own landmarks (an article element, a
navigation, a footer), half of the time with the landmarks and attributes hidden, so that the trees also learn what
text looks like without them. Decoding is hierarchical: a node is all main text, all not, or mixed, in which case its
children decide for themselves; the best such labelling of the whole tree is taken, so that no node contradicts its
ancestors or descendants.

The fit takes at most SAMPLE_PAGES pages (those with the smallest hash of their row) and is the only bounded step.
Every page is then extracted where it lies, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.words import pieces

SAMPLE_PAGES = 400
#: Cost of a mixed node, so that labels change only where that says more.
MIXED = 0.25

# HTML's elements without an end, those whose text is never shown as text, and block-level ones.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("script style template noscript head title iframe select textarea button option".split())
# What may stand in a head; anything else ends one that was left open.
HEAD = set("head base link meta title style script noscript template".split())
BLOCKS = set(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS, LISTS = {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "li", "dl", "dt", "dd", "menu"}
#: An open element on the left ends where one on the right begins, unless a container lies between.
PARTS = {"thead", "tbody", "tfoot"}
ENDED_BY = {
    "p": BLOCKS, "a": {"a"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "rt": {"rt", "rp"}, "rp": {"rt", "rp"},
    "colgroup": {"colgroup", "tr", *PARTS}, "tr": {"tr", *PARTS}, "td": {"td", "th", "tr", *PARTS}, "th": {"td", "th", "tr", *PARTS},
    "thead": PARTS, "tbody": PARTS, "tfoot": PARTS,
}
BARRIERS = {"p": BLOCKS - {"p"}, "a": BLOCKS, "option": {"select", "datalist"}, "rt": {"ruby"}, "rp": {"ruby"}}
CONTAINERS = {"ul", "ol", "dl", "table"}
MAIN_TAGS, OTHER_TAGS = {"article", "main"}, {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
# Parts of class, id and role that say what an element is for.
MAIN_TOKENS = set("article content entry main post story body text".split())
OTHER_TOKENS = set("ad ads advert advertisement banner comment comments cookie consent footer header menu nav navbar navigation notice popup promo related share sidebar social sponsor subscribe newsletter widget breadcrumb login".split())
FEATURES = ("depth", "text", "links", "tags", "stops", "siblings", "same", "place", "paragraph", "heading", "list", "beside", "main_tag", "other_tag", "main_token", "other_token")
#: Features that are hidden in half of the training rows.
LANDMARKS = tuple(range(FEATURES.index("main_tag"), len(FEATURES)))


class Page(HTMLParser):
    """Nodes of a page in page order, by lists; node 0 is the page. `blocks` are the texts with the node they stand in."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.tokens, self.children = ["#page"], [-1], [frozenset()], [[]]
        self.open, self.hidden, self.blocks = [0], 0, []
        self.open_blocks = [0]
        self.buffer: list[str] = []
        self.open_tags: dict[str, int] = {}
        self.linked = [0]
        self.feed(html)
        self.close()
        self.end_block()

    def block_node(self) -> int:
        return self.open_blocks[-1]

    def end_block(self) -> None:
        text = " ".join("".join(self.buffer).split())
        self.buffer = []
        if text:
            self.blocks.append((self.block_node(), text))

    def pop(self) -> None:
        node = self.open.pop()
        tag = self.tag[node]
        self.open_tags[tag] -= 1
        self.hidden -= tag in HIDDEN
        if tag in BLOCKS:
            self.open_blocks.pop()

    def leave_head(self) -> None:
        """What can't stand in a head ends it, also without its end tag."""
        if self.open_tags.get("head") and self.tag[self.open[-1]] == "head":
            self.close_to("head")

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in HEAD:
            self.leave_head()
        if tag in BLOCKS:
            self.end_block()
        for name, enders in ENDED_BY.items():
            if tag in enders and self.open_tags.get(name):
                self.close_to(name, barrier=BARRIERS.get(name, CONTAINERS))
        if tag in VOID:
            if tag in ("br", "hr"):
                self.buffer.append(" ")
            return
        said = " ".join(str(v or "") for k, v in attrs if k in ("class", "id", "role", "itemprop"))
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.tokens.append(frozenset("".join(c if c.isalnum() else " " for c in said.lower()).split()))
        self.children.append([])
        self.linked.append(0)
        self.children[self.open[-1]].append(node)
        self.open.append(node)
        if tag in BLOCKS:
            self.open_blocks.append(node)
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1
        self.hidden += tag in HIDDEN

    def close_to(self, tag: str, barrier: set[str] = frozenset()) -> None:
        for place in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[place]]
            if name == tag:
                while len(self.open) > place:
                    self.pop()
                return
            if name in barrier:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_block()
        if self.open_tags.get(tag):
            self.close_to(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        if self.hidden and not data.isspace():
            self.leave_head()
        if not self.hidden:
            self.buffer.append(data)
            if self.open_tags.get("a"):
                self.linked[self.block_node()] += len(data)


def features(page: Page) -> np.ndarray:
    """One row of FEATURES a node."""
    n = len(page.tag)
    text, links, stops, tags = np.zeros(n), np.array(page.linked, float), np.zeros(n), np.ones(n)
    for node, said in page.blocks:
        text[node] += len(said)
        stops[node] += sum(map(said.count, ".,;:!?"))
    out = np.zeros((n, len(FEATURES)))
    for node in range(n - 1, 0, -1):  # children come after their parents
        up = page.parent[node]
        for total in (text, links, stops, tags):
            total[up] += total[node]
    size = np.log1p(text)
    out[:, 1], out[:, 2], out[:, 3], out[:, 4] = size, links / (text + 1), tags / (text + 1), stops / (text + 1)
    above = np.zeros((n, 4))
    for node in range(n):
        tag, tokens, up = page.tag[node], page.tokens[node], page.parent[node]
        # a class of the whole page says nothing of its parts, and an article's own header is part of it
        tokens = frozenset() if tag in ("html", "body") else tokens
        other = tag in OTHER_TAGS and not (tag == "header" and above[up][0])
        above[node] = (tag in MAIN_TAGS, other, bool(tokens & MAIN_TOKENS), bool(tokens & OTHER_TOKENS))
        if up >= 0:
            above[node] = np.maximum(above[node], above[up])
            out[node, 0] = min(out[up, 0] + 1, 64)
        out[node, 8:11] = (tag == "p", tag in HEADINGS, tag in LISTS)
        below = page.children[node]
        if below:
            counts: dict[str, int] = {}
            for c in below:
                counts[page.tag[c]] = counts.get(page.tag[c], 0) + 1
            beside = size[below].mean()
            for place, c in enumerate(below):
                out[c, 5:8] = (min(len(below), 64), counts[page.tag[c]] / len(below), place / len(below))
                out[c, 11] = beside
    out[:, 12:] = above
    return out


def plain_side(row: np.ndarray) -> int:
    """1 for a node that landmarks put into the main text, 0 for one that they put elsewhere, else -1."""
    main, other, _, other_token = row[12:]
    return 0 if other or other_token else 1 if main else -1


def decode(page: Page, margins: np.ndarray) -> np.ndarray:
    """Whether each node is main text, in the best labelling of the tree. A node weighs as much as its own text."""
    n = len(page.tag)
    own = np.zeros(n)
    for node, said in page.blocks:
        own[node] += math.log1p(len(said))
    whole = own * margins
    best, free = np.zeros(n), np.abs(whole)
    for node in range(n - 1, -1, -1):
        mixed = free[node] - MIXED
        best[node] = max(whole[node], -whole[node], mixed if page.children[node] else -math.inf)
        up = page.parent[node]
        if up >= 0:
            free[up] += best[node]
            whole[up] += whole[node]
    kept = np.zeros(n, bool)
    label = [0] * n  # 1: all main, -1: nothing, 0: children decide
    for node in range(n):
        up = page.parent[node]
        if up >= 0 and label[up]:
            label[node] = label[up]
        elif abs(whole[node]) >= best[node] - 1e-12:
            label[node] = 1 if whole[node] > 0 else -1
        kept[node] = label[node] > 0 or label[node] == 0 and margins[node] > 0
    return kept


Tree = tuple  # (feature, threshold, left, right), or (value,)


def read_trees(description: str) -> list[tuple[float, Tree]]:
    """Weights and trees from the text in which Spark describes a tree ensemble."""
    lines = [x.strip() for x in description.splitlines()[1:] if x.strip()]
    at = 0

    def node() -> Tree:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            return (float(line.split(":")[1]),)
        _, feature, _, threshold = line[line.index("(") + 1 : -1].split()
        left = node()
        at += 1  # Else
        return int(feature), float(threshold), left, node()

    out = []
    while at < len(lines):
        weight = float(lines[at].split("weight")[1].strip(" ):"))
        at += 1
        out.append((weight, node()))
    return out


def margins(trees: list[tuple[float, Tree]], rows: np.ndarray) -> np.ndarray:
    """Margin of each row; without trees it follows the landmarks."""
    if not trees:
        return np.where((rows[:, 13] > 0) | (rows[:, 15] > 0), -1.0, 1.0)
    out = np.zeros(len(rows))
    for weight, tree in trees:
        todo = [(tree, np.arange(len(rows)))]
        while todo:
            part, at = todo.pop()
            if len(part) == 1:
                out[at] += weight * part[0]
            elif len(at):
                left = rows[at, part[0]] <= part[1]
                todo += [(part[2], at[left]), (part[3], at[~left])]
    return out


def fit(pages: DataFrame, html_column: str) -> list[tuple[float, Tree]]:
    """Trees from the plain nodes of the sample, or none if these don't show both sides."""
    sample = pages.select(F.col(html_column).cast("string").alias("html")).where("html is not null").orderBy(F.xxhash64("html"), "html").limit(SAMPLE_PAGES)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for html in batch.column("html").to_pylist():
                found = features(Page(html))
                side = np.array([plain_side(r) for r in found])
                seen, plain = found[side >= 0], side[side >= 0].astype(float)
                hidden = seen.copy()
                hidden[:, LANDMARKS] = 0
                both = np.concatenate([seen, hidden])
                yield pa.RecordBatch.from_arrays([pa.array(list(both), pa.list_(pa.float64())), pa.array(np.tile(plain, 2))], names=["x", "label"])

    nodes = sample.mapInArrow(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label").persist()
    try:
        if nodes.select("label").distinct().count() < 2:
            return []
        model = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=7, cacheNodeIds=False).fit(nodes)
        return read_trees(model.toDebugString)
    finally:
        nodes.unpersist()


def main_text(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """pages with the column `out`: the main text, its blocks in page order joined by a line feed.

    Character references are decoded and white space inside a block, also what Unicode calls so, becomes one space.
    Scripts, styles, form controls and other text that is never shown don't count; an end tag that HTML lets out is
    filled in. A sample that shows only one side fits no trees, and landmarks decide. A null or empty page, or one without main text, gives an empty text. Every row is
    extracted by itself, so repeated ones are alike; an empty table gives no row; a column of pages named `out` is
    replaced, all others stay.
    """
    trees = fit(pages, html_column)
    source = pages.select(F.struct(*(pages[c] for c in pages.columns if c not in (out, html_column))).alias("row"), F.coalesce(pages[html_column].cast("string"), F.lit("")).alias("html"))
    made = T.StructType([source.schema["row"], source.schema["html"], T.StructField(out, T.StringType())])

    def text(html: str) -> str:
        page = Page(html)
        if not page.blocks:
            return ""
        kept = decode(page, margins(trees, features(page)))
        return "\n".join(said for node, said in page.blocks if kept[node])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "html"):
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("html"), pa.array([text(h) for h in part.column("html").to_pylist()], pa.string())], names=made.names)

    return source.mapInArrow(run, made).select("row.*", F.col("html").alias(html_column), out)
