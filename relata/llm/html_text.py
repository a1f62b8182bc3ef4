"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

Every element, and every run of text, is a node. Its features are its tag, tokens of class, id and role, what stands
above it, depth, how dense its subtree is in text, links and stops, and how it compares with its siblings. The trees give
the log odds that a text belongs to the main text, or that an element holds some of it. Decoding then chooses the best
consistent set: a node stays only if its parent does, so an element with all that is in it stays or goes by the sum of
its own odds and those of the best choice below it.

Pages have no labels. The model is fitted on at most ``SAMPLE`` pages that have an ``article`` or ``main`` element, those
with the least hashes of their ids; what stands in that element counts as main text, but for parts that their tag or
tokens name otherwise. Each of these pages is also seen in ``VARIANTS`` disguises, in which that element lost its tag and
got another name, and boilerplate made of the page's own words stands before, in and after it under changing names.
Extraction is a map over all rows; the model has a fixed size.

Blocks are what block elements part. Character references are decoded, white space in a block becomes one blank, blocks
are joined by one blank in page order; nothing else is cut.

Defined results: a null html is empty; an empty page has an empty text; without any page to learn from, a fixed set of
such pages is used; equal rows each get their result; further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relata.llm.dom import Page, parse, tokens_of
from relata.llm.frames import map_texts

#: Pages the model is fitted on, at most, the disguises of each, and the bytes of a page that is used.
SAMPLE, VARIANTS, SAMPLE_BYTES = 120, 5, 40_000
TREES, DEPTH, RATE, RIDGE, BINS = 40, 4, 0.25, 1.0, 12

# Words by which pages name their parts.
BOILERPLATE_TAGS = frozenset("nav header footer aside form button fieldset dialog menu figcaption".split())
CONTENT_TAGS = frozenset(("article", "main"))
BOILERPLATE_TOKENS = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion nav navigation navbar menu "
    "breadcrumb breadcrumbs header masthead footer sidebar side aside widget related recommended share sharing social "
    "comment comments reply replies respond disqus discussion cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup login form search toolbar pagination pager tags copyright legal skip "
    "complementary contentinfo".split()
)
CONTENT_TOKENS = frozenset("article content main body post entry story text page blog".split())
KINDS = {
    name: kind
    for kind, names in enumerate(
        ("#text", "article main", "section div", "p pre blockquote", "h1 h2 h3 h4 h5 h6", "ul ol dl", "li dt dd", "nav menu", "header", "footer",
         "aside", "form fieldset button label", "table tr td th tbody thead", "#root html body")
    )
    for name in names.split()
}
OTHER_KIND = max(KINDS.values()) + 1
FEATURES = 22


def _log(value: float) -> float:
    return float(np.log2(1 + value))


def node_features(page: Page) -> np.ndarray:
    """The features of each node, in order of the nodes."""
    count = len(page.tags)
    depth, above_bad, above_good = [0] * count, [0] * count, [0] * count
    own_bad, own_good = [0] * count, [0] * count
    chars, links, stops, runs, below = ([0] * count for _ in range(5))
    children: list[list[int]] = [[] for _ in range(count)]
    for node in range(count):
        parent = page.parents[node]
        tokens = tokens_of(page.attributes[node]) if page.attributes[node] else ()
        own_bad[node] = sum(token in BOILERPLATE_TOKENS for token in tokens)
        own_good[node] = sum(token in CONTENT_TOKENS for token in tokens)
        if parent >= 0:
            children[parent].append(node)
            depth[node] = depth[parent] + 1
            above_bad[node] = above_bad[parent] + (own_bad[parent] > 0) + 4 * (page.tags[parent] in BOILERPLATE_TAGS)
            above_good[node] = above_good[parent] + (own_good[parent] > 0) + 4 * (page.tags[parent] in CONTENT_TAGS)
        if page.tags[node] == "#text":
            text = page.texts[node]
            chars[node] = len(text.strip())
            links[node] = chars[node] if page.linked[node] else 0
            stops[node] = text.count(".") + text.count(",")
            runs[node] = int(chars[node] > 0)
    for node in range(count - 1, 0, -1):
        parent = page.parents[node]
        for held in (chars, links, stops, runs):
            held[parent] += held[node]
        below[parent] += below[node] + 1
    total = max(1, chars[0])
    rows = np.zeros((count, FEATURES))
    for parent in range(count):
        brothers = children[parent]
        same: dict[str, int] = {}
        for node in brothers:
            same[page.tags[node]] = same.get(page.tags[node], 0) + 1
        for place, node in enumerate(brothers):
            before = chars[brothers[place - 1]] if place else 0
            after = chars[brothers[place + 1]] if place + 1 < len(brothers) else 0
            length = max(1, chars[node])
            rows[node] = (
                KINDS.get(page.tags[node], OTHER_KIND), KINDS.get(page.tags[parent], OTHER_KIND), own_bad[node], own_good[node], above_bad[node] % 4,
                above_bad[node] // 4, above_good[node] % 4, above_good[node] // 4, own_bad[parent], own_good[parent], depth[node], _log(chars[node]),
                links[node] / length, 100 * stops[node] / length, _log(chars[node] / (1 + below[node])), _log(runs[node]), chars[node] / total,
                chars[node] / max(1, chars[parent]), _log(same[page.tags[node]]), _log(before), _log(after), place / len(brothers),
            )
    return rows


@dataclass
class Trees:
    """Boosted trees over binned features; node n of a tree has its branches at 2n + 1 and 2n + 2."""

    edges: list[np.ndarray]
    tests: np.ndarray
    limits: np.ndarray
    values: np.ndarray
    start: float

    def binned(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(edges, rows[:, place], side="right") for place, edges in enumerate(self.edges)], axis=1)

    def odds(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        bins = self.binned(rows)
        found, every = np.full(len(rows), self.start), np.arange(len(rows))
        for tests, limits, values in zip(self.tests, self.limits, self.values, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (bins[every, tests[at]] > limits[at])
            found += values[at]
        return found


def boost(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Trees:
    """Trees that fit the log odds of ``labels``, each to the gradient its predecessors left, by histograms of bins."""
    edges = [np.unique(np.quantile(np.unique(column), np.linspace(0, 1, BINS + 1)[1:-1], method="nearest")) for column in rows.T]
    share = min(max(float(np.average(labels, weights=weights)), 0.01), 0.99)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    trees = Trees(edges, np.zeros((TREES, inner), np.int64), np.zeros((TREES, inner)), np.zeros((TREES, inner + leaves)), float(np.log(share / (1 - share))))
    bins = trees.binned(rows)
    wide = max(map(len, edges)) + 1
    odds = np.full(len(rows), trees.start)
    for tree in range(TREES):
        guess = 1 / (1 + np.exp(-odds))
        slope, curve = weights * (labels - guess), weights * guess * (1 - guess)
        at = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            first, nodes = 2**level - 1, 2**level
            best = np.full(nodes, -1.0)
            for place in range(rows.shape[1]):
                code = (at - first) * wide + bins[:, place]
                a = np.bincount(code, slope, nodes * wide).reshape(nodes, wide).cumsum(axis=1)
                b = np.bincount(code, curve, nodes * wide).reshape(nodes, wide).cumsum(axis=1)
                rest_a, rest_b = a[:, -1:] - a, b[:, -1:] - b
                gain = a**2 / (b + RIDGE) + rest_a**2 / (rest_b + RIDGE) - a[:, -1:] ** 2 / (b[:, -1:] + RIDGE)
                limit = gain.argmax(axis=1)
                top = gain[np.arange(nodes), limit]
                better = top > best + 1e-12
                best[better] = top[better]
                trees.tests[tree, first : first + nodes][better] = place
                trees.limits[tree, first : first + nodes][better] = limit[better]
            at = 2 * at + 1 + (bins[np.arange(len(rows)), trees.tests[tree, at]] > trees.limits[tree, at])
        a, b = np.bincount(at, slope, inner + leaves), np.bincount(at, curve, inner + leaves)
        trees.values[tree] = RATE * a / (b + RIDGE)
        odds += trees.values[tree, at]
    return trees


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """The best set of nodes in which every node but the root has its parent."""
    best = odds.tolist()
    for node in range(len(best) - 1, 0, -1):
        if best[node] > 0:
            best[page.parents[node]] += best[node]
    stays = [True] * len(best)
    for node in range(1, len(best)):
        stays[node] = best[node] > 0 and stays[page.parents[node]]
    return stays


def written(page: Page, stays: list[bool]) -> str:
    """The text runs that stay: joined within blocks, white space made one blank, blocks joined by a blank."""
    blocks: dict[int, list[str]] = {}
    for node, tag in enumerate(page.tags):
        if tag == "#text" and stays[node]:
            blocks.setdefault(page.blocks[node], []).append(page.texts[node])
    return " ".join(filter(None, (" ".join("".join(parts).split()) for parts in blocks.values())))


def known_labels(page: Page) -> np.ndarray:
    """Which nodes hold main text, on a page with an element that is known to."""
    inside = [False] * len(page.tags)
    for node in range(1, len(page.tags)):
        attributes = page.attributes[node]
        named = page.tags[node] in BOILERPLATE_TAGS or (attributes and tokens_of(attributes) & BOILERPLATE_TOKENS)
        begins = page.tags[node] in CONTENT_TAGS or "data-keep" in attributes
        inside[node] = (inside[page.parents[node]] or begins) and not named
    found = np.array([tag == "#text" and held and bool(text.strip()) for tag, held, text in zip(page.tags, inside, page.texts, strict=True)])
    for node in range(len(found) - 1, 0, -1):
        if found[node]:
            found[page.parents[node]] = True
    return found


CONTENT_ELEMENT = re.compile(r"<(/?)(article|main)\b([^>]*)>", re.IGNORECASE)


def disguised(source: str, seed: int) -> str:
    """The page with its content element renamed, and boilerplate of its own words around and in it."""
    dice = random.Random(seed)
    words = re.sub(r"<[^>]*>", " ", source).split() or ["text"]

    def some(low: int, high: int) -> str:
        start = dice.randrange(len(words))
        return " ".join((words[start:] + words)[: dice.randint(low, high)]).replace("<", "")

    def filler() -> str:
        name = dice.choice(sorted(BOILERPLATE_TOKENS)) + dice.choice(["", "", "-box", "_area", " block"])
        tag = dice.choice(["div", "div", "section", "aside", "nav", "header", "footer", "form", "ul", "p"])
        given = f' {dice.choice(["class", "class", "id"])}="{name}"' if tag in ("div", "section", "ul", "p") or dice.random() < 0.5 else ""
        inner = dice.choice(
            [
                lambda: "".join(f'<li><a href="#">{some(1, 3)}</a></li>' for _ in range(dice.randint(2, 8))),
                lambda: "".join(f"<p>{some(3, 60)}</p>" for _ in range(dice.randint(1, 4))),
                lambda: some(2, 30),
                lambda: f"<h3>{some(1, 4)}</h3><div><p>{some(5, 80)}</p><span>{some(1, 3)}</span></div>",
                lambda: f"<label>{some(1, 3)}</label><input name=q><button>{some(1, 2)}</button>",
            ]
        )()
        return f"<{tag}{given}>{inner}</{tag}>"

    element = dice.choice(["div", "section", "div", "article", "main"])
    given = f'class="{dice.choice(sorted(CONTENT_TOKENS))}{dice.choice(["", "-inner", " wide"])}"' if dice.random() < 0.5 else ""
    outer = dice.choice(["", "<div>", '<div id="page">'])

    def replaced(match: re.Match) -> str:
        few = "".join(filler() for _ in range(dice.randint(0, 3)))
        many = "".join(filler() for _ in range(dice.randint(0, 2)))
        if match[1]:
            return f"{many}</{element}>{few}" + ("</div>" if outer else "")
        return f"{few}{outer}<{element} {given} data-keep=1>{many if dice.random() < 0.3 else ''}"

    return CONTENT_ELEMENT.sub(replaced, source)


#: What to learn from where no page names its content.
SPARE_PAGE = (
    "<html><head><title>t</title></head><body><header>Site name</header><nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav>"
    "<article><h1>A heading of some words</h1><p>First sentence of the text, with a stop. Second one follows, as usual.</p><p>More of it here, and more. "
    "The text goes on for a while.</p><ul><li>One point of a list.</li><li>Another point.</li></ul></article><footer>Imprint and contact</footer></body></html>"
)


def fit(sources: list[str]) -> Trees:
    """The trees of pages that name their content, and of their disguises."""
    rows, labels, weights = [], [], []
    for number, source in enumerate(sources or [SPARE_PAGE] * 20):
        for variant in range(VARIANTS + 1):
            page = parse(disguised(source, 1000 * number + variant) if variant else source)
            rows.append(node_features(page)[1:])
            labels.append(known_labels(page)[1:])
            weights.append(np.array([len(text.strip()) > 0 if tag == "#text" else 1.0 for tag, text in zip(page.tags, page.texts, strict=True)][1:], float))
    return boost(np.concatenate(rows), np.concatenate(labels).astype(float), np.concatenate(weights))


def train(pages: DataFrame, key: str = "page_id", html: str = "html") -> Trees:
    """The trees of a bounded sample of ``pages``."""
    usable = (F.octet_length(html) <= SAMPLE_BYTES) & F.regexp_like(html, F.lit("(?i)<(article|main)[ >]"))
    ids = pages.where(usable).select(key).where(F.col(key).isNotNull()).distinct().orderBy(F.xxhash64(key), key).limit(SAMPLE)
    # At most SAMPLE ids and pages of at most SAMPLE_BYTES, so what is sent and gathered is bounded.
    sample = pages.where(usable).select(key, F.col(html).alias("html")).join(F.broadcast(ids), key)
    rows = sample.groupBy(key).agg(F.min("html").alias("html")).orderBy(F.xxhash64(key), key).limit(SAMPLE).collect()
    return fit([row["html"] for row in rows])


def extract(pages: DataFrame, trees: Trees, key: str = "page_id", html: str = "html", rest: tuple[str, ...] = ("url",)) -> DataFrame:
    """``key``, the columns ``rest``, the main ``text`` of each row's whole html, and its length ``n_chars``."""
    sent = pages.sparkSession.sparkContext.broadcast(trees)
    kinds = ", ".join(f"{name} {pages.schema[name].dataType.simpleString()}" for name in (key, *rest))

    def work(piece: pa.RecordBatch) -> list:
        read = [parse(source) for source in piece.column(len(rest) + 1).to_pylist()]
        sizes = np.cumsum([0, *(len(page.tags) for page in read)])
        odds = sent.value.odds(np.concatenate([node_features(page) for page in read]))
        texts = [written(page, decode(page, odds[low:high])) for page, low, high in zip(read, sizes, sizes[1:], strict=False)]
        return [*[piece.column(i) for i in range(len(rest) + 1)], texts, [len(text) for text in texts]]

    return map_texts(pages, [key, *rest, html], f"{kinds}, text string, n_chars long", work)
