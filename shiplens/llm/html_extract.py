"""Main text of web pages by minimum-cut labelling of text blocks.

A page is cut into text blocks at block-level tags.  A logistic classifier
gives each block a logit for being content, from features of its text (length,
links, punctuation, heading), its place in the page, and the elements around it
(an article or main element; menus, headers, footers, asides, forms and the
like, by tag, role, class and id).  The logits are the terminal capacities of a graph over
the blocks; blocks next to each other and blocks close in the DOM are joined
by smoothness edges.  The minimum cut separates content from boilerplate.

Blocks whose terminal outweighs all their edges have the sign of their logit
in every minimum cut; they are fixed first, and the flow is computed on what
is left.

All weights are learned here on a bounded sample of pages, as the most
probable ones under a stated prior (``PRIOR``, what a page without any training
data is judged by): blocks inside article or main elements against blocks inside
menus, footers and so on.  On every other sampled page the elements are hidden
from the classifier, so text and place must explain the labels there.  The edges'
weights come from the same fit: what the labels of a block's neighbours add to
its logit is, in the cut, what it costs to label them differently.

A class or id is boilerplate if all its words are such names or fillers
("cookie-notice", "sidebar-left"); a name that also says something else
("share-price", "social-history") is weak evidence, which the text can outvote.
An element like a form or sidebar around most of a page without an article says nothing.
Only a hidden attribute decides alone.

White space inside a block becomes one space (a line break too), character
references are decoded, blocks are joined by a line feed in page order.  An
inline element marked as boilerplate is a block of its own, but on its line.

Edge cases: a null or empty html, or one without content blocks, gives an empty
text; an unclosed comment, script or style hides what follows; unclosed and
unmatched tags are tolerated; a page of any length is read whole; repeated rows
give equal rows; without training blocks the prior decides; an empty table gives
an empty result; other columns pass through, and an added column may not have the name of one there (error).
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import bounded_batches, hash_below, read, staged

TRAIN_PAGES = 400
STEPS = 8
SAME_LINE = 0.5
# Features of a block: its text, its place, the elements around it, its neighbours' labels.
TEXT = ("always", "log length", "share of links", "marks per word", "heading")
PLACE = ("near the start", "near the end")
AROUND = ("in an article", "in boilerplate", "in a form or sidebar", "in a name with a boilerplate word", "outside the page's article")
EDGES = ("next to", "sibling", "cousin")
N_TEXT, N_UNARY = len(TEXT), len(TEXT) + len(PLACE) + len(AROUND)
# Weights before any training, and how strongly they hold.
PRIOR = (0.4, 0.33, -6.4, -1.1, 3.1) + (0.0, 0.0) + (4.0, -4.5, -3.5, -2.5, -4.0) + (0.5, 0.5, 0.25)
RIDGE = 4.0
# What text can add to a logit, and the least and most that an edge weighs.
TEXT_MOST, EDGE_LEAST, EDGE_MOST = 3.0, 0.1, 0.75
HIDE = -12.0

# Choices: element names by their part in a page.
_BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noscript ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
_HIDDEN = set("script style head template svg math iframe object noembed noframes textarea title noscript select canvas audio video".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_HEADING = set("h1 h2 h3 h4 h5 h6".split())
_ARTICLE = set("article main".split())
_BOILER_TAGS = set("nav footer aside menu dialog button".split())
_PLACED_TAGS = set("form fieldset".split())
_BOILER_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_ARTICLE_NAMES = set("article articlebody content entry main maincontent post postbody story".split())
_BOILER_NAMES = set(
    "ad ads adv advert advertisement adverts comment comments consent cookie cookies disqus gdpr recommended related replies "
    "respond sponsor sponsored".split()
)
_PLACED_NAMES = set(
    "alert banner breadcrumb breadcrumbs captcha copyright disclaimer footer form login menu modal nav navbar navigation "
    "newsletter notice overlay pager pagination paywall popup promo promoted promotion reply search share sharing sidebar signin "
    "signup skip social subscribe subscription tags teaser toc toolbar widget widgets".split()
)
_HEADER_NAMES = set("header masthead".split())
_MARKED_NAMES = _BOILER_NAMES | _PLACED_NAMES | _HEADER_NAMES
# Words that say where or how, not what: a name of these and boilerplate words is boilerplate.
_FILLERS = set(
    "site page main top bottom left right inner outer wrap wrapper container box block area section list item items link links bar "
    "button buttons btn icon icons panel primary secondary global local mobile desktop text title group row col column module component "
    "region slot unit holder small large inline sticky fixed body blog web user users reader readers thread form forms story stories news "
    "post posts entry article articles more read sub has no is with on off open by the of to and js ui wp".split()
)
# comments and processing instructions, or a tag; a quoted value holds no "<", so scanning stays linear
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']++|"[^"<]*"|'[^'<]*'|["'])*+)>""", re.S)
# a whole attribute: its name and its value, which may hold anything (an open quote ends with the tag)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>][^\s>]*)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# what an element says about the text inside it
ARTICLE, NEUTRAL, PLACED, HEADER, BOILER, HIDDEN = 1, 0, -1, -2, -3, -4


class Block:
    __slots__ = ("text", "parent", "grand", "heading", "linked", "glue", "parts", "hinted", "article", "boiler", "strong", "hidden")

    def __init__(self, text, path, linked, glue):
        # glue: what joins it to the block before on the same line, None at a new line
        self.text, self.linked, self.glue = text, linked, glue
        self.parent, self.grand = path[-1][1], path[-2][1] if len(path) > 1 else 0
        self.heading = any(e[0] in _HEADING for e in path)
        self.parts = [(e[2], e[1]) for e in path if e[2]]
        self.hinted = any(e[3] for e in path)  # inside a name with a boilerplate word

    def judge(self, ignored: set[int]) -> None:
        """What the elements around it say, but for the ``ignored`` ones."""
        parts = [p for p, number in self.parts if not (p == PLACED and number in ignored)]
        self.article = ARTICLE in parts
        first = parts.index(ARTICLE) if self.article else len(parts)
        # boilerplate anywhere around it; a header that isn't the article's own; or an element
        # like a form or sidebar, unless the article lies inside that (a page in one form)
        placed = [p for p in parts if p in (ARTICLE, PLACED)]
        self.hidden = HIDDEN in parts
        self.strong = self.hidden or BOILER in parts or HEADER in parts[:first]
        self.boiler = self.strong or (bool(placed) and placed[-1] == PLACED)


def judge(blocks: list[Block]) -> None:
    """Let each block see the elements around it; one like a form around most of a page without an article says nothing."""
    ignored: set[int] = set()
    if not any(p == ARTICLE for b in blocks for p, _ in b.parts):
        inside: dict[int, int] = {}
        for b in blocks:
            for number in {n for p, n in b.parts if p == PLACED}:
                inside[number] = inside.get(number, 0) + len(b.text)
        total = sum(len(b.text) for b in blocks)
        ignored = {n for n, size in inside.items() if 2 * size > total}
    for b in blocks:
        b.judge(ignored)


def attributes_of(text: str) -> dict[str, str]:
    """Attributes of a tag by their full names; of a repeated one the first counts."""
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), a or b or c)
    return found


def _part(tag: str, attributes: str, nested: bool = False) -> tuple[int, bool]:
    """What an element says about the text inside it, by its tag, role, class and id; and whether a name only hints at boilerplate.

    An article or main element outranks words inside its own class and id
    ("comments-open", "has-sidebar"), unless a whole name is such a word and
    none is an article's, or it is ``nested`` in an article (a related story).
    """
    if tag in ("html", "body"):  # their classes speak of the whole page
        return NEUTRAL, False
    hinted = False
    found = [BOILER] if tag in _BOILER_TAGS else [HEADER] if tag == "header" else [PLACED] if tag in _PLACED_TAGS else []
    for name, value in attributes_of(attributes).items() if attributes else ():
        if name == "hidden":  # whatever its value, as in browsers
            found.append(HIDDEN)
        elif name == "role":
            found += [BOILER] * (value.lower() in _BOILER_ROLES) + [ARTICLE] * (value.lower() in _ARTICLE)
        elif name in ("class", "id"):
            words = {w.lower() for w in _WORDS.findall(value)}
            if tag in _ARTICLE and not nested and (words & _ARTICLE_NAMES or not set(value.lower().split()) & _MARKED_NAMES):
                continue
            # a name of its own that says something else too is a hint, not a mark
            mixed = {w for v in value.split() if (own := {x.lower() for x in _WORDS.findall(v)}) & _MARKED_NAMES and any(map(_says_more, own)) for w in own}
            marked = words - mixed
            hinted = hinted or bool(mixed)
            for names, part in ((_BOILER_NAMES, BOILER), (_HEADER_NAMES, HEADER), (_PLACED_NAMES, PLACED), (_ARTICLE_NAMES, ARTICLE)):
                if marked & names:
                    found.append(part)
                    break
    part = min(found) if found and min(found) < 0 else ARTICLE if found or tag in _ARTICLE else NEUTRAL
    return part, hinted and part >= 0


def _says_more(word: str) -> bool:
    return len(word) > 1 and not word.isdigit() and word not in _MARKED_NAMES and word not in _FILLERS and word not in _ARTICLE_NAMES


def blocks_of(page: str | None) -> list[Block]:
    """Text blocks of a page, in order."""
    page = page or ""
    found: list[Block] = []
    path: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]  # open elements: tag, number, part, hint
    number = 0
    texts: list[str] = []
    links, linked = 0, 0  # open links, and characters inside them
    glue: str | None = None

    def close(inline=False):
        """End a block; after an ``inline`` end the next block stands on the same line."""
        nonlocal linked, glue
        raw = "".join(texts)
        text = " ".join(raw.split())
        if text:
            if glue == "" and raw[0].isspace():
                glue = " "
            found.append(Block(text, path, linked, glue))
            glue = ""
        if not inline:
            glue = None
        elif glue == "" and raw and raw[-1].isspace():
            glue = " "
        texts.clear()
        linked = 0

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        raw = page[at : m.start() if m else size]
        if raw:
            raw = entities.unescape(raw)
            texts.append(raw)
            if links:
                linked += len(raw)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        closing, tag = m[1], m[2].lower()
        if tag in _HIDDEN and not closing:
            if tag not in ("svg", "math") and m[3].rstrip().endswith("/"):
                continue
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if tag != "head" or end:
                at = end.end() if end else size
            if tag in _BLOCK:
                close()
        elif tag == "a":
            links = max(0, links + (-1 if closing else 1))
        elif tag == "br":
            texts.append(" ")
        elif tag in _BLOCK:
            close()
            links = 0
            if tag in _VOID:
                continue
            if closing:
                for i in range(len(path) - 1, 0, -1):
                    if path[i][0] == tag:
                        del path[i:]
                        break
            else:
                i = len(path) - 1
                while path[i][0] and path[i][0] not in _BLOCK:
                    i -= 1
                if path[i][0] == "p" or (tag == path[i][0] and tag in ("li", "td", "th", "tr", "dt", "dd", "option")):
                    del path[i:]
                number += 1
                nested = tag in _ARTICLE and any(e[2] == ARTICLE and e[0] == "article" for e in path)
                path.append((tag, number, *_part(tag, m[3], nested)))
        elif tag in _VOID:
            continue
        elif not closing:
            # an inline element that is marked as boilerplate is a block on the same line
            part = min(NEUTRAL, _part(tag, m[3])[0])
            inside = path[-1][0] and path[-1][0] not in _BLOCK
            if part < 0:
                close(inline=True)
            if part < 0 or inside:
                path.append((tag, path[-1][1], part, False))
        else:
            i = len(path) - 1
            while path[i][0] and path[i][0] not in _BLOCK and path[i][0] != tag:
                i -= 1
            if path[i][0] == tag:
                if any(e[2] < 0 for e in path[i:]):
                    close(inline=True)
                del path[i:]
    close()
    judge(found)
    return found


def text_features(b: Block) -> list[float]:
    words = b.text.count(" ") + 1
    marks = sum(b.text.count(c) for c in ".,;:?!")
    return [1.0, float(np.log1p(len(b.text))), min(1.0, b.linked / len(b.text)), min(1.0, marks / words), float(b.heading)]


def features(blocks: list[Block], hide: bool = False) -> np.ndarray:
    """A row per block; with ``hide`` as if the elements around said nothing."""
    has_article = any(b.article and not b.boiler for b in blocks)
    last, rows = len(blocks) - 1, []
    for i, b in enumerate(blocks):
        kinds = (b.article and not b.boiler, b.strong, b.boiler and not b.strong, b.hinted, has_article and not b.article and not b.boiler)
        around = [0.0] * len(AROUND) if hide else [float(k) for k in kinds]
        rows.append([*text_features(b), 1 / (1 + i), 1 / (1 + last - i), *around])
    return np.array(rows).reshape(len(blocks), N_UNARY)


def links(blocks: list[Block]) -> list[tuple[int, int, int, float]]:
    """Edges ``(i, j, kind, strength)`` between neighbours in the page, children of one element and of one grandparent."""
    out: list[tuple[int, int, int, float]] = []
    last_of: dict[tuple[int, int], int] = {}
    for i, b in enumerate(blocks):
        if i:
            out.append((i - 1, i, 0, 1.0 + (SAME_LINE / 0.5 if b.glue is not None else 0.0)))
        for kind, element in ((1, b.parent), (2, b.grand)):
            j = last_of.get((kind, element))
            if j is not None:
                out.append((j, i, kind, 1.0))
            last_of[kind, element] = i
    return out


@dataclass(frozen=True)
class Model:
    """Weights of :data:`TEXT`, :data:`PLACE` and :data:`AROUND`, then of :data:`EDGES`."""

    weights: tuple[float, ...] = PRIOR

    def logits(self, blocks: list[Block], hide: bool = False) -> list[float]:
        """Evidence for content of each block; what text says is bounded, so that elements can outvote it and it them."""
        x, w = features(blocks, hide), np.array(self.weights)
        z = np.clip(x[:, :N_TEXT] @ w[:N_TEXT], -TEXT_MOST, TEXT_MOST) + x[:, N_TEXT:] @ w[N_TEXT:N_UNARY]
        return [HIDE if b.hidden else v for b, v in zip(blocks, z.tolist(), strict=True)]

    def smoothness(self, blocks: list[Block]) -> dict[tuple[int, int], float]:
        each = np.clip(self.weights[N_UNARY:], EDGE_LEAST, EDGE_MOST).tolist()
        edges: dict[tuple[int, int], float] = {}
        for i, j, kind, strength in links(blocks):
            edges[i, j] = edges.get((i, j), 0.0) + strength * each[kind]
        return edges

    def labels(self, blocks: list[Block], hide: bool = False) -> list[bool]:
        return minimum_cut(self.logits(blocks, hide), self.smoothness(blocks))


def minimum_cut(terminal: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Labels (True: source side) of the minimum cut; positive terminals join the source.

    Ties go to the sink side, the smallest source set.
    """
    n = len(terminal)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), w in edges.items():
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    z, label = list(terminal), [None] * n
    todo = list(range(n))
    while todo:  # persistent labels
        i = todo.pop()
        if label[i] is None and abs(z[i]) > sum(near[i].values()):
            label[i] = z[i] > 0
            for j, w in near[i].items():
                del near[j][i]
                z[j] += w if label[i] else -w
                todo.append(j)
            near[i].clear()
    free = [i for i in range(n) if label[i] is None]
    if not free:
        return label
    source, sink = n, n + 1
    cap: dict[int, dict[int, float]] = {i: dict(near[i]) for i in free} | {source: {}, sink: {}}
    for i in free:
        a, b = (source, i) if z[i] > 0 else (i, sink)
        cap[a][b], cap[b][a] = abs(z[i]), 0.0
    while True:  # blocking flows on level graphs
        level, queue = {source: 0}, [source]
        for a in queue:
            for b, c in cap[a].items():
                if c > 1e-12 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            return [level.get(i) is not None if label[i] is None else label[i] for i in range(n)]
        ahead = {a: [b for b, c in cap[a].items() if c > 1e-12 and level.get(b) == level[a] + 1] for a in level}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                flow = min(cap[p][q] for p, q in zip(path, path[1:]))
                for p, q in zip(path, path[1:]):
                    cap[p][q] -= flow
                    cap[q][p] = cap[q].get(p, 0.0) + flow
                back = next(k for k, (p, q) in enumerate(zip(path, path[1:])) if cap[p][q] <= 1e-12)
                del path[back + 1 :]
                continue
            while ahead[a] and cap[a][ahead[a][-1]] <= 1e-12:
                ahead[a].pop()
            if ahead[a]:
                path.append(ahead[a][-1])
            else:
                path.pop()
                if path:
                    ahead[path[-1]].pop()


def main_text(page: str | None, model: Model) -> str:
    blocks = blocks_of(page)
    out: list[str] = []
    between: str | None = None  # glue since the last block of content
    for b, content in zip(blocks, model.labels(blocks)):
        between = None if b.glue is None or between is None else between or b.glue
        if content:
            out += ["\n" if between is None else between] * bool(out) + [b.text]
            between = ""
    return "".join(out)


def training_rows(page: str, hide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Features (with what the neighbours' known labels say) and labels of the blocks whose elements tell them."""
    blocks = blocks_of(page)
    label = np.array([(1.0 if b.article else -1.0) if b.article != b.boiler else 0.0 for b in blocks])
    near = np.zeros((len(blocks), len(EDGES)))
    for i, j, kind, strength in links(blocks):
        near[i, kind] += strength * label[j]
        near[j, kind] += strength * label[i]
    known = label != 0
    return np.hstack([features(blocks, hide), near])[known], label[known] > 0


def newton_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the log likelihood at ``w``."""
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return x.T @ (y - p), x.T @ (x * (p * (1 - p))[:, None])


def train(pages: DataFrame, sample: int = TRAIN_PAGES) -> Model:
    """The most probable weights given a bounded sample of ``pages(page_id, html)`` and the prior.

    The sample's features are staged; each Newton step is a job over them
    that returns one row of sums per task.
    """
    usable = pages.where("page_id is not null and html is not null")
    total = usable.count()
    # about `sample` pages; half of them by another bit of the hash with the elements hidden
    picked = usable.where(hash_below(F.col("page_id"), min(1.0, sample / max(total, 1))))
    rows = picked.select("html", (F.xxhash64("page_id", F.lit("hide")) % 2 == 0).alias("hide"))

    def featured(batches):
        for b in batches:
            for page, hide in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x, y = training_rows(page, hide)
                if len(y):
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=["x", "y"])

    blocks = staged(rows.mapInArrow(featured, "x binary, y binary"), "html-blocks")
    prior = np.array(PRIOR)
    w = prior.copy()
    for _ in range(STEPS):

        def summed(batches, w=w):
            g, h, any_ = np.zeros(len(w)), np.zeros((len(w), len(w))), False
            for b in batches:
                for one_x, one_y in zip(b.column(0), b.column(1), strict=True):
                    x = np.frombuffer(one_x.as_buffer()).reshape(-1, len(w))
                    dg, dh = newton_sums(x, np.frombuffer(one_y.as_buffer(), bool).astype(float), w)
                    g, h, any_ = g + dg, h + dh, True
            if any_:
                yield pa.RecordBatch.from_arrays([pa.array([np.append(g, h).tolist()], pa.list_(pa.float64()))], names=["sums"])

        parts = sorted(r[0] for r in blocks.mapInArrow(summed, "sums array<double>").collect())
        if not parts:
            return Model()
        sums = np.sum(parts, axis=0)
        g, h = sums[: len(w)] - RIDGE * (w - prior), sums[len(w) :].reshape(len(w), len(w)) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return Model(tuple(w.round(9).tolist()))


def extracted(pages: DataFrame, model: Model) -> DataFrame:
    """``pages`` with ``text``; other columns pass through unread."""
    if "text" in pages.columns:
        raise ValueError("the rows have a column text of their own")
    bounded_batches(pages.sparkSession, 200)

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([main_text(h, model) for h in htmls], dtype=object)

    return pages.withColumn("text", extract("html"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", F.col("html").cast("string").alias("html"))
    found = extracted(pages, train(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
