"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a node that is content or not. A node's own signs (words of its
class and id, its text, its links) are weighed by a log-likelihood ratio; a parent-child potential,
the chance of a child being content given its parent and its tag, ties it to the tree. Sum-product
messages, first upward and then downward, give the exact marginal of each node, and the text of
the nodes that are more likely content than not is the main text.

The model is counted from labelled pages: a bounded sample of the corpus whose semantic markup
labels itself (``TRAIN_PAGES``), and a few hand-labelled layouts, of less weight, for designs it may lack.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import exp, log, log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayvalue.llm.html_pages import labelled_pages

#: Pages of the corpus that the model is trained on, at most: those of the smallest hash.
TRAIN_PAGES = 2000
SMOOTHING = 0.5
#: Labelled nodes that the built-in layouts and the corpus sample weigh as much as.
TRAIN_WEIGHTS = (20000.0, 30000.0)
#: The node of what stands at top level although the page opens no body.
IMPLIED = "#body"
#: Nodes that the more general chance weighs as much as in the chance of one tag or pair of tags.
SHRINKAGE = 0.1

# Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr input meta link hr area base col "
    "embed param source track".split()
)
SKIPPED = frozenset(
    "script style noscript template textarea title svg math iframe object select canvas video "
    "audio button".split()
)
RAW = frozenset(("script", "style", "textarea", "title"))
SPACED = frozenset(("br", "hr", "img"))
CLOSED_BY_BLOCK = frozenset(("p",))
#: An opening tag closes these open elements, up to the nearest of its containers.
CLOSES = {
    "li": (("li",), ("ul", "ol")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}
CONTENT_TAGS = frozenset(("article", "main"))
REJECTED_TAGS = frozenset(("nav", "aside", "footer", "form"))
REJECTED_WORDS = frozenset("ad ads advert comment comments share social related promo".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>""")
# One attribute after the other, so that nothing inside a quoted value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+""")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_CLOSE = {name: re.compile(rf"(?i)</{name}\s*>") for name in SKIPPED}


@dataclass
class Node:
    tag: str
    parent: int
    words: frozenset = frozenset()
    label: str | None = None
    letters: int = 0
    linked: int = 0
    parts: list = field(default_factory=list)  # (place, text) of its own inline runs


def _signs(attributes: str) -> tuple[frozenset, str | None]:
    words, label = set(), None
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        if name.lower() == "y":
            label = value
        elif name.lower() in ("class", "id", "role"):
            words.update(_WORD.findall(_CAMEL.sub(" ", value).lower()))
    return frozenset(words), label


def parse(page: str, labelled: bool = False) -> list[Node]:
    """The block elements in page order, parents before children; node 0 is the page itself.

    Markup may be broken: unclosed elements end with their parent, stray end tags are ignored. What
    stands at top level outside ``html`` and ``body`` gets an ``IMPLIED`` parent. The label attribute of
    the built-in layouts is read only if the page is ``labelled`` so.
    """
    nodes = [Node("#page", -1)]
    stack = [0]
    text: list[str] = []
    links = 0  # open links
    place = 0

    def imply_body() -> None:
        if len(stack) == 1:
            nodes.append(Node(IMPLIED, 0))
            stack.append(len(nodes) - 1)

    def flush() -> None:
        nonlocal place
        if text:
            run = " ".join("".join(t for t, _ in text).split())
            if run:
                imply_body()
                node = nodes[stack[-1]]
                node.parts.append((place, run))
                place += 1
                node.letters += len(run)
                node.linked += min(len(run), sum(len(t.strip()) for t, linked in text if linked))
            text.clear()

    def close(names: Iterable[str], until: Iterable[str]) -> None:
        for at in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[at]].tag
            if tag in names:
                del stack[at:]
                return
            if tag in until:
                return

    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            mark = size
        if mark > at:
            text.append((html.unescape(page[at:mark]), links > 0))
        if mark == size:
            break
        match = _TAG.match(page, mark)
        if match is None:
            if page.startswith("<!--", mark):
                end = page.find("-->", mark + 4)
                at = size if end < 0 else end + 3
            elif page.startswith(("<!", "<?", "</"), mark):
                end = page.find(">", mark)
                at = size if end < 0 else end + 1
            elif mark + 1 < size and page[mark + 1].isalpha() and (end := page.find(">", mark)) > 0:
                at = end + 1  # a tag with broken quotes
            else:
                text.append(("<", links > 0))
                at = mark + 1
            continue
        at = match.end()
        name = match[2].lower()
        if match[1]:
            if name == "a":
                links = max(0, links - 1)
            elif name not in INLINE and name not in SKIPPED:
                for up in range(len(stack) - 1, 0, -1):
                    if nodes[stack[up]].tag == name:
                        flush()
                        del stack[up:]
                        links = 0
                        break
            continue
        if name in SKIPPED:
            end = _CLOSE[name].search(page, at)
            if end:
                at = end.end()
            elif name in RAW:
                at = size
            text.append((" ", False))
        elif name in INLINE:
            if name == "a":
                links += 1
            elif name in SPACED:
                text.append((" ", False))
        else:
            flush()
            links = 0
            close(CLOSED_BY_BLOCK, ())
            if name in CLOSES:
                close(*CLOSES[name])
            if name in ("html", "body"):
                # The real ones are no part of an implied one.
                if nodes[stack[-1]].tag == IMPLIED:
                    stack.pop()
            elif name != "head":
                imply_body()
            words, label = _signs(match[3]) if match[3] else (frozenset(), None)
            if not labelled:
                label = None
            nodes.append(Node(name, stack[-1], words, label))
            stack.append(len(nodes) - 1)
    flush()
    return nodes


def features(node: Node) -> list[str]:
    """The signs of a node, as names; its tag speaks through the potentials."""
    out = [f"word:{word}" for word in node.words]
    if node.letters:
        size = next((n for n in (20, 60, 150, 400) if node.letters < n), 1000)
        share = node.linked / node.letters
        out.append(f"text:{size}")
        out.append("links:" + ("none" if share == 0 else "some" if share < 0.5 else "most"))
        out.append(f"ends:{node.parts[-1][1][-1] in '.!?…:;'}")
    return out


def labels(nodes: list[Node]) -> list[int] | None:
    """What the page says about itself: explicit labels, or else its semantic markup.

    Without either, None.
    """
    explicit = any(node.label is not None for node in nodes)
    if not explicit and not any(node.tag in CONTENT_TAGS for node in nodes):
        return None
    out: list[int] = []
    for node in nodes:
        above = out[node.parent] if node.parent >= 0 else 0
        if explicit and node.tag == IMPLIED:
            out.append(1)  # a labelled fragment is one of an article
        elif explicit:
            out.append(above if node.label is None else int(node.label == "1"))
        elif node.tag in REJECTED_TAGS or node.words & REJECTED_WORDS:
            out.append(0)
        else:
            # Once inside the content, or at its root.
            root = node.tag in CONTENT_TAGS and not (
                node.parent >= 0 and _rejected_above(nodes, node.parent)
            )
            out.append(int(above or root))
    return out


def _rejected_above(nodes: list[Node], at: int) -> bool:
    while at >= 0:
        if nodes[at].tag in REJECTED_TAGS or nodes[at].words & REJECTED_WORDS:
            return True
        at = nodes[at].parent
    return False


def count_page(nodes: list[Node], truth: list[int]) -> Counter:
    """(kind, name, parent's label, label) of all nodes."""
    counts: Counter = Counter()
    for node, label in zip(nodes, truth, strict=True):
        if node.parent < 0:
            continue
        above = truth[node.parent]
        counts["edge", node.tag, above, label] += 1
        counts["pair", f"{nodes[node.parent].tag} {node.tag}", above, label] += 1
        counts["node", "", 0, label] += 1
        for name in features(node):
            counts["sign", name, 0, label] += 1
    return counts


@dataclass
class Model:
    signs: dict[str, float]  # log-likelihood ratio of each sign
    #: Chance of content by the parent's and own tag, or by the own one, under non-content / content.
    edges: dict[str, tuple[float, float]]
    other: tuple[float, float]  # the same for unknown tags

    def chance(self, above: str, tag: str) -> tuple[float, float]:
        return self.edges.get(f"{above} {tag}") or self.edges.get(tag) or self.other


def fit(sets: list[Counter]) -> Model:
    """A model from the counts of the built-in layouts and of the corpus sample."""
    total: Counter = Counter()
    for counts, weight in zip(sets, TRAIN_WEIGHTS, strict=False):
        nodes = sum(n for key, n in counts.items() if key[0] == "node")
        for key, n in counts.items():
            total[key] += n * weight / max(1, nodes)
    of = [total["node", "", 0, label] for label in (0, 1)]
    names = {key[1] for key in total if key[0] == "sign"}
    signs = {}
    for name in names:
        seen = [
            (total["sign", name, 0, label] + SMOOTHING) / (of[label] + 2 * SMOOTHING)
            for label in (0, 1)
        ]
        signs[name] = log(seen[1] / seen[0])
    sums: Counter = Counter()
    for key, n in total.items():
        if key[0] == "edge":
            sums[key[2:]] += n

    def shrunk(kind: str, name: str, prior: tuple[float, float]) -> tuple[float, float]:
        chances = []
        for above in (0, 1):
            not_content, content = (total[kind, name, above, label] for label in (0, 1))
            chances.append(
                (content + SHRINKAGE * prior[above]) / (content + not_content + SHRINKAGE)
            )
        return chances[0], chances[1]

    other = tuple(
        (sums[above, 1] + SMOOTHING) / (sums[above, 0] + sums[above, 1] + 2 * SMOOTHING)
        for above in (0, 1)
    )
    # A tag's chance is shrunk towards that of all tags, a pair's towards that of its tag.
    names = {kind: {key[1] for key in total if key[0] == kind} for kind in ("edge", "pair")}
    edges = {tag: shrunk("edge", tag, other) for tag in names["edge"]}
    edges |= {pair: shrunk("pair", pair, edges[pair.split()[1]]) for pair in names["pair"]}
    return Model(signs, edges, other)


def _log_sum(low: float, high: float, odds: float) -> float:
    """log(low + high * e^odds), safely for large odds."""
    if odds > 0:
        return odds + log(high + low * exp(-odds))
    return log(low + high * exp(odds))


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """The log-odds of each node being content, by sum-product over the tree; exact.

    The page node is non-content by definition.
    """
    own = [sum(model.signs.get(name, 0.0) for name in features(node)) for node in nodes]
    chances = [model.chance(nodes[node.parent].tag, node.tag) for node in nodes]
    below = list(own)  # signs of a node and all messages from its children
    upward = [0.0] * len(nodes)
    for at in range(len(nodes) - 1, 0, -1):
        under0, under1 = chances[at]
        upward[at] = _log_sum(1 - under1, under1, below[at]) - _log_sum(
            1 - under0, under0, below[at]
        )
        below[nodes[at].parent] += upward[at]
    belief = list(below)
    belief[0] = float("-inf")
    for at in range(1, len(nodes)):
        under0, under1 = chances[at]
        rest = belief[nodes[at].parent] - upward[at]
        if rest == float("-inf"):
            downward = log(under0) - log1p(-under0)
        else:
            downward = _log_sum(under0, under1, rest) - _log_sum(1 - under0, 1 - under1, rest)
        belief[at] = below[at] + downward
    return belief


def main_text(page: str | None, model: Model) -> str:
    """The content blocks of a page, in page order; a page without any element is one block."""
    nodes = parse(page or "")
    if all(node.tag == IMPLIED for node in nodes[1:]):
        return "\n\n".join(run for node in nodes for _, run in node.parts)
    runs = [
        part
        for node, odds in zip(nodes, marginals(nodes, model), strict=True)
        if odds > 0
        for part in node.parts
    ]
    return "\n\n".join(run for _, run in sorted(runs))


def train(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> Model:
    """The model from the corpus sample and the built-in layouts.

    The sample is the pages with semantic markup whose id has the smallest hashes, ``train_pages`` of
    them (or a few more on equal hashes). Only counts reach the driver.
    """
    order = F.xxhash64("page_id")
    marked = pages.filter(F.expr("html ilike '%<article%' or html ilike '%<main%'"))
    limit = (
        marked.select(order.alias("h")).orderBy("h").limit(train_pages).agg(F.max("h")).first()[0]
    )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                nodes = parse(page)
                truth = labels(nodes)
                if truth is not None:
                    counts += count_page(nodes, truth)
        keys = list(counts)
        arrays = [pa.array([key[i] for key in keys]) for i in range(4)]
        arrays = [arrays[0].cast(pa.string()), arrays[1].cast(pa.string())] + [
            a.cast(pa.int64()) for a in arrays[2:]
        ]
        arrays.append(pa.array([counts[key] for key in keys], pa.int64()))
        yield pa.RecordBatch.from_arrays(arrays, names=["kind", "name", "above", "label", "n"])

    corpus: Counter = Counter()
    if limit is not None:
        table = (
            marked.filter(order <= limit)
            .select("html")
            .mapInArrow(task, "kind string, name string, above long, label long, n long")
            .groupBy("kind", "name", "above", "label")
            .agg(F.sum("n").alias("n"))
            .collect()
        )  # signs of a bounded sample
        for row in table:
            corpus[row["kind"], row["name"], row["above"], row["label"]] = row["n"]
    built_in: Counter = Counter()
    for page in labelled_pages():
        nodes = parse(page, labelled=True)
        built_in += count_page(nodes, labels(nodes))
    return fit([built_in, corpus])


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    NULL and empty pages have an empty text. Repeated rows come out repeatedly. Only these three
    columns are read. An empty table gives an empty result.
    """
    schema = T.StructType(
        [
            pages.schema["page_id"],
            pages.schema["url"],
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, model) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=schema.names,
            )

    return pages.select("page_id", "url", "html").mapInArrow(task, schema)
