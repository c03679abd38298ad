"""Main text of web pages by a minimum cut.

A page is read into blocks (the text between block-level tags).  A linear classifier
over a block's own features (containers, names of classes and ids, links, length,
sentence ends) gives it a log-odds score; its two costs become the capacities of its
edges to the terminals "content" and "boilerplate".  Blocks that follow each other and
blocks of one container are joined by smoothness edges, weaker the further apart they lie in
the tree.  The maximum flow splits the graph; blocks on the content side are the text.

Names of classes and ids are judged one by one.  A name that speaks of boilerplate counts against all that its element
holds, unless it is contradicted: a wrapper that also has a good name, or that holds the page's first heading or main
part, is not boilerplate when most of the page's sentences stand in it.  A name that says what a page has or lacks
(``with-sidebar``, ``no-header``) says nothing about the element itself.

Rows are independent, so nothing is shuffled.  Null html gives an empty text; null ids
and urls are passed on; repeated rows give repeated results; an empty table gives none; extra columns of any name are
not looked at.  Pages of any length and depth are read whole: reading takes linear time and memory, and the
flow is only looked for between blocks whose own score does not outweigh all their edges.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import unescape
from math import exp, log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinary.llm.slices import small_batches

# fixed lists of the markup language
_BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
_RAW_TAGS = "script style noscript template textarea iframe svg math object title xmp noframes noembed".split()
_VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# an opening tag ends an open element of these
_ENDED_BY = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "option": ("option",),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
}
_SECTIONS = frozenset(
    "article aside div footer form header main nav section table ul ol dl fieldset figure body html".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(_RAW_TAGS) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_MARKUP_START = re.compile(r"<[!?/]")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE_END = re.compile(r"[.!?…。！？](?:[\"'»”)]*)(?:\s|$)")

# The classifier: log-odds of content.  Fitted by hand on the roles the markup language gives these containers.
_CONTAINER_WEIGHT = {
    "nav": -7.0,
    "aside": -7.0,
    "footer": -6.0,
    "form": -7.0,
    "menu": -6.0,
    "header": -5.0,
    "button": -6.0,
    "select": -7.0,
    "dialog": -6.0,
    "head": -8.0,
    "article": 4.0,
    "main": 3.0,
}
_GOOD_NAMES = frozenset("article post content entry body story main text articlebody".split())
_BAD_NAMES = frozenset(
    "ad ads advert advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead footer sidebar side widget related recommended recommendations more share "
    "sharing social comment comments reply replies respond disqus discussion cookie cookies consent gdpr notice alert "
    "popup modal overlay newsletter subscribe subscription signup login search pagination pager toolbar copyright legal "
    "disclaimer tags skip hidden".split()
)
_LAYOUT_PARTS = frozenset("with has no without is".split())  # what follows them is what the page has or lacks
_GOOD_NAME_WEIGHT, _BAD_NAME_WEIGHT, _BAD_IN_ARTICLE_WEIGHT = 2.0, -6.0, -9.0
_OUTSIDE_WEIGHT = -3.5  # the page has an article or main part and the block is not in it
_LINK_WEIGHT = -3.5  # times the share of characters inside links
_BIAS, _SENTENCE_WEIGHT, _PER_WORD, _MOST_WORDS = -0.6, 0.9, 0.06, 50
_HEADING_WEIGHT = 0.7
_SMOOTH, _DECAY = 1.0, 0.6  # strength of an edge, and its factor per step in the tree


class _Element:
    """An open element: what it and the elements around it say about the blocks in it."""

    __slots__ = ("tag", "parent", "depth", "own", "bad", "doubted", "inside", "words", "weight")

    def __init__(self, tag: str, parent: _Element | None, own: float = 0.0, bad: float = 0.0, doubted: bool = False):
        self.tag = tag
        self.parent = parent
        self.depth = parent.depth + 1 if parent else 0
        self.own = own  # log-odds of its tag and its good names
        self.bad = bad  # log-odds of its bad names
        self.doubted = doubted  # whether something speaks against its bad names
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.words = 0  # words of sentences in it
        self.weight = 0.0


@dataclass
class Block:
    text: str
    element: _Element
    score: float


def _names(rest: str) -> tuple[bool, bool]:
    """Whether an element's attributes have a good and a bad name."""
    good = bad = False
    for name, *values in _ATTRIBUTE.findall(rest):
        value = next((v for v in values if v), "")
        name = name.lower()
        if name in ("hidden",) or name == "aria-hidden" and value == "true":
            bad = True
        elif name == "style":
            bad |= "display:none" in value.replace(" ", "").lower()
        else:
            for word in value.split():
                parts = {part.lower() for part in _NAME_PART.findall(word)}
                if not parts & _LAYOUT_PARTS:
                    good |= bool(parts & _GOOD_NAMES)
                    bad |= bool(parts & _BAD_NAMES)
    return good, bad


def _is_open(match: re.Match[str]) -> bool:
    """Whether a comment or raw element has no end."""
    if match["raw"] is None:
        return match[0].startswith("<!--") and not match[0].endswith("-->")
    return not re.fullmatch(rf"</{match['raw']}\s*>", match[0][match[0].rfind("</") :], re.IGNORECASE)


def _weigh(elements: list[_Element]) -> None:
    """The log-odds that every element gives its blocks; parents come before their children."""
    for element in reversed(elements):
        if element.parent is not None:
            element.parent.words += element.words
    most = elements[0].words / 2
    for element in elements:
        is_wrapper = element.doubted and element.words > most
        element.weight = (element.parent.weight if element.parent else 0.0) + element.own + (0.0 if is_wrapper else element.bad)


def read_blocks(html: str) -> list[Block]:
    """The page's blocks in order, scored."""
    elements = [_Element("", None)]
    stack = [elements[0]]
    open_at: dict[str, list[int]] = {}  # where in the stack the open elements of a tag and of any section are
    pieces: list[str] = []
    linked = 0
    in_link = 0
    raw: list[tuple[str, int, _Element, bool]] = []
    has_main = has_title = heading = False

    def close_block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                raw.append((text, linked, stack[-1], heading))
            pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        pieces.append(text)
        if in_link:
            linked += len(text)

    def pop() -> None:
        nonlocal in_link
        element = stack.pop()
        in_link -= element.tag == "a"
        open_at[element.tag].pop()
        if element.tag in _SECTIONS:
            open_at["section of any tag"].pop()

    at, is_open = 0, False
    tags_end = html.rfind(">") + 1  # no tag ends behind it, so none is looked for there
    for match in _TOKEN.finditer(html, 0, tags_end):
        if match.start() > at:
            add(html[at : match.start()])
        at = match.end()
        tag = match["tag"]
        if tag is None:
            is_open = at == tags_end and _is_open(match)
            if match["raw"] is not None and match["raw"].lower() not in ("svg", "math"):
                close_block()
            continue
        tag = tag.lower()
        if match["end"]:
            if tag in _BLOCK_TAGS:
                close_block()
            heading = heading and not (tag[0] == "h" and tag[1:].isdigit())
            ended, section = open_at.get(tag), open_at.get("section of any tag")
            # an end tag does not reach out of the section it stands in
            if ended and (tag in _SECTIONS or not section or section[-1] < ended[-1]):
                depth = ended[-1]
                while len(stack) > depth:
                    pop()
            continue
        if tag in _VOID_TAGS:
            if tag == "hr":
                close_block()
            else:
                add(" " if tag == "br" else "")
            continue
        if tag in _BLOCK_TAGS:
            close_block()
            # inline elements left open do not reach into the next block
            while len(stack) > 1 and (stack[-1].tag not in _BLOCK_TAGS or stack[-1].tag == "p"):
                pop()
            if stack[-1].tag in _ENDED_BY.get(tag, ()):
                pop()
            heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        parent, rest = stack[-1], match["rest"]
        if rest.endswith("/") and tag not in _BLOCK_TAGS:
            continue
        own = 0.0 if tag == "header" and parent.inside else _CONTAINER_WEIGHT.get(tag, 0.0)
        good = bad = False
        if rest and (tag in _BLOCK_TAGS or tag == "span") and tag not in ("html", "body"):
            good, bad = _names(rest)
        if good and not bad:
            own += _GOOD_NAME_WEIGHT
        against = (_BAD_IN_ARTICLE_WEIGHT if parent.inside else _BAD_NAME_WEIGHT) if bad else 0.0
        element = _Element(tag, parent, own, against, bad and (good or tag == "main"))
        has_main |= tag in ("article", "main")
        if tag == "main" or tag == "h1" and not has_title:
            has_title |= tag == "h1"
            for around in stack:
                around.doubted = around.doubted or around.bad < 0
        in_link += tag == "a"
        open_at.setdefault(tag, []).append(len(stack))
        if tag in _SECTIONS:
            open_at.setdefault("section of any tag", []).append(len(stack))
        elements.append(element)
        stack.append(element)
    if not is_open:
        add(html[at:tags_end] + _MARKUP_START.split(html[tags_end:], maxsplit=1)[0])
    close_block()

    facts = []
    for text, linked, element, is_heading in raw:
        words = text.count(" ") + 1
        link_share = min(1.0, linked / max(1, len(text)))
        has_sentence = _SENTENCE_END.search(text) is not None
        if has_sentence and link_share < 0.5:
            element.words += words
        facts.append((words, link_share, has_sentence))
    _weigh(elements)
    blocks = []
    for (text, _, element, is_heading), (words, link_share, has_sentence) in zip(raw, facts):
        score = _BIAS + element.weight + _PER_WORD * min(words, _MOST_WORDS) + _LINK_WEIGHT * link_share
        score += _SENTENCE_WEIGHT * has_sentence + _HEADING_WEIGHT * is_heading
        score += _OUTSIDE_WEIGHT * (has_main and not element.inside)
        blocks.append(Block(text, element, score))
    return blocks


# an edge over more steps is weaker than the flow can tell
_MOST_STEPS = 64


def _steps(left: _Element, right: _Element) -> int:
    """Steps in the tree between two elements, at least ``_MOST_STEPS`` + 1 if there are more than these."""
    steps = 0
    while left is not right and steps <= _MOST_STEPS:
        if left.depth >= right.depth:
            left = left.parent
        else:
            right = right.parent
        steps += 1
    return steps


def minimum_cut(content: list[float], boiler: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the source's side of a minimum cut.

    ``content[i]`` and ``boiler[i]`` are the capacities source to i and i to sink, edges run both ways.
    Flow straight through each node is pushed first.  A node whose remaining capacity is greater than all
    its edges together lies on that terminal's side of every minimum cut: it becomes part of the
    terminal, and its edges capacities of its neighbours.  The maximum flow settles the others.
    """
    near: list[dict[int, float]] = [{} for _ in content]
    for a, b, capacity in edges:
        near[a][b] = near[a].get(b, 0.0) + capacity
        near[b][a] = near[b].get(a, 0.0) + capacity
    excess = [a - b for a, b in zip(content, boiler)]  # capacity left from the source, or to the sink if negative
    side: list[bool | None] = [None] * len(content)
    waiting = list(range(len(content)))
    while waiting:
        i = waiting.pop()
        if side[i] is None and abs(excess[i]) > sum(near[i].values()) + _TINY:
            side[i] = excess[i] > 0
            for j, capacity in near[i].items():
                del near[j][i]
                excess[j] += capacity if side[i] else -capacity
                waiting.append(j)
            near[i] = {}
    open_nodes = [i for i, settled in enumerate(side) if settled is None]
    _push_flow(open_nodes, excess, near)
    # what the source still reaches is on its side
    reached = [i for i in open_nodes if excess[i] > _TINY]
    for i in reached:
        side[i] = True
    for i in reached:  # grows while it is read
        for j, room in near[i].items():
            if not side[j] and room > _TINY:
                side[j] = True
                reached.append(j)
    return [bool(settled) for settled in side]


_TINY = 1e-12


def _push_flow(nodes: list[int], excess: list[float], near: list[dict[int, float]]) -> None:
    """Move as much as possible from positive to negative excess; ``near[i][j]`` is the room left from i to j.

    In every round the nodes are numbered by their distance to the nearest negative excess, and paths that come one step
    nearer at a time are filled until there are none; so the rounds are as many as there are lengths of paths.
    """
    while True:
        level = {i: 0 for i in nodes if excess[i] < -_TINY}
        queue = list(level)
        for i in queue:  # grows while it is read
            for j in near[i]:
                if j not in level and near[j][i] > _TINY:
                    level[j] = level[i] + 1
                    queue.append(j)
        sources = [i for i in queue if excess[i] > _TINY]
        if not sources:
            return
        # the reached nodes alone matter from here on: the others reach no negative excess any more
        nodes = queue
        left = {i: [j for j in near[i] if level.get(j, -1) == level[i] - 1] for i in queue}
        for source in sources:
            path = [source]
            while path and excess[source] > _TINY:
                i = path[-1]
                if level[i] == 0:
                    if excess[i] < -_TINY:
                        flow = min(excess[source], -excess[i], *[near[a][b] for a, b in zip(path, path[1:])])
                        excess[source] -= flow
                        excess[i] += flow
                        for a, b in zip(path, path[1:]):
                            near[a][b] -= flow
                            near[b][a] += flow
                        # on from the first node whose way on is not full
                        full = next((n for n, (a, b) in enumerate(zip(path, path[1:])) if near[a][b] <= _TINY), len(path) - 1)
                        del path[full + 1 :]
                        continue
                    path.pop()
                    if path:
                        left[path[-1]].pop()
                    continue
                while left[i] and near[i][left[i][-1]] <= _TINY:
                    left[i].pop()
                if left[i]:
                    path.append(left[i][-1])
                    continue
                path.pop()
                if path:
                    left[path[-1]].pop()


def label_blocks(blocks: list[Block]) -> list[bool]:
    """Which blocks are content."""
    edges: dict[tuple[int, int], float] = {}

    def join(a: int, b: int) -> None:
        strength = _SMOOTH * _DECAY ** max(0, _steps(blocks[a].element, blocks[b].element) - 1)
        edges[a, b] = max(edges.get((a, b), 0.0), strength)

    last_in: dict[_Element | None, int] = {}
    for i, block in enumerate(blocks):
        if i:
            join(i - 1, i)
        container = block.element.parent or block.element
        if container in last_in:
            join(last_in[container], i)
        last_in[container] = i
    # the cost of a label is minus its log probability
    content = [log1p(exp(min(30.0, block.score))) for block in blocks]
    boiler = [log1p(exp(min(30.0, -block.score))) for block in blocks]
    return minimum_cut(content, boiler, [(a, b, strength) for (a, b), strength in edges.items()])


def main_text(html: str) -> str:
    """Content blocks joined by line ends."""
    blocks = read_blocks(html)
    return "\n".join(block.text for block, kept in zip(blocks, label_blocks(blocks)) if kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [main_text(html or "") for html in batch.column(2).to_pylist()]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"]
            )

    columns = [F.col("page_id").cast("bigint").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html")]
    return pages.select(*columns).mapInArrow(extracted, "page_id bigint, url string, text string, n_chars bigint")
