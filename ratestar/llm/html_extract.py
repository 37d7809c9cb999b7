"""Main text of web pages by minimum-cut labelling of their blocks (operator 3).

A page becomes a row of text blocks, each with the elements it stands in. A
linear classifier gives each block a score from many features: the kinds of its
elements, their names (weighed against names that speak for content, by how far up they
stand and by how much of the page's text they hold), its links and its length. The scores are the
capacities to the two terminals, content and boilerplate. Neighbouring blocks, and
blocks of one container, are tied by edges that weaken with their distance in the
document tree. The maximum flow between the terminals is the cheapest way to
part them: a short paragraph between two sure ones stays with them, an advert
among paragraphs does not.

No single name decides: a long paragraph of an article outweighs any, and an element that
holds most of a page's text is not boilerplate for its name while nothing else looks like the content.

Pages are labelled one by one within a map over Arrow batches; nothing is shuffled.
Parsing takes time in proportion to the page, whatever its markup.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ratestar.llm.min_cut import source_side
from ratestar.llm.package import ship

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, or never shown: all up to their end tag is left out.
_SKIPPED = frozenset("script style textarea title noscript template iframe object svg math canvas audio video noframes xmp".split())
_INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s
    samp small span strike strong sub sup time tt u var wbr""".split())
#: Start tags that end an open element of the same kind.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}}
_KEEPS_OPEN = frozenset("ul ol dl table section article div body html nav aside main header footer form".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)""", re.S | re.X)
#: A name with or without a value, so that the scan moves on behind every name.
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]++)))?""")
_NAME_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")

# Weights of the classifier, in units of evidence for content.
_ELEMENT_WEIGHT = {
    "article": 5.0, "main": 4.0, "p": 1.5, "blockquote": 1.0, "pre": 1.0, "h1": 1.5, "h2": 1.0, "h3": 1.0, "h4": 0.5, "figure": 0.5,
    "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0, "dialog": -9.0, "select": -9.0, "button": -9.0,
    "header": -4.0, "address": -2.0, "fieldset": -6.0}
#: Words of names that tell of boilerplate, and such as have other meanings too, which count for less.
_NEGATIVE_NAMES = dict.fromkeys("""ad ads adv advert adverts advertisement advertisements advertorial banner sponsor sponsored sponsors promo
    promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar comment comments
    disqus reply replies cookie cookies consent gdpr popup modal newsletter subscribe subscription signup login
    share sharing related recommended recommendations widget widgets pagination pager""".split(), 1.0) | dict.fromkeys("""side rail respond
    discussion notice notices alert notification overlay social follow more trending popular tags meta byline copyright legal disclaimer
    search skip hidden print""".split(), 0.4)
_POSITIVE_NAMES = frozenset("article content entry main post story text body prose".split())
#: Words that say nothing of what an element holds.
_PLAIN_NAMES = frozenset("""area bar block box col column container group holder inner item items left level link links list outer panel right
    row section slot top bottom unit wrap wrapper""".split())
_NEGATIVE_ROLES = frozenset("""navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog
    status""".split())
_NEGATIVE_NAME, _POSITIVE_NAME, _HIDDEN = -8.0, 2.0, -12.0
#: Evidence of a name on an element for each level that a block stands below it.
_PER_LEVEL = 0.95
_BIAS, _PER_WORD, _MOST_FOR_WORDS, _LINKS = -1.0, 0.05, 3.0, -4.0
#: Characters without links elsewhere that look like the content; with fewer, and fewer than a tenth of the
#: page, an element's own share of the page counts.
_ELSEWHERE = 40
#: Ties: between neighbours, and between a block and its container; each halves per step in the tree.
_NEIGHBOUR, _CONTAINER, _FARTHEST = 1.5, 0.75, 24


@dataclass(eq=False)
class _Element:
    name: str
    parent: "_Element | None"
    depth: int
    in_article: bool
    kind: float = 0.0  # evidence of the kind of element and its role
    names: float = 0.0  # evidence of its names
    anchor: bool = False  # looks like the content itself
    #: The nearest p, and the nearest element that a sibling ends, up to the next container.
    open_p: "_Element | None" = None
    open_item: "_Element | None" = None
    prose: int = 0  # characters without links
    anchored: int = 0  # of those the ones in an anchor
    weight: float = 0.0
    name_weight: float = 0.0
    hub: int = -1


@dataclass
class Block:
    """A run of text between borders of block elements."""

    element: _Element
    pieces: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""

    def score(self) -> float:
        words = self.text.count(" ") + 1
        linked = min(1.0, self.link_chars / max(1, len(self.text)))
        return _BIAS + self.element.weight + self.element.name_weight + min(_MOST_FOR_WORDS, _PER_WORD * words) + _LINKS * linked


def _judge_names(value: str) -> tuple[float, float]:
    """How much the words of a class or id tell of boilerplate and of content, each from 0 to 1.

    The strongest name counts; a word counts for less in a compound with others.
    """
    negative = positive = 0.0
    for name in value.split():
        parts = [x for x in map(str.lower, _NAME_PART.findall(name)) if x not in _PLAIN_NAMES]
        if parts:
            negative = max(negative, sum(_NEGATIVE_NAMES.get(x, 0.0) for x in parts) / len(parts))
            positive = max(positive, sum(x in _POSITIVE_NAMES for x in parts) / len(parts))
    return negative, positive


def _describe(element: _Element, attributes: str) -> None:
    """Evidence of an element's kind, role and names by themselves."""
    name, parent = element.name, element.parent
    element.kind = _ELEMENT_WEIGHT.get(name, 0.0)
    element.anchor = name in ("article", "main")
    if name in ("header", "article", "main") and parent.in_article:
        element.kind = 0.0
    if name in ("p", "h1", "h2", "h3", "h4") and parent.name == name:
        element.kind = 0.0
    if not attributes or attributes.isspace() or name in ("html", "body", "a"):
        return
    negative = positive = 0.0
    for match in _ATTRIBUTE.finditer(attributes):
        key, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if key in ("class", "id"):
            found = _judge_names(value)
            negative, positive = max(negative, found[0]), max(positive, found[1])
        elif key == "role":
            element.kind += _NEGATIVE_NAME if value.lower() in _NEGATIVE_ROLES else _ELEMENT_WEIGHT["main"] if value.lower() == "main" else 0.0
            element.anchor |= value.lower() == "main"
        elif key == "itemprop" and value == "articleBody":
            element.kind += _ELEMENT_WEIGHT["main"]
            element.anchor = True
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            element.names += _HIDDEN
    # Where both kinds of names meet, the one tells little against the other.
    element.names += _NEGATIVE_NAME * negative * (1 - 0.8 * positive) + _POSITIVE_NAME * positive * (1 - negative)
    element.anchor |= positive > negative


def _weigh(elements: list[_Element], blocks: list["Block"]) -> None:
    """Evidence for each element from all it stands in; an element comes before those in it."""
    for block in blocks:
        block.element.prose += max(0, len(block.text) - block.link_chars)
    inside = {}
    for element in elements:
        inside[element] = element.anchor or (element.parent is not None and inside[element.parent])
        element.anchored = element.prose if inside[element] else 0
    for element in reversed(elements):
        if element.parent is not None:
            element.parent.prose += element.prose
            element.parent.anchored += element.anchored
    page = elements[0]
    for element in elements[1:]:
        kind, names = element.kind, element.names
        if page.anchored - element.anchored < min(_ELSEWHERE, 0.1 * page.prose):
            # Nothing else looks like the content: what holds most of the text may be it, whatever it is called.
            rest = 1 - (element.prose / page.prose) ** 2
            kind, names = (kind * rest if kind < 0 else kind), (names * rest if _HIDDEN < names < 0 else names)
        element.weight = element.parent.weight + kind
        element.name_weight = _PER_LEVEL * element.parent.name_weight + names


def parse_blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order, with white space and character references resolved."""
    root = _Element("", None, 0, False)
    elements, opened = [root], {}
    top, block, blocks = root, Block(root), []
    links, at, size = 0, 0, len(page)

    def close_block() -> None:
        nonlocal block
        if block.pieces:
            blocks.append(block)
        block = Block(top)

    def close_up_to(element: _Element) -> None:
        """Ends all open elements from the innermost to this one."""
        nonlocal top
        while True:
            opened[top.name] -= 1
            top, done = top.parent, top is element
            if done:
                return

    def text(piece: str) -> None:
        if not piece:
            return
        if not block.pieces:
            if piece.isspace():
                return
            block.element = top
        if "&" in piece:
            piece = html.unescape(piece)
        block.pieces.append(piece)
        if links:
            block.link_chars += len(piece)

    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            text(page[at:])
            break
        text(page[at:token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            if token[0].startswith("<![CDATA["):
                text(token[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if token["end"]:
            if name == "a":
                links = max(0, links - 1)
            if name in _INLINE:
                continue
            close_block()
            if opened.get(name):
                found = top
                while found.name != name:
                    found = found.parent
                close_up_to(found)
            block = Block(top)
            continue
        if name in _SKIPPED:
            close_block()
            if name in ("svg", "math") and token[0].endswith("/>"):
                continue
            end = _skip_to(name).search(page, at)
            at = end.end() if end else size
            continue
        if name == "a":
            links += 1
        if name in _INLINE:
            continue
        close_block()
        if name in _VOID:
            continue
        # A block ends an open paragraph, an item the one before it.
        found = top.open_p
        item = top.open_item if name in _ENDS else None
        while item is not None and item.name not in _ENDS[name]:
            item = item.parent.open_item
        if item is not None and (found is None or item.depth < found.depth):
            found = item
        if found is not None:
            close_up_to(found)
        top = _Element(name, top, top.depth + 1, top.in_article or name in ("article", "main"))
        if name == "p":
            top.open_p, top.open_item = top, top.parent.open_item
        elif name in _ENDS:
            top.open_p, top.open_item = top.parent.open_p, top
        elif name not in _KEEPS_OPEN:
            top.open_p, top.open_item = top.parent.open_p, top.parent.open_item
        _describe(top, token["attributes"])
        elements.append(top)
        opened[name] = opened.get(name, 0) + 1
        block = Block(top)
        links = 0
    close_block()
    for own in blocks:
        own.text = " ".join("".join(own.pieces).split())
    blocks = [own for own in blocks if own.text]
    _weigh(elements, blocks)
    return blocks


@functools.cache
def _skip_to(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)


def _distance(a: _Element, b: _Element) -> int:
    """Steps in the tree between two elements, _FARTHEST at most."""
    steps = 0
    while a is not b and steps < _FARTHEST:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def label_blocks(blocks: list[Block]) -> list[bool]:
    """For each block whether it is content."""
    scores = [b.score() for b in blocks]
    edges = []
    for i in range(len(blocks) - 1):
        edges.append((i, i + 1, _NEIGHBOUR * 0.5 ** max(0, _distance(blocks[i].element, blocks[i + 1].element) - 2)))
    hubs: list[_Element] = []
    for i, own in enumerate(blocks):
        container = own.element.parent or own.element
        if container.hub < 0:
            container.hub = len(scores)
            scores.append(0.0)
            hubs.append(container)
        edges.append((i, container.hub, _CONTAINER))
    for container in hubs:
        container.hub = -1
    return source_side(scores, edges)[:len(blocks)]


def main_text(page: str | None) -> str:
    """The content blocks of a page, joined by one space; null is an empty page."""
    blocks = parse_blocks(page or "")
    return " ".join(block.text for block, content in zip(blocks, label_blocks(blocks)) if content)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Puts the main text of each whole page in the place of its html.

    Pages that are null, empty or without content give the empty string. Other
    columns stay, repeated rows too; one named like text_col is replaced. Empty
    tables give empty results. A very long page is labelled as a whole, like any other.
    """
    ship(pages.sparkSession)
    keep = [f for f in pages.schema if f.name not in (html_col, text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x.as_py()) for x in batch.column(batch.schema.get_field_index(html_col))]
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string())], names=[*(f.name for f in keep), text_col])

    return pages.mapInArrow(run, T.StructType([*keep, T.StructField(text_col, T.StringType())]))


def op3_html_extract(spark, sf_dir: str) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
