"""Main text of web pages by the paths that a host's pages agree on.

Each page is read into containers: elements that hold blocks of text. A
container scores by the text of its whole subtree, less links and less what
stands beside an article by tag or name. A page votes for its deepest container
that loses no text: the walk goes down from the top while one path holds all of
the text, or nearly all of it and an article element, and stops at an article, at
a headline and wherever text stands directly in the container. Paths are generalised to tags and classes without
numbers, so pages of one template share them. In Spark the votes are summed per
host; the path with most is the host's. Pages are then read again and the text is
taken from the containers on the winning path; a page without one, or with next
to nothing on it, gives the container it would have voted for.

What names say is doubted: html, body, main and article never stand beside
themselves, nor does a container with the article or headline in it that holds
most of the page's text. A page is scanned once, in time that grows with its length.
"""

from __future__ import annotations

import html as entities
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.sizes import broadcast_if_small
from .common import prepare, stored

# Elements that end a block, that hold no text to read, and that stand beside an article.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
SILENT_TAGS = frozenset("script style template noscript head iframe svg object textarea select button".split())
BESIDE_TAGS = frozenset("nav header footer aside form menu dialog search".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th tr".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Words in a class, id or role that mark what stands beside an article.
BESIDE_NAMES = regex.compile(
    r"(?:^|[\s_-])(?:nav(?:bar|igation)?|menu|header|masthead|footer|side-?bar|aside|widget|ads?|advert\w*|banner|"
    r"promo\w*|sponsor\w*|cookies?|consent|notice|notification|alert|popup|modal|overlay|newsletter|subscri\w*|"
    r"social|share|sharing|related|recommend\w*|breadcrumbs?|pagination|pager|comments?|disqus|replies|respond|"
    r"login|signup|search|(?:reader|user|visitor)s?[_-]?(?:feedback|reactions?|responses?|opinions?|discussion)|discussion)"
    r"(?:$|[\s_-])",
    regex.IGNORECASE,
)
#: Elements that are never beside the article, and those that are one.
TOP_TAGS = frozenset("html body main article".split())
ARTICLE_TAGS = frozenset("article main".split())

#: Share of the text a path with an article element must hold for the walk to go down to it; any other must hold all.
NEARLY_ALL = 0.9

_NAME = regex.compile(r"[a-zA-Z][^\s/>]*+")
_STOP = regex.compile(r"[>\"']")
_ATTRIBUTE = regex.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]++)))?+")
_SPACE = regex.compile(r"[\s\u00a0]+")
_DIGITS = regex.compile(r"\d+")


@dataclass(slots=True)
class Node:
    """An element that ends blocks: its path, whether tag or name set it beside the article, its blocks with their place
    on the page, how much of them is links, and whether it is an article or holds a headline."""

    tag: str
    path: str
    beside: bool
    parent: int
    core: bool = False
    blocks: list[tuple[int, str]] = field(default_factory=list)
    links: int = 0


def _names(attributes: str) -> str:
    if "=" not in attributes:
        return ""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    return " ".join(found[k] for k in ("class", "id", "role") if found.get(k))


def _tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Markup of a page as ``start, end, tag, closing, attributes``; the tag is empty for comments, ``cdata`` for such a section.

    An unclosed quote is ordinary text of a tag; a tag, comment or section that
    never ends is text, but for a comment, which takes the rest of the page.
    """
    at, last = 0, {c: page.rfind(c) for c in ">\"'"}
    while (start := page.find("<", at)) >= 0 and start < last[">"]:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            end = end + 3 if end >= 0 else len(page)
            yield start, end, "", False, ""
        elif page.startswith("<![CDATA[", start) and (end := page.find("]]>", start)) >= 0:
            end += 3
            yield start, end, "cdata", False, page[start + 9 : end - 3]
        elif page.startswith(("<!", "<?"), start):
            end = page.find(">", start) + 1
            yield start, end, "", False, ""
        else:
            closing = page.startswith("</", start)
            name = _NAME.match(page, start + 1 + closing)
            if not name:
                at = start + 1
                continue
            end = name.end()
            while True:
                stop = _STOP.search(page, end)
                if stop is None:  # the last > stands inside a quote: what follows is text
                    return
                end = stop.end()
                if stop[0] == ">":
                    break
                if last[stop[0]] >= end:
                    end = page.find(stop[0], end) + 1
            yield start, end, name[0].lower(), closing, page[name.end() : end - 1]
        at = end


def _step(tag: str, names: str) -> str:
    """Tag with its classes, sorted, digits left out: what pages of one template share."""
    if not names:
        return tag
    classes = sorted({_DIGITS.sub("", c) for c in names.lower().split()} - {""})
    return ".".join([tag, *classes])


def _below(path: str, step: str) -> str:
    """A path as 16 hex digits, whatever its depth."""
    return f"{xxhash.xxh64_intdigest(f'{path}/{step}'):016x}"


def parse(page: str) -> list[Node]:
    """Containers of a page in the order they open; text outside of any goes to the first.

    Unclosed elements end with the element around them, an open paragraph with
    the next block; an end tag without its start is passed over.
    """
    nodes = [Node("", "", False, -1)]
    stack: list[tuple[str, int]] = [("", 0)]
    opened: dict[str, int] = {}
    endless: set[str] = set()
    text: list[str] = []
    links = place = linked = at = 0

    def flush() -> None:
        nonlocal links, place
        if not text:
            links = 0
            return
        block = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
        text.clear()
        if block:
            node = nodes[stack[-1][1]]
            node.blocks.append((place, block))
            node.links += min(links, len(block))
            place += 1
        links = 0

    def take(part: str) -> None:
        nonlocal links
        text.append(part)
        if linked:
            links += len(part)

    def push(tag: str, node: int) -> None:
        stack.append((tag, node))
        opened[tag] = opened.get(tag, 0) + 1

    def pop() -> str:
        tag = stack.pop()[0]
        opened[tag] -= 1
        return tag

    for start, end, tag, closing, attributes in _tags(page):
        if start < at:
            continue
        if start > at:
            take(page[at:start])
        at = end
        if tag == "cdata":
            take(entities.escape(attributes))
        elif tag in SILENT_TAGS and not closing and not attributes.rstrip().endswith("/"):
            # Skip to the end tag; what holds no text is never read.
            found = None
            if tag not in endless:
                found = regex.compile(rf"</{regex.escape(tag)}\s*+>", regex.IGNORECASE).search(page, at)
            flush()
            if found:
                at = found.end()
            else:
                endless.add(tag)
                at = len(page) if tag in ("script", "style") else at
        elif tag == "a":
            linked = max(0, linked - 1) if closing else linked + 1
        elif tag == "br":
            take(" ")
        elif tag in BLOCK_TAGS:
            flush()
            if tag in VOID_TAGS:
                continue
            if closing:
                if opened.get(tag):
                    while pop() != tag:
                        pass
                continue
            if stack[-1][0] == "p" or (stack[-1][0] == tag and tag in ("li", "dt", "dd", "tr", "td", "th")):
                pop()
            parent = stack[-1][1]
            names = _names(attributes)
            named = bool(names and BESIDE_NAMES.search(names))
            if tag == "h1":
                nodes[parent].core = True
            if tag in TEXT_TAGS and not named:
                # Blocks of text proper belong to the container around them, unless marked as standing beside.
                push(tag, parent)
                continue
            above = nodes[parent]
            beside = tag not in TOP_TAGS and (named or tag in BESIDE_TAGS and not (tag == "header" and above.tag in ARTICLE_TAGS))
            # Pages that leave out the outermost tags share paths with those that do not.
            path = above.path if tag in ("html", "body") else _below(above.path, _step(tag, names))
            nodes.append(Node(tag, path, beside, parent, tag in ARTICLE_TAGS))
            push(tag, len(nodes) - 1)
    if at < len(page):
        take(page[at:])
    flush()
    return nodes


@dataclass(slots=True)
class Weights:
    """Of every container: whether it stands beside the article, the text of its subtree that does not, less links, and
    whether an article or headline, or an article element, is in it."""

    beside: list[bool]
    text: list[int]
    core: list[bool]
    article: list[bool]


def weigh(nodes: list[Node]) -> Weights:
    """Marks are taken back from containers that hold an article or headline and most of the page's text.

    A page of which nothing is left then is all text, but for what tags set beside.
    """
    core = [n.core for n in nodes]
    article = [n.tag in ARTICLE_TAGS for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        core[nodes[i].parent] |= core[i]
        article[nodes[i].parent] |= article[i]
    # What is marked and holds no article is no part of the page's text here, however long, as comments are.
    outside = [n.beside and not core[i] for i, n in enumerate(nodes)]
    for i in range(1, len(nodes)):
        outside[i] |= outside[nodes[i].parent]
    everything = [0 if outside[i] else sum(len(b) for _, b in n.blocks) for i, n in enumerate(nodes)]
    for i in range(len(nodes) - 1, 0, -1):
        everything[nodes[i].parent] += everything[i]
    named = [n.beside and not (core[i] and 2 * everything[i] > everything[0]) for i, n in enumerate(nodes)]
    tagged = [named[i] and n.tag in BESIDE_TAGS for i, n in enumerate(nodes)]
    for marks in (named, tagged):
        beside = list(marks)
        text = [0] * len(nodes)
        for i in range(1, len(nodes)):
            beside[i] |= beside[nodes[i].parent]
        for i in range(len(nodes) - 1, -1, -1):
            n = nodes[i]
            if not beside[i]:
                text[i] += max(sum(len(b) for _, b in n.blocks) - 2 * n.links, 0)
            if i:
                text[n.parent] += text[i]
        if text[0]:
            break
    return Weights(beside, text, core, article)


def chosen(nodes: list[Node], weights: Weights) -> list[int]:
    """The containers, all on one path, that hold the page's article; none on a page without text."""
    if not weights.text[0]:
        return []
    below: list[list[int]] = [[] for _ in nodes]
    for i, n in enumerate(nodes[1:], 1):
        if not weights.beside[i]:
            below[n.parent].append(i)
    held = [0]
    while True:
        if any(nodes[i].tag in ARTICLE_TAGS or nodes[i].core or nodes[i].blocks for i in held):
            return held
        groups: dict[str, list[int]] = {}
        for i in held:
            for j in below[i]:
                groups.setdefault(nodes[j].path, []).append(j)
        if not groups:
            return held
        best = max(groups, key=lambda p: (sum(weights.text[j] for j in groups[p]), p))
        share = NEARLY_ALL if any(weights.article[j] for j in groups[best]) else 1.0
        if sum(weights.text[j] for j in groups[best]) < share * weights.text[0]:
            return held
        held = groups[best]


def _outranked(nodes: list[Node], weights: Weights, held: list[int], own: list[int]) -> bool:
    """Whether the page's own choice holds so much more than the host's path that the path cannot be its article.

    Four times as much for an article or headline, twenty times and a thousand characters for any container.
    """
    on_path, mine = (sum(weights.text[i] for i in some) for some in (held, own))
    core = any(weights.core[i] for i in own) and not any(weights.core[i] for i in held)
    return mine > 4 * on_path if core else mine > 20 * on_path and mine >= 1000


def main_text(nodes: list[Node], path: str | None) -> str:
    """Blocks in page order of the containers on ``path`` and of those inside them that do not stand beside the article."""
    weights = weigh(nodes)
    own = chosen(nodes, weights)
    held = [i for i, n in enumerate(nodes) if n.path == path and not weights.beside[i]] if path is not None else []
    if not any(weights.text[i] for i in held) or _outranked(nodes, weights, held, own):
        held = own
    inside = [False] * len(nodes)
    for i in held:
        inside[i] = True
    blocks = []
    for i, n in enumerate(nodes):
        inside[i] |= i > 0 and inside[n.parent]
        if inside[i] and not weights.beside[i]:
            blocks += n.blocks
    return "\n".join(b for _, b in sorted(blocks))


def host(column: str = "url") -> Column:
    """Host of an address in lower case, empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(column), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """``host``, ``path``: the container path with most votes on each host.

    Every page with text has one vote. Votes are summed per task before they are
    shuffled, so a host with many pages is a few rows.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes: dict[tuple[str, str], int] = {}
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                nodes = parse(page)
                for i in chosen(nodes, weigh(nodes))[:1]:
                    votes[name, nodes[i].path] = votes.get((name, nodes[i].path), 0) + 1
            columns = [[k[0] for k in votes], [k[1] for k in votes], list(votes.values())]
            types = [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["host", "path", "votes"])

    cast = pages.select(host().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    votes = cast.mapInArrow(vote, "host string, path string, votes long")
    votes = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return votes.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("path"))


def page_texts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` per row of ``pages``.

    A null page counts as empty and gives an empty text; pages without a host
    share one of an empty name. Rows may be repeated; of paths with equal votes
    the last by its digest wins. Other columns are ignored; an empty
    table gives an empty result.
    """
    prepare(pages.sparkSession)

    @F.arrow_udf("string")
    def extract(html: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array([main_text(parse(h), p) for h, p in zip(html.to_pylist(), paths.to_pylist())], pa.string())

    # One row per host: sent to the pages if it is measured to be small, shuffled with them if not.
    winners = broadcast_if_small(stored(host_paths(pages), "paths").select(F.col("host").alias("_host"), "path"))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host().alias("_host"))
    texts = rows.join(winners, "_host", "left").select("page_id", "url", extract("html", "path").alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
