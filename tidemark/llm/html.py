"""Main text of HTML pages by minimum-cut labelling of their blocks."""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices

# HTML elements by what they do to the text around or in them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style title textarea iframe noembed noframes noscript xmp".split())
SILENT = frozenset("head template svg math object canvas select datalist audio video map".split())
#: Elements of running text: a button in one of them is a word of the sentence.
RUNNING = frozenset("p li td dd dt blockquote figcaption h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD_ONLY = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
# Words of class, id and role attributes that tell what a part of a page is for.
AROUND = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted nav navbar navigation menu "
    "menubar breadcrumb breadcrumbs pagination pager toc sidebar side aside complementary widget widgets footer foot contentinfo masthead "
    "topbar toolbar header cookie cookies consent gdpr notice alert popup modal overlay dialog newsletter subscribe subscription signup "
    "login signin register search form share sharing social related recommended recommendations comment comments commentlist disqus reply "
    "replies respond discussion copyright legal disclaimer tags taglist skip hidden".split()
)
WITHIN = frozenset("header banner toc tags notice legal disclaimer alert side".split())
NEUTRAL = frozenset(
    "left right top bottom main inner outer wrap wrapper container content box block section area list item items group panel row col column "
    "bar body title text link links button site page global primary secondary post posts entry article blog story field fields thread".split()
)
LIKELY = frozenset("article articles content entry main post story text body page".split())
MAIN_ROLES = frozenset(("main", "article"))

COMMENT = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)", re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]++)))?")
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")

#: Weights of the graph, in thousandths: structure, the bound of what a trained classifier may say, neighbours and containers. What stands
#: against a block, ``OUTSIDE``, is less than prose of its own and two neighbours in the main text can outweigh.
INSIDE, MAYBE_INSIDE, OUTSIDE, TEXT_BOUND = 4000, 1500, -4400, 2500
SAME_PARENT, SAME_GRANDPARENT, APART, CONTAINER = 900, 500, 150, 250
#: A name that says what a part is for among other words counts half. A part with more than half of the page's words that holds the
#: main part, or may, is the page's frame, and its names count next to nothing.
PARTLY, WHOLLY, FRAME = 0.5, 1.0, 0.05


@dataclass(slots=True)
class Block:
    text: str
    words: int
    linked: int
    tag: str
    structure: int
    path: tuple[int, ...]


@dataclass(slots=True)
class Element:
    tag: str
    number: int
    against: tuple[int, ...]
    within: bool
    likely: bool
    link: bool
    silent: bool


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def _around(tag: str, attributes: dict[str, str], within: bool) -> float:
    """How much an element's own tag and attributes say that it stands around the main text: 0, ``PARTLY`` or ``WHOLLY``."""
    if tag in ("nav", "footer", "aside", "menu", "dialog", "search", "form") or tag == "header" and not within or attributes.get("role") == "form":
        return WHOLLY
    if attributes and "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return WHOLLY
    if tag in ("html", "body", "main"):
        return 0.0
    most = 0.0
    for name in " ".join(attributes.get(k, "") for k in ("class", "id", "role")).split() if attributes else ():
        words = {w.lower() for w in WORDS.findall(name)}
        found = AROUND & words
        if found and words.isdisjoint(("has", "with", "no", "without")) and (found - WITHIN or not within and LIKELY.isdisjoint(words)):
            most = max(most, WHOLLY if words - found <= NEUTRAL else PARTLY)
    return most


def _name_words(attributes: dict[str, str]) -> set[str]:
    return {w.lower() for w in WORDS.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")} if attributes else set()


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, with what its structure says about each.

    Tags that never close, close twice or end with the page are taken as browsers take them, as far as text and nesting go. So an open
    head ends where text or an element starts that can't stand in it.
    """
    blocks: list[Block] = []
    stack = [Element("", 0, (), False, False, False, False)]
    opened: Counter[str] = Counter()
    strength: dict[int, float] = {}  # of elements that stand around the main text, by number
    marks: list[tuple[int, ...]] = []  # for each main part or first heading, which of these elements hold it
    above: list[tuple[Element, int]] = []  # for each block, the element it stands in and its words outside of links
    parts: list[str] = []
    linked = number = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                top = stack[-1]
                holders = [e.number for e in stack if e.tag in BLOCKS]
                tag = next((e.tag for e in reversed(stack) if e.tag in BLOCKS), "")
                blocks.append(Block(text, text.count(" ") + 1, min(linked, len(text)), tag, 0, tuple(holders[-4:])))
                above.append((top, round(blocks[-1].words * (1 - blocks[-1].linked / len(text)))))
            parts.clear()
        linked = 0

    def pop_to(tag: str) -> None:
        while len(stack) > 1:
            gone = stack.pop()
            opened[gone.tag] -= 1
            if gone.tag == tag:
                return

    def add(raw: str) -> None:
        nonlocal linked
        if stack[-1].tag == "head" and raw.strip(" \t\n\f\r"):
            pop_to("head")
        if raw and not stack[-1].silent:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if stack[-1].link:
                linked += len(text.strip())

    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        add(page[at:start])
        follows = page[start + 1 : start + 2]
        if follows in ("!", "?") or follows == "/" and not page[start + 2 : start + 3].isalpha():
            at = COMMENT.match(page, start).end()
            continue
        if not (follows.isascii() and follows.isalpha() or follows == "/"):
            add("<")
            at = start + 1
            continue
        found = TAG.match(page, start) or LOOSE_TAG.match(page, start)
        if found is None:  # the page ends inside a tag
            break
        at, tag = found.end(), found[2].lower()
        if stack[-1].tag == "head" and (tag in ("body", "html", "br") if found[1] else tag not in HEAD_ONLY):
            pop_to("head")
        if found[1]:
            if tag in BLOCKS:
                flush()
            if tag == "br":
                add(" ")
            elif opened[tag]:
                pop_to(tag)
            continue
        if tag in BLOCKS:
            flush()
            if opened["p"]:
                pop_to("p")
            if tag in CLOSED_BY and opened[tag]:
                inner = next(e.tag for e in reversed(stack) if e.tag == tag or e.tag in CLOSED_BY[tag])
                if inner == tag:
                    pop_to(tag)
        elif tag in ("br", "img", "wbr", "input"):
            add(" " if tag != "wbr" else "")
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            continue
        holder, attributes = stack[-1], _attributes(found[3])
        number += 1
        main = tag in ("main", "article") or attributes.get("role") in MAIN_ROLES or "articleBody" in attributes.get("itemprop", "")
        against, own = holder.against, _around(tag, attributes, holder.within)
        if own:
            strength[number] = own
            against = (*against, number)
        if main and own < WHOLLY or tag == "h1":
            marks.append(against)
        likely = holder.likely or tag not in ("html", "body") and not LIKELY.isdisjoint(_name_words(attributes))
        silent = holder.silent or tag in SILENT or tag == "button" and not any(e.tag in RUNNING for e in stack)
        stack.append(Element(tag, number, against, holder.within or main, likely, holder.link or tag == "a", silent))
        opened[tag] += 1
    flush()
    words, total = Counter(), sum(own for _, own in above)
    for element, own in above:
        for number in element.against:
            words[number] += own
    for number in strength:
        if 2 * words[number] > total and (not marks or any(number in mark for mark in marks)):
            strength[number] *= FRAME
    for block, (element, _) in zip(blocks, above):
        against = max((strength[number] for number in element.against), default=0.0)
        inside = INSIDE if element.within else MAYBE_INSIDE if element.likely else 0
        block.structure = round(OUTSIDE * against) + (0 if against == WHOLLY else inside)
    return blocks


def features(block: Block) -> tuple[str, ...]:
    """The classifier's view of a block: how much of it is link text, its length, its end and its element."""
    share = block.linked / len(block.text)
    link = 0 if share == 0 else 1 if share <= 1 / 3 else 2 if share <= 0.8 else 3
    length = min(block.words, 64).bit_length()
    kind = "heading" if block.tag in HEADINGS else block.tag if block.tag in ("p", "li", "td", "th", "pre", "blockquote") else "other"
    return f"link{link}", f"length{length}", f"end{int(block.text[-1] in '.!?…:;”\"')}", f"tag-{kind}", f"sign{int(block.text[0] in '©®|»›')}"


def text_score(block: Block, model: dict[str, float]) -> int:
    score = sum(model.get(name, 0.0) for name in features(block))
    return round(1000 * max(-TEXT_BOUND / 1000, min(TEXT_BOUND / 1000, score)))


def edges_of(blocks: list[Block]) -> tuple[int, dict[tuple[int, int], int]]:
    """Number of nodes and weighted edges: neighbours in page order by how near they are in the DOM, and blocks of one container.

    Nodes after the blocks stand for containers; they have no evidence of their own.
    """
    edges: Counter[tuple[int, int]] = Counter()
    for k in range(len(blocks) - 1):
        a, b = blocks[k].path, blocks[k + 1].path
        near = SAME_PARENT if a[-2:-1] == b[-2:-1] or a[-1:] == b[-1:] else SAME_GRANDPARENT if set(a[-3:]) & set(b[-3:]) else APART
        edges[k, k + 1] += near
    members: dict[int, list[int]] = {}
    for k, block in enumerate(blocks):
        for holder in block.path[-2:-1] or block.path[-1:]:
            members.setdefault(holder, []).append(k)
    nodes = len(blocks)
    for group in members.values():
        if len(group) > 2:
            for k in group:
                edges[k, nodes] += CONTAINER
            nodes += 1
    return nodes, edges


def minimum_cut(scores: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """Which nodes lie on the source side of the smallest minimum cut.

    A node's positive score is its capacity from the source, a negative one to the sink. A node whose score outweighs all its edges keeps
    its sign in every minimum cut; such nodes are settled first and become terminal capacity of their neighbours. Shortest
    augmenting paths by levels (Dinic) give the maximum flow of what remains.
    """
    n = len(scores)
    weight, around = [0] * n, [[] for _ in range(n)]
    for (a, b), w in edges.items():
        weight[a] += w
        weight[b] += w
        around[a].append((b, w))
        around[b].append((a, w))
    scores, side = list(scores), [None] * n
    settled = deque(k for k in range(n) if abs(scores[k]) > weight[k])
    while settled:
        k = settled.popleft()
        if side[k] is not None:
            continue
        side[k] = scores[k] > 0
        for other, w in around[k]:
            if side[other] is None:
                scores[other] += w if side[k] else -w
                weight[other] -= w
                if abs(scores[other]) > weight[other]:
                    settled.append(other)
    rest = [k for k in range(n) if side[k] is None]
    if rest:
        place = {k: i for i, k in enumerate(rest)}
        source, sink = len(rest), len(rest) + 1
        head, room, out = [], [], [[] for _ in range(len(rest) + 2)]

        def join(a: int, b: int, forth: int, back: int) -> None:
            for x, y, c in ((a, b, forth), (b, a, back)):
                out[x].append(len(head))
                head.append(y)
                room.append(c)

        for k in rest:
            if scores[k] > 0:
                join(source, place[k], scores[k], 0)
            elif scores[k] < 0:
                join(place[k], sink, -scores[k], 0)
        for (a, b), w in edges.items():
            if side[a] is None and side[b] is None:
                join(place[a], place[b], w, w)
        while True:
            level = [-1] * len(out)
            level[source], queue = 0, deque([source])
            while queue:
                x = queue.popleft()
                for e in out[x]:
                    if room[e] and level[head[e]] < 0:
                        level[head[e]] = level[x] + 1
                        queue.append(head[e])
            if level[sink] < 0:
                break
            following, path = [0] * len(out), []
            x = source
            while True:
                if x == sink:
                    least = min(room[e] for e in path)
                    for e in path:
                        room[e] -= least
                        room[e ^ 1] += least
                    cut = next(i for i, e in enumerate(path) if not room[e])
                    x = head[path[cut] ^ 1]
                    del path[cut:]
                elif following[x] < len(out[x]):
                    e = out[x][following[x]]
                    if room[e] and level[head[e]] == level[x] + 1:
                        path.append(e)
                        x = head[e]
                    else:
                        following[x] += 1
                elif path:
                    x = head[path.pop() ^ 1]
                    following[x] += 1
                else:
                    break
        for k in rest:
            side[k] = level[place[k]] >= 0
    return side


def main_text(page: str, model: dict[str, float]) -> str:
    """The blocks on the content side of the cut, one on each line."""
    blocks = blocks_of(page)
    nodes, edges = edges_of(blocks)
    scores = [b.structure + text_score(b, model) for b in blocks] + [0] * (nodes - len(blocks))
    return "\n".join(b.text for b, inside in zip(blocks, minimum_cut(scores, edges)) if inside)


def train(pages: DataFrame, sample: int = 10_000, prior: float = 20.0, bound: float = 1.5, often: int = 3) -> dict[str, float]:
    """Log-odds of each feature between blocks inside and outside of the main text.

    The classifier is fitted on ``sample`` pages, the smallest by a hash of page_id. Two views must agree on a block before it is an
    example: what its structure says, and whether the same text stands on ``often`` or more of these pages. Inside are blocks of a main part
    that do not repeat so; outside are those that repeat or have links, and stand in no main part. Counts are added up by Spark; what comes to the
    driver is two rows for each feature. ``prior`` pseudo-blocks pull rare features to 0, ``bound`` limits each. Without blocks on both
    sides the model is empty.
    """
    chosen = pages.select(F.col("page_id").alias("_chosen")).where("_chosen is not null").orderBy(F.xxhash64("_chosen"), "_chosen").limit(sample)
    pages = pages.join(F.broadcast(chosen), pages["page_id"] == chosen["_chosen"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, names, sides, links = [], [], [], []
            for page in batch["html"].to_pylist():
                for block in blocks_of(page or ""):
                    texts.append(block.text)
                    names.append(features(block))
                    sides.append(block.structure)
                    links.append(block.linked > 0)
            arrays = [pa.array(texts, pa.string()), pa.array(names, pa.list_(pa.string())), pa.array(sides, pa.int32()), pa.array(links, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=["text", "names", "side", "link"])

    found = pages.select(F.col("html").cast("string").alias("html")).mapInArrow(run, "text string, names array<string>, side int, link boolean")
    found = found.select(F.xxhash64("text").alias("place"), "names", "side", "link").groupBy("place", "names", "side", "link").agg(F.count(F.lit(1)).alias("n"))
    repeats = F.sum("n").over(Window.partitionBy("place")) >= often
    inside = F.when((F.col("side") > 0) & ~F.col("repeats"), True).when((F.col("side") <= 0) & (F.col("repeats") | F.col("link")), False)
    found = found.withColumn("repeats", repeats).withColumn("inside", inside).where("inside is not null")
    found = found.select("inside", "n", F.explode(F.array_append("names", F.lit("all"))).alias("name"))
    counts = {(r.name, r.inside): r.n for r in found.groupBy("name", "inside").agg(F.sum("n").alias("n")).collect()}
    yes, no = counts.pop(("all", True), 0), counts.pop(("all", False), 0)
    if not yes or not no:
        return {}
    odds = {}
    for name in {name for name, _ in counts}:
        rate = (counts.get((name, True), 0) + counts.get((name, False), 0)) / (yes + no)
        inside = (counts.get((name, True), 0) + prior * rate) / (yes + prior)
        outside = (counts.get((name, False), 0) + prior * rate) / (no + prior)
        odds[name] = max(-bound, min(bound, math.log(inside / outside)))
    return odds


def extract(pages: DataFrame, model: dict[str, float]) -> DataFrame:
    """page_id, url and main text of every row of ``pages`` (page_id, url, html).

    A null, empty or text-free html gives the empty string. Pages of any size are read whole. Repeated rows give repeated rows; other
    columns are not read. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(page or "", model) for page in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kinds = {"page_id": "long", "url": "string", "html": "string"}
    return pages.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()]).mapInArrow(run, "page_id long, url string, text string")
