"""Main text of web pages by consensus of a host's pages.

First pass: every page scores its containers by the prose in them (length and commas of their blocks, less what is link text) and
votes for its best one, named by its path of tags and classes from ``body``, with numbers generalised (``div.post-17`` votes as
``div.post-#``). Votes are counted per host and path in Spark; the paths with at least ``MIN_SHARE`` of a host's votes win.
Second pass: each page is extracted by its host's winning paths, the one with most votes first that has text on this page; a
page on which none has falls back to its own best container. What a page finds best is widened to the containers above while they
add prose with as few links, so that an article spread over several containers is whole.

Text: blocks of the container in page order, joined by a line break; character references decoded, white space within a block as one
space. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, hidden elements and reader comments are left out, by
tag and by the words of class names; an id judges a container alone, and only if all its words are of this kind (``comments``, not
``social-history``). One such word among the names of an article or of a content container (``tag-news``, ``has-sidebar``) only costs
it its bonus. Within an article, words that may also name a topic (``legal``, ``search``, ``related``) drop an element only if prose is
not most of it, and a leaf (``p``, ``h2``) goes only by a class name that is such words throughout; elsewhere a container of such a name
stays if it holds more than half of the page's prose, comments and adverts excepted. An article's own header stays; text of buttons and
labels stays beside other text, a block of nothing else goes.

Markup may be broken: inline tags never nest, blocks close what HTML says they close, an end tag without its start is ignored, and
once a quote of a tag is found to stay open, tags end at the next ``>``. Parsing is linear in the length of the page: no search for
an end that is missing is repeated, containers are numbered in page order, so each holds a range of numbers, and paths are shared.

Defined results: null or empty html gives an empty text; a null url is a host of its own; repeated rows vote twice and are extracted
twice; an empty table gives an empty result; other columns are ignored; no text is capped.

Scale: both passes are narrow; votes are (host, path) keys with map-side counts, so a host with a third of all pages costs a row per task and
path. The winners are written and joined without a hint: Spark broadcasts them when small, else AQE splits a hot host's rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabmill.llm.common import Stages

MIN_SHARE, MIN_PART = 0.1, 0.1

_OPEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
_STOP = re.compile("[>\"']")
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "annotation", "annotation-xml", "object", "select", "xmp", "noframes"}
_RAW_END = {tag: re.compile(f"</{tag}(?![a-zA-Z0-9:-])", re.I) for tag in RAW}
CONTROLS = {"button", "label"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
LEAVES = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "blockquote", "figcaption", "caption", "td", "th", "address", "summary"}
CONTAINERS = {"html", "body", "div", "article", "section", "main", "center", "table", "tbody", "thead", "tfoot", "tr", "ul", "ol", "dl", "figure", "details", "fieldset", "hgroup", "search"}
DROPPED = {"head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "audio", "video", "canvas"}
BLOCKS = LEAVES | CONTAINERS | DROPPED
#: A start tag on the left closes an open element on the right, up to a container in between.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
NOISE = re.compile(
    r"^(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebar|side|aside|nav\w*|menu\w*|breadcrumb\w*|footer|foot|masthead|header|topbar|toolbar|"
    r"cookie\w*|consent|gdpr|notice\w*|alert|popup|modal|overlay|newsletter|subscri\w*|signup|login|register|social|share\w*|sharing|related|recommend\w*|"
    r"comment\w*|disqus|replies|respond|discussion|widget\w*|pagination|pager|paging|skip|hidden|copyright|legal|disclaimer|form|search\w*|tags?|toc)$")
READERS = re.compile(r"^(?:comment\w*|disqus|replies|respond|discussion)$")
NOTICES = re.compile(r"^(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notice\w*|alert|popup|modal|overlay|newsletter|social|share\w*|sharing)$")
TOPICS = re.compile(r"^(?:form|search\w*|legal|related|recommend\w*|register|login|social|discussion|side|foot|skip|disclaimer|copyright|tags?|toc|consent|respond)$")
GOOD = re.compile(r"^(?:article\w*|content|main|post\w*|entry|story|text|body|page|blog)$")
PROSE = 80  # characters of a block that counts as prose
FINE, MIXED, TOPIC, NOISY, OUT = range(5)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


@dataclass(slots=True)
class Container:
    path: int  # number of its path of steps in Page.paths
    parent: int
    good: bool
    noise: int = FINE
    article: bool = False  # an article or in one
    score: float = 0.0
    sums: list[float] = field(default_factory=lambda: [0.0, 0.0, 0.0])  # prose, characters and linked characters in it and below
    last: int = 0  # the last container in it


@dataclass
class Page:
    containers: list[Container]
    blocks: list[tuple[str, int]]  # (text, container) in page order
    paths: dict[tuple[int, str], int]  # (path above, step) -> path; 0 is the page itself

    def path_text(self, path: int) -> str:
        above = {p: key for key, p in self.paths.items()}
        steps = []
        while path:
            path, step = above[path]
            steps.append(step)
        return ">".join(reversed(steps))

    def path_number(self, text: str) -> int:
        """-1 if the page has no such path."""
        path = 0
        for step in text.split(">"):
            path = self.paths.get((path, step), -1)
            if path < 0:
                break
        return path


def _attributes(raw: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTR.findall(raw)} if raw else {}


def _hidden(attrs: dict[str, str]) -> bool:
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    return attrs.get("role") in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form")


def _names(value: str) -> list[list[str]]:
    """The words of each name of a class or id attribute."""
    return [w for n in value.split() if (w := [x.lower() for x in _WORDS.findall(n) if not x.isdigit()])]


def _noisy(name: list[str]) -> bool:
    return all(map(NOISE.match, name))


def _inline_noise(attrs: dict[str, str]) -> bool:
    return _hidden(attrs) or any(map(_noisy, _names(attrs.get("class", ""))))


def _topical(names: list[list[str]]) -> bool:
    """Whether all noise words of the names may also name a topic."""
    return all(TOPICS.match(w) for name in names for w in name if NOISE.match(w))


def _kind(tag: str, attrs: dict[str, str], article: bool) -> int:
    """FINE; MIXED: kept, without a bonus; TOPIC: left out unless most of it is prose; NOISY: left out unless it holds most of the
    page's prose; OUT: left out. ``article``: within one."""
    classes = _names(attrs.get("class", ""))
    if tag in LEAVES:
        whole = [name for name in classes if _noisy(name)]
        if not whole:
            return FINE
        if any(READERS.match(w) or NOTICES.match(w) for name in whole for w in name):
            return OUT
        return TOPIC if article and _topical(whole) else NOISY
    ids = [name for name in _names(attrs.get("id", "")) if _noisy(name) or any(map(READERS.match, name))]
    noisy = [name for name in classes if any(map(NOISE.match, name))] + ids
    if not noisy:
        return FINE
    whole = [name for name in noisy if _noisy(name)]
    good = any(any(map(GOOD.match, name)) for name in classes + _names(attrs.get("id", "")) if name not in noisy)
    if not whole and (good or tag in ("article", "main")):
        return MIXED
    readers = any(READERS.match(w) for name in (whole if tag in ("article", "main") else noisy) for w in name)
    if readers or any(NOTICES.match(w) for name in whole for w in name):
        return OUT
    return TOPIC if article and _topical(noisy) else NOISY


def _step(tag: str, attrs: dict[str, str]) -> str:
    return ".".join([tag, *sorted({re.sub(r"\d+|>", "#", c) for c in attrs.get("class", "").split()})])


class _Scanner:
    """The marks of a page in order. A search that has met the end of the page is not made again."""

    def __init__(self, html: str):
        self.html, self.loose, self.unended = html, False, set()

    def _find(self, what: str, at: int) -> int:
        if what in self.unended:
            return -1
        i = self.html.find(what, at)
        if i < 0:
            self.unended.add(what)
        return i

    def _tag_end(self, at: int) -> int:
        """Index of the ``>`` that ends the tag, -1 if there is none."""
        i = at
        while not self.loose:
            m = _STOP.search(self.html, i)
            if m is not None and m[0] == ">":
                return m.start()
            i = self._find(m[0], m.end()) + 1 if m is not None else 0
            self.loose = not i
        return self._find(">", at)

    def next(self, at: int):
        """(start, end, tag or None, whether it ends an element, attributes or CDATA text) of the next mark, None at the end."""
        html = self.html
        while (m := _OPEN.search(html, at)) is not None:
            if m[5]:
                end = self._tag_end(m.end())
                if end >= 0:
                    return m.start(), end + 1, m[5].lower(), bool(m[4]), html[m.end():end]
            elif m[1] or m[2]:
                close = "-->" if m[1] else "]]>"
                end = self._find(close, m.end())
                return m.start(), end + 3 if end >= 0 else len(html), None, False, "" if m[1] else html[m.end():end if end >= 0 else len(html)]
            elif (end := self._find(">", m.end())) >= 0:
                return m.start(), end + 1, None, False, ""
            at = m.end()
        return None

    def raw_end(self, tag: str, at: int) -> int:
        """End of the element's end tag, -1 if it has none."""
        if tag in self.unended:
            return -1
        m = _RAW_END[tag].search(self.html, at)
        end = self._find(">", m.end()) + 1 if m is not None else 0
        if not end:
            self.unended.add(tag)
        return end or -1


def parse(html: str) -> Page:
    """The containers and the blocks of a page, noise left out."""
    containers = [Container(0, -1, False)]
    paths: dict[tuple[int, str], int] = {}
    opened: Counter = Counter()  # block elements on the stack by tag
    blocks: list[tuple[str, int]] = []
    links_of: list[int] = []  # linked characters of each block
    stack: list[tuple[str, int]] = [("", 0)]  # open block elements with their container; -1: dropped
    run: list[str] = []
    linked = links = plain = control = 0  # plain: characters but white space that are not of a control

    def add(text: str) -> None:
        nonlocal linked, plain
        run.append(text)
        if links:
            linked += len(text)
        if not control and not plain and not text.isspace():
            plain += len(text)

    def close_block(at: int) -> None:
        nonlocal linked, plain
        text = _SPACE.sub(" ", "".join(run)).strip()
        run.clear()
        if text and plain:
            blocks.append((text, at))
            links_of.append(min(linked, len(text)))
        linked = plain = 0

    def open_box() -> int:
        """Container of the innermost open block; what an inline element leaves out is no block."""
        k = len(stack) - 1
        while stack[k][0] and stack[k][0] not in BLOCKS:
            k -= 1
        return stack[k][1]

    at, marks = 0, _Scanner(html)
    while (mark := marks.next(at)) is not None:
        start, end, tag, ends, raw = mark
        if start > at and stack[-1][1] >= 0:
            add(unescape(html[at:start]))
        at = end
        if tag is None:
            if raw and stack[-1][1] >= 0:
                add(raw)
            continue
        if tag in RAW:
            if not ends and not raw.endswith("/") and (over := marks.raw_end(tag, at)) >= 0:
                at = over
            continue
        if tag in CONTROLS:
            control = 0 if ends else 1
            continue
        if tag == "a":
            links = 0 if ends else 1
        if tag in ("br", "hr", "img"):
            run.append(" ")
        if tag in VOID or tag not in BLOCKS:
            if tag not in VOID and not ends and raw and _inline_noise(_attributes(raw)) and tag not in ("a", "b", "i", "em", "strong", "u", "mark", "code"):
                stack.append((tag, -1))
                links = 0
            elif ends and stack[-1] == (tag, -1):
                stack.pop()
            continue
        if (box := open_box()) >= 0:
            close_block(box)
        links = control = 0
        if ends:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    opened.subtract(t for t, _ in stack[i:])
                    del stack[i:]
                    break
                if stack[i][0] in CONTAINERS and tag in LEAVES or stack[i][0] in ("td", "th") and tag in LEAVES:
                    break
            continue
        shut = CLOSES.get(tag, set()) | {"p"}
        while len(stack) > 1 and (stack[-1][0] in shut or stack[-1][0][:1] == "h" and stack[-1][0] in LEAVES and tag in LEAVES):
            opened[stack.pop()[0]] -= 1
        box = stack[-1][1]
        attrs = _attributes(raw)
        opened[tag] += 1
        article = box >= 0 and containers[box].article
        kind = FINE if tag in ("html", "body") else _kind(tag, attrs, article)
        if box < 0 or tag in DROPPED and not (tag == "header" and article) or kind == OUT or tag not in ("html", "body") and _hidden(attrs):
            stack.append((tag, -1))
        elif tag in LEAVES and kind == FINE:
            stack.append((tag, box))
        else:
            words = _WORDS.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}")
            good = kind == FINE and (tag in ("article", "main") or any(GOOD.match(w.lower()) for w in words))
            path = paths.setdefault((containers[box].path, _step(tag, attrs)), len(paths) + 1)
            containers.append(Container(path, box, good, kind, article or tag == "article"))
            stack.append((tag, len(containers) - 1))
    if stack[-1][1] >= 0 and at < len(html):
        add(unescape(html[at:]))
    if (box := open_box()) >= 0:
        close_block(box)
    return _scored(Page(containers, blocks, paths), links_of)


def _sum_up(containers: list[Container], blocks: list[tuple[str, int]], links_of: list[int]) -> None:
    for box in containers:
        box.sums = [0.0, 0.0, 0.0]
    for (text, at), linked in zip(blocks, links_of, strict=True):
        own = containers[at].sums
        own[0] += len(text) - linked if len(text) >= PROSE else 0
        own[1] += len(text)
        own[2] += linked
    for box in reversed(containers):  # parents come first
        if box.parent >= 0:
            up = containers[box.parent].sums
            for k in range(3):
                up[k] += box.sums[k]


def _scored(page: Page, links_of: list[int]) -> Page:
    """The page without its noise, which is known only when all prose is."""
    containers, blocks = page.containers, page.blocks
    for i in range(len(containers) - 1, -1, -1):
        box = containers[i]
        box.last = max(box.last, i)
        if box.parent >= 0:
            containers[box.parent].last = max(containers[box.parent].last, box.last)
    _sum_up(containers, blocks, links_of)
    if any(c.noise in (NOISY, TOPIC) for c in containers):
        half = containers[0].sums[0] / 2
        out = [False] * len(containers)
        for i, c in enumerate(containers):
            out[i] = c.parent >= 0 and out[c.parent] or c.noise == NOISY and c.sums[0] <= half or c.noise == TOPIC and 2 * c.sums[0] <= c.sums[1]
        stay = [i for i, (_, at) in enumerate(blocks) if not out[at]]
        blocks, links_of = [blocks[i] for i in stay], [links_of[i] for i in stay]
        _sum_up(containers, blocks, links_of)
    for (text, at), linked in zip(blocks, links_of, strict=True):
        share = 1 - linked / len(text)
        value = (min(len(text), 2000) / 100 + text.count(",")) * share if len(text) >= 20 else 0.1 * share
        box = containers[at]
        box.score += value
        if box.parent >= 0:
            containers[box.parent].score += value / 2
    return Page(containers, blocks, page.paths)


def best_container(page: Page) -> int:
    """Index of the best container, -1 if the page has no text."""
    scores = [c.score * (1.3 if c.good else 1.0) for c in page.containers]
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    return best if scores[best] > 0 else -1


def _same_path(page: Page, path: int) -> set[int]:
    return {i for i, c in enumerate(page.containers) if c.path == path}


def _above(page: Page, i: int) -> list[int]:
    out = []
    while (i := page.containers[i].parent) >= 0:
        out.append(i)
    return out


def widened(page: Page, chosen: set[int]) -> set[int]:
    """``chosen``, or the container above that adds prose to it: ``MIN_PART`` of what is chosen at least, most of what it adds,
    and with a share of links like that of what is chosen."""
    boxes = page.containers
    first, end = min(chosen), -1
    held = [0.0, 0.0, 0.0]
    for i in sorted(chosen):
        if i > end:  # not within one before it
            end = boxes[i].last
            held = [a + b for a, b in zip(held, boxes[i].sums, strict=True)]
    for up in _above(page, first):
        if end > boxes[up].last or not boxes[up].path:
            continue
        prose, chars, linked = (a - b for a, b in zip(boxes[up].sums, held, strict=True))
        if prose > 0 and prose >= MIN_PART * held[0] and 2 * prose >= chars and linked / chars <= held[2] / max(1, held[1]) + 0.1:
            chosen, held = {up}, list(boxes[up].sums)
    return chosen


def text_of(page: Page, chosen: set[int]) -> str:
    """Blocks in the chosen containers or below them, in page order."""
    inside = [False] * len(page.containers)
    for i, c in enumerate(page.containers):  # parents come first
        inside[i] = i in chosen or c.parent >= 0 and inside[c.parent]
    return "\n".join(text for text, box in page.blocks if inside[box])


def own_choice(page: Page) -> set[int]:
    """The page's best container, with those of its path when it is widened; empty if the page has no text."""
    best = best_container(page)
    if best < 0:
        return set()
    wide = widened(page, _same_path(page, page.containers[best].path))
    return {best} if best in wide else wide


def extract(html: str | None, paths: list[str]) -> str:
    page = parse(html or "")
    best = best_container(page)
    for path in paths:
        number = page.path_number(path)
        if number < 0:
            continue
        chosen = _same_path(page, number)
        text = text_of(page, chosen)
        if text:  # widened only where the page itself finds its text
            return text_of(page, widened(page, chosen)) if best in chosen else text
    return text_of(page, own_choice(page))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, scores = [], [], []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page = parse(html or "")
            best = min(own_choice(page), default=-1)
            if best >= 0 and page.containers[best].path:
                hosts.append(host)
                paths.append(page.path_text(page.containers[best].path))
                scores.append(round(page.containers[best].score * 100))
        yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "path": pa.array(paths, pa.string()), "score": pa.array(scores, pa.int64())})


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def winning_paths(pages: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """host, paths: its winning paths, most votes first."""
    votes = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(_votes, "host string, path string, score bigint")
    votes = votes.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("score").alias("score"))
    votes = votes.withColumn("all", F.sum("n").over(Window.partitionBy("host"))).where(F.col("n") >= min_share * F.col("all"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), (-F.col("score")).alias("score"), "path")))
    return votes.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"))


def main_text(pages: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text, n_chars."""
    pages = pages.select("page_id", "url", "html")
    winners = Stages(pages.sparkSession, "html").write(winning_paths(pages, min_share), "winners")
    id_type = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h, p or []) for h, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    rows = pages.withColumn("_host", host_of(F.col("url"))).join(winners.withColumnRenamed("host", "_host"), "_host", "left")
    return rows.select("page_id", "url", "html", "paths").mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars bigint")
