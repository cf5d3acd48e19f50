"""Main text of web pages by consensus host paths.

First every page scores its containers by how much of the page's good text (outside menus, headers,
footers and the like) they hold, under a generalised path of tags and classes, and votes for the best,
or for a container around it that adds good text.
Spark adds the votes up per host and path. Then every page is read again with its host's winning path; a page that
lacks it is read with its own best one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import md5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut, table, whole_text

#: A container's score: its share of the good text, more for depth, more for a tag that names the article.
DEPTH_BONUS, ARTICLE_BONUS = 0.05, 0.5

# HTML element classes.
RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("body main article section div td".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
SKIPPED = frozenset(
    "head nav header footer aside form button select option input label fieldset dialog menu svg math canvas object audio video map "
    "applet frameset".split()
) | frozenset(RAW)
#: What an opening tag closes when it is still open, up to the nearest of the elements after it.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
ARTICLE_TAGS = frozenset(("article", "main"))
#: Words of a class or id that mark what is no article.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent notice gdpr popup modal overlay newsletter "
    "subscribe subscription social share sharing related recommended comment comments disqus respond reply replies login signup "
    "widget pagination pager toolbar".split()
)
#: Marked words of what readers write.
READERS = frozenset("comment comments disqus respond reply replies".split())
#: Words that turn a marked word into a statement about the element: it has a sidebar, or none.
STATES = frozenset("has have with without no not hide hides show shows layout elementor free open closed".split())
#: A path longer than this is named by a hash of its beginning, so that deep pages take linear time.
PATH_CHARS = 512
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    # a quoted value ends before the next tag begins, or soon after; a tag with a quote that isn't closed so far ends
    # at the next angle bracket: whatever begins as a tag is one, and is read once
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+'|\"[^\"]{0,512}+\"|'[^']{0,512}+')*+)(?:>|\Z|[\"'][^<>]*+>?|(?=<))",
    re.DOTALL,
)
_RAW_END = {tag: re.compile(rf"</{tag}[\s/>]", re.IGNORECASE) for tag in RAW}
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_WORD = re.compile(r"[a-z]+")


class _Open:
    """An open element: its tag, whether its text is skipped, its container's node, whether it is in a link, and the
    mark around its text (-1: none)."""

    __slots__ = ("link", "mark", "node", "path", "skip", "tag")

    def __init__(self, tag: str, path: str, skip: bool, node: int, link: bool, mark: int):
        self.tag, self.path, self.skip, self.node, self.link, self.mark = tag, path, skip, node, link, mark


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if "=" in rest or rest.strip(" /") else {}


def _skips(tag: str, attributes: dict[str, str]) -> bool:
    if tag in SKIPPED:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "")
    return hidden or attributes.get("role", "").lower() in ROLES


def _mark(tag: str, attributes: dict[str, str]) -> str:
    """The marked word by which an element's class or id says that it is no article, or "".

    Any whole word of a name counts, but none in a name with a word of STATES, and none on elements that name the article.
    """
    if not attributes or tag in ("html", "body") or tag in ARTICLE_TAGS:
        return ""
    out = ""
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = _WORD.findall(name)
        if STATES.isdisjoint(words):
            for word in words:
                if word in MARKED and (not out or word in READERS):
                    out = word
    return out


def _step(tag: str, attributes: dict[str, str]) -> str:
    names = sorted(re.sub(r"\d+", "#", c) for c in attributes.get("class", "").lower().split())
    return tag + "".join(f".{c}" for c in names)


class Page:
    """A page's good text in blocks, over the tree of its containers. All work is linear in the page."""

    def __init__(self, page: str):
        #: Per container node: its parent, path, depth and tag. Node 0 is the page.
        self.parent, self.path, self.depth = [0], [""], [0]
        #: Per block: text, container node, whether most of it is links, mark.
        self.blocks: list[tuple[str, int, bool, int]] = []
        #: Per mark: its word and the mark around it.
        self.marks: list[tuple[str, int]] = []
        #: The marks (-1: none) around the tags that name an article, and around headlines.
        self.articles: list[int] = []
        self.headlines: list[int] = []
        self._read(page)
        self.kept = self._kept()
        self._sums()

    def _path(self, above: str, tag: str, attributes: dict[str, str]) -> str:
        step = _step(tag, attributes)
        if len(above) + len(step) > PATH_CHARS:
            above = "#" + md5(above.encode()).hexdigest()
        return f"{above}/{step}"

    def _read(self, page: str) -> None:
        stack = [_Open("", "", False, 0, False, -1)]
        count: dict[str, int] = {}
        text: list[str] = []
        linked = 0

        def flush() -> None:
            nonlocal linked
            if text:
                joined = "".join(text)
                block = " ".join(html.unescape(joined).split())
                if block:
                    self.blocks.append((block, stack[-1].node, 2 * linked > len(joined), stack[-1].mark))
                text.clear()
                linked = 0

        def pop() -> None:
            count[stack.pop().tag] -= 1

        at = 0
        while at < len(page):
            m = _TOKEN.search(page, at)
            stop = m.start() if m else len(page)
            if stop > at and not stack[-1].skip:
                text.append(page[at:stop])
                linked += stop - at if stack[-1].link else 0
            if not m:
                break
            at = m.end()
            if not m["tag"]:
                if m[0].startswith("<![CDATA[") and not stack[-1].skip:
                    text.append(html.escape(m[0][9:].removesuffix("]]>")))
                continue
            tag, closing = m["tag"].lower(), bool(m["close"])
            if tag not in INLINE:
                flush()
            elif tag == "br" and not stack[-1].skip:
                text.append(" ")
            if closing:
                if count.get(tag):
                    if stack[-1].tag != tag and stack[-1].mark >= 0:  # a marked element may end here
                        flush()
                    while stack[-1].tag != tag:
                        pop()
                    pop()
                continue
            rest = m["rest"] or ""
            attributes = _attributes(rest)
            if tag not in INLINE and stack[-1].tag != tag:
                if count.get("p"):
                    opened = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p" or stack[i].tag not in INLINE), 0)
                    if opened and stack[opened].tag == "p":  # a paragraph ends where a block begins
                        while len(stack) > opened:
                            pop()
            elif tag == "p":
                pop()
            if tag in CLOSES:
                ends, within = CLOSES[tag]
                if any(count.get(t) for t in ends):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag in within:
                            break
                        if stack[i].tag in ends:
                            while len(stack) > i:
                                pop()
                            break
            if tag in VOID or rest.endswith("/") and tag not in CONTAINERS and tag not in RAW:
                continue
            if tag in _RAW_END:
                end = _RAW_END[tag].search(page, at)
                at = page.find(">", end.start()) + 1 or len(page) if end else len(page)
                continue
            self._open(stack, tag, attributes)
            count[tag] = count.get(tag, 0) + 1
        flush()

    def _open(self, stack: list[_Open], tag: str, attributes: dict[str, str]) -> None:
        top = stack[-1]
        path = top.path if tag in INLINE else self._path(top.path, tag, attributes)
        skip, node, mark = top.skip or _skips(tag, attributes), top.node, top.mark
        word = "" if skip else _mark(tag, attributes)
        if word and tag in INLINE:
            skip = True
        elif word:
            self.marks.append((word, mark))
            mark = len(self.marks) - 1
        if tag in CONTAINERS:
            self.parent.append(node)
            self.path.append(path)
            self.depth.append(self.depth[node] + 1)
            node = len(self.parent) - 1
        if not skip and (tag in ARTICLE_TAGS or tag == "h1"):
            (self.headlines if tag == "h1" else self.articles).append(mark)
        stack.append(_Open(tag, path, skip, node, top.link or tag == "a", mark))

    def _kept(self) -> list[tuple[str, int, bool]]:
        """The blocks without those that a mark takes away. A marked element stays where it holds the page's article: where
        none is named outside marks, the headline or the tag that names one, or the container with most text of its own.
        What readers write is the article only where it holds the headline."""
        if not self.marks:
            return [b[:3] for b in self.blocks]
        staying: set[int] = set()

        def stays(mark: int, tagged: bool) -> None:
            while mark >= 0 and mark not in staying:
                if tagged or self.marks[mark][0] not in READERS:
                    staying.add(mark)
                mark = self.marks[mark][1]

        if -1 not in self.articles:
            if self.headlines and -1 not in self.headlines:
                stays(self.headlines[0], True)
            elif self.articles and -1 not in self.headlines:
                stays(self.articles[0], False)
            own: dict[int, list[int]] = {}
            for text, node, links, mark in self.blocks:
                if not links and not self._of_readers(mark):
                    sums = own.setdefault(node, [0, mark])
                    sums[0] += len(text)
            if own:
                stays(max(own.values(), key=lambda x: x[0])[1], False)
        dropped = [False] * len(self.marks)
        for i, (_, outer) in enumerate(self.marks):
            dropped[i] = i not in staying or (outer >= 0 and dropped[outer])
        return [(text, node, links) for text, node, links, mark in self.blocks if mark < 0 or not dropped[mark]]

    def _of_readers(self, mark: int) -> bool:
        if not hasattr(self, "_readers"):
            self._readers: list[bool] = []
            for word, outer in self.marks:
                self._readers.append(word in READERS or (outer >= 0 and self._readers[outer]))
        return mark >= 0 and self._readers[mark]

    def _sums(self) -> None:
        """Per path: characters of text and of links in it, and of text of its own; its parent path and depth."""
        n = len(self.parent)
        good, links, own = [0] * n, [0] * n, [0] * n
        for text, node, linked in self.kept:
            (links if linked else good)[node] += len(text)
        own = list(good)
        for i in range(n - 1, 0, -1):
            good[self.parent[i]] += good[i]
            links[self.parent[i]] += links[i]
        self.good: dict[str, int] = {}
        self.links: dict[str, int] = {}
        self.own: dict[str, int] = {}
        self.above: dict[str, tuple[str, int]] = {}
        for i in range(n):
            if good[i] or links[i]:
                p = self.path[i]
                self.good[p] = self.good.get(p, 0) + good[i]
                self.links[p] = self.links.get(p, 0) + links[i]
                self.own[p] = self.own.get(p, 0) + own[i]
                self.above.setdefault(p, (self.path[self.parent[i]], self.depth[i]))

    def scores(self) -> dict[str, float]:
        """Container path -> score; links count only on a page of links."""
        held = self.good if self.good.get("") else self.links
        total = held.get("", 0)

        def score(path: str, size: int) -> float:
            return size / total * (1 + DEPTH_BONUS * self.above[path][1]) + (ARTICLE_BONUS if _tag(path) in ARTICLE_TAGS else 0.0)

        return {path: score(path, size) for path, size in held.items() if size}

    def whole(self, path: str) -> str:
        """``path``, or the outermost container around it up to which each adds as much good text as other text.

        Other text is links, and what lies in a container of its own in the page's body or beside an article.
        """
        alone, outer = _tag(path) in ARTICLE_TAGS, path
        while outer:
            outer = self.above[outer][0]
            good, other = self.good[outer] - self.good[path], self.links[outer] - self.links[path]
            if alone or _tag(outer) in ("", "body"):
                other += good - self.own[outer]
                good = self.own[outer]
            if other > good:
                break
            if good:
                path = outer
        return path

    def best(self) -> str:
        """The page's own choice."""
        scores = self.scores()
        return self.whole(max(scores, key=lambda p: (scores[p], p))) if scores else ""

    def text(self, path: str) -> str:
        inside = [False] * len(self.parent)
        for i, p in enumerate(self.path):
            inside[i] = p == path or (i > 0 and inside[self.parent[i]])
        return "\n\n".join(text for text, node, _ in self.kept if inside[node])


def container_scores(page: str) -> dict[str, float]:
    """Container path -> score, for a page with any good text."""
    return Page(page).scores()


def main_text(page: str, path: str | None) -> tuple[str, str]:
    """The text under ``path``, or under the page's own best container if it has none; and that path."""
    read = Page(page)
    if path is None or path not in read.above:
        path = read.best()
    return read.text(path), path


def _tag(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[tuple[str, str], tuple[int, float]] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            read = Page(page)
            first = read.best()
            for path, score in read.scores().items():
                votes, total = sums.get((host, path), (0, 0.0))
                sums[host, path] = (votes + (path == first), total + score)
        hosts, paths = pa.array([h for h, _ in sums], pa.string()), pa.array([p for _, p in sums], pa.string())
        votes, scores = pa.array([v for v, _ in sums.values()], pa.int64()), pa.array([x for _, x in sums.values()], pa.float64())
        yield pa.RecordBatch.from_arrays([hosts, paths, votes, scores], names=["host", "path", "votes", "score"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, hosts, pages, wins = batch.columns
        got = [main_text(page, path) for page, path in zip(pages.to_pylist(), wins.to_pylist(), strict=True)]
        texts = pa.array([t for t, _ in got], pa.string())
        sizes, paths = pa.array([len(t) for t, _ in got], pa.int64()), pa.array([p for _, p in got], pa.string())
        yield pa.RecordBatch.from_arrays([ids, urls, texts, sizes, hosts, paths], names=["page_id", "url", "text", "n_chars", "host", "path"])


def winning_paths(pages: DataFrame) -> DataFrame:
    """host, path: the container path that most pages of the host score best.

    Ties go to the higher sum of scores, then to the path that sorts last. ``pages``: host and html. Votes
    are added up per batch, then per task, then per host and path.
    """
    votes = pages.select("host", "html").mapInArrow(_vote, "host string, path string, votes long, score double")
    votes = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.round(F.sum("score"), 6).alias("score"))
    return votes.groupBy("host").agg(F.max(F.struct("votes", "score", "path")).alias("best")).select("host", F.col("best.path").alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, host, path for every row of ``pages``.

    A null or empty html, and one without good text, gives an empty text. Very long, deep and broken pages take
    time in proportion to their length. Pages without a host in their
    url vote together under an empty one. Repeated pages are rows of their own. Other columns are
    ignored; an empty table gives an empty result.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), whole_text("html").alias("html"))
    winners = cut(winning_paths(rows))
    # no hint: the winners are sent around only while Spark finds them small
    with_path = rows.join(winners, "host", "left").select("page_id", "url", "host", "html", "path")
    schema = "page_id long, url string, text string, n_chars long, host string, path string"
    return with_path.mapInArrow(_extract, schema)


def op2_consensus_html(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
