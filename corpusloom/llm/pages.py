"""Main text of web pages by consensus host paths.

Pages of a host share templates.  Each page scores its containers by the text
they hold, and names the best of them.  Every container with text votes for its generalised path (tag
and class names from the root, digits folded): Spark counts, per host and path, the pages
that have text there and those whose best container it is.  A path that several pages have wins if it is the best
of half of them, and loses otherwise.  Every page is extracted again: from its best container, unless the
host's pages voted against that path; then from the winning path that holds most of its score.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import small_batches
from corpusloom.session import materialize

# Element names of HTML and the usual names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg canvas select noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("body main article section div td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE_TAGS = frozenset("nav aside footer form button menu dialog head audio video".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot adsense banner sponsor sponsored promo promotion promoted cookie cookies"
    " consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup sidebar sidenav menu nav navbar"
    " navigation breadcrumb breadcrumbs footer masthead topbar toolbar pagination pager share sharing social related recommended"
    " recommendations outbrain taboola widget".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist commentary disqus respond replies reply discussion".split())
TEXT_WORDS = frozenset("article content entry main post story text body".split())
EXEMPTING = frozenset("with has no without".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"([A-Za-z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
PLAIN, FURNITURE, COMMENT = 0, 1, 2


@dataclass(slots=True)
class Node:
    tag: str
    path: int               # number in Page.paths
    kind: int               # PLAIN, FURNITURE or COMMENT, inherited
    headings_only: bool     # inside the header of an article
    in_text: bool           # inside article or main
    container: int          # index of the nearest container; 0 is the page itself
    block: str              # tag of the nearest block
    furniture: int          # place in the stack where furniture begins; 0 for none


@dataclass(slots=True)
class Container:
    path: int
    parent: int
    tag: str
    points: float = 0.0     # of its own blocks
    score: float = 0.0      # and half of those one level down
    total: float = 0.0      # points of all blocks anywhere inside, less their links
    chars: int = 0
    link_chars: int = 0


@dataclass
class Page:
    """Containers and blocks in page order; a container comes after the one around it.

    A path is numbered as (path above, name) and written out only when asked for, so a page of any depth is parsed
    in time and memory in proportion to its length.
    """

    containers: list[Container] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)      # (container, text) in page order
    paths: list[tuple[int, str]] = field(default_factory=lambda: [(-1, "")])
    _numbers: dict[tuple[int, str], int] = field(default_factory=dict)

    def step(self, path: int, name: str) -> int:
        number = self._numbers.setdefault((path, name), len(self.paths))
        if number == len(self.paths):
            self.paths.append((path, name))
        return number

    def path_ids(self) -> list[int]:
        """A 64-bit name of each path, the same on every page."""
        import xxhash

        out = [0]
        for above, name in self.paths[1:]:
            out.append(xxhash.xxh3_64_intdigest(name.encode("utf-8", "replace"), out[above]))
        return [x - (1 << 64) if x >> 63 else x for x in out]

    def path_text(self, path: int) -> str:
        names = []
        while path > 0:
            path, name = self.paths[path]
            names.append(name)
        return "".join(f"/{name}" for name in reversed(names))

    def close(self) -> None:
        """Sum up what the containers hold, innermost first."""
        for c in self.containers:
            c.score += c.points
            if c.parent >= 0:
                self.containers[c.parent].score += c.points / 2
        for c in reversed(self.containers):
            if c.parent >= 0:
                above = self.containers[c.parent]
                above.total += c.total
                above.chars += c.chars
                above.link_chars += c.link_chars

    def text(self, roots: set[int]) -> str:
        inside = []
        for i, c in enumerate(self.containers):
            inside.append(i in roots or (c.parent >= 0 and inside[c.parent]))
        return "\n\n".join(text for at, text in self.blocks if inside[at])


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)} if raw.strip(" /") else {}


def _kind(tag: str, attrs: dict[str, str], words: set[str]) -> int:
    """Whether an element is text, furniture, or readers' comments."""
    if tag in ("html", "body", "main"):
        return PLAIN
    if words & COMMENT_WORDS and not words & EXEMPTING:
        return COMMENT
    if tag in FURNITURE_TAGS or attrs.get("role", "").lower() in FURNITURE_ROLES:
        return FURNITURE
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or _HIDING.search(attrs.get("style", "")):
        return FURNITURE
    if words & FURNITURE_WORDS and not words & EXEMPTING and not (tag == "article" and words & TEXT_WORDS):
        return FURNITURE
    if "header" in words and tag not in HEADINGS and not words & TEXT_WORDS:
        return FURNITURE
    return PLAIN


def parse(source: str) -> Page:
    """Containers and text blocks of a page; forgiving of missing and stray tags."""
    page, buffer = Page([Container(0, -1, "body")]), []
    stack = [Node("", 0, PLAIN, False, False, 0, "", 0)]
    open_at: dict[str, list[int]] = {}      # places in the stack by tag
    open_blocks = [0]                       # places of blocks
    links, at, end = 0, 0, len(source)
    link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            top = stack[-1]
            if text and top.kind == PLAIN and (not top.headings_only or top.block in HEADINGS):
                page.blocks.append((top.container, text))
                _credit(page.containers[top.container], text, link_chars)
        link_chars = 0

    def cut(depth: int) -> None:
        nonlocal links
        for node in stack[depth:]:
            links -= node.tag == "a"
            open_at[node.tag].pop()
        del stack[depth:]
        while open_blocks[-1] >= depth:
            open_blocks.pop()

    def pop_to(depth: int) -> None:
        flush()
        cut(depth)

    while at < end:
        found = _TOKEN.search(source, at)
        upto = found.start() if found else end
        if upto > at and stack[-1].kind == PLAIN:
            buffer.append(source[at:upto])
            link_chars += (upto - at) * (links > 0)
        if not found:
            break
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        if found["end"] or found["end2"]:
            places = open_at.get(tag)
            if places:
                if tag in BLOCKS:
                    pop_to(places[-1])
                elif open_blocks[-1] <= places[-1]:
                    cut(places[-1])
            elif tag in BLOCKS:
                flush()
            continue
        raw = found["attrs"] if found["tag"] else found["attrs2"]
        if tag in RAW:
            if not raw.endswith("/") or tag in ("script", "style", "title", "textarea"):
                close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                at = close.end() if close else end
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                buffer.append(" ")
            continue
        attrs = _attributes(raw)
        label = attrs.get("class", "")
        words = {w.lower() for w in _WORD.findall(label + " " + attrs.get("id", ""))}
        if tag in BLOCKS:
            flush()
            nearest = stack[open_blocks[-1]].tag
            if open_blocks[-1] and (nearest == "p" or nearest in CLOSES.get(tag, ())):
                pop_to(open_blocks[-1])
            if tag in ("article", "main") and stack[-1].furniture:       # furniture that was never closed ends where the article starts
                pop_to(stack[-1].furniture)
        top = stack[-1]
        kind = top.kind or _kind(tag, attrs, words)
        in_text = top.in_text or tag in ("article", "main")
        headings_only = top.headings_only
        if tag == "header" and kind == PLAIN:
            if top.in_text:
                headings_only = True
            else:
                kind = FURNITURE
        container, path, block = top.container, top.path, top.block
        if tag in BLOCKS:
            names = sorted({re.sub(r"\d+", "#", w) for w in label.lower().split()})
            path, block = page.step(path, tag + "".join(f".{n}" for n in names)), tag
            if tag in CONTAINERS and kind == PLAIN:
                page.containers.append(Container(path, container, tag))
                container = len(page.containers) - 1
            open_blocks.append(len(stack))
        links += tag == "a"
        open_at.setdefault(tag, []).append(len(stack))
        furniture = top.furniture or (len(stack) if kind == FURNITURE else 0)
        stack.append(Node(tag, path, kind, headings_only, in_text, container, block, furniture))
    flush()
    page.close()
    return page


def _credit(container: Container, text: str, link_chars: int) -> None:
    """A block's points, for the container it is in."""
    points = min(len(text), 25) / 25 + text.count(",") + min(len(text) / 100, 3.0)
    linked = min(link_chars, len(text))
    container.chars += len(text)
    container.link_chars += linked
    container.total += points * (1 - linked / len(text))
    container.points += points


def ranked(page: Page) -> list[tuple[float, int]]:
    """Containers with text, best first; links count against them, article and main for them."""
    weight = {"article": 1.5, "main": 1.25, "body": 0.5}
    scored = [
        (c.score * (1 - c.link_chars / c.chars) * weight.get(c.tag, 1.0), i) for i, c in enumerate(page.containers) if c.chars and c.score
    ]
    return sorted(scored, key=lambda x: (-x[0], x[1]))


def best(page: Page) -> int | None:
    """The best container, or one around it that holds half as much again: then the text was in parts."""
    order = ranked(page)
    if not order:
        return None
    at = order[0][1]
    while page.containers[at].tag not in ("article", "main") and (up := page.containers[at].parent) >= 0:
        if page.containers[up].total < 1.5 * page.containers[at].total:
            break
        at = up
    return at


def extract(page: Page, winners: Iterable[int] = (), losers: Iterable[int] = ()) -> tuple[str, str | None]:
    """Text of the page, and the path it was taken from (null where there is no text).

    From the best container, or from all on its path where that is a winning one; where the host's pages voted against
    it, from the winning path that holds most of the page's score, if it has one.
    """
    order, at = ranked(page), best(page)
    if at is None:
        return page.text({0}), None
    ids, winners = page.path_ids(), set(winners)
    path = page.containers[at].path
    if ids[path] in set(losers):
        path = next((page.containers[i].path for _, i in order if ids[page.containers[i].path] in winners), path)
    roots = {i for i, c in enumerate(page.containers) if c.path == path and c.chars} if ids[path] in winners else {at}
    return page.text(roots), page.path_text(path)


def host(url: Column) -> Column:
    """Lower-case host of a URL; empty for a null or odd one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, best): every container path of a page with text, and whether it is the page's best."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = []
            for name, source in zip(*batch.to_pydict().values()):
                page = parse(source or "")
                ids, first = page.path_ids(), best(page)
                chosen = None if first is None else page.containers[first].path
                rows += [(name, ids[path], path == chosen) for path in {page.containers[i].path for _, i in ranked(page)}]
            columns = list(zip(*rows)) or [[], [], []]
            kinds = [pa.string(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "path", "best"])

    return pages.select("host", "html").mapInArrow(run, "host string, path bigint, best boolean")


def consensus(pages: DataFrame) -> DataFrame:
    """(host, winners, losers): the paths that two pages of a host and more have, and that are the best of some.

    Counts combine before the shuffle: a host with a third of all pages is a few
    rows per task.  Pages whose url names no host have no neighbours and do not vote.
    """
    counts = votes(pages.where("host != ''")).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.count_if("best").alias("best"))
    named = counts.where("n > 1 AND best > 0").withColumn("wins", F.col("best") * 2 >= F.col("n"))
    lists = [F.sort_array(F.collect_list(F.when(c, F.col("path")))) for c in (F.col("wins"), ~F.col("wins"))]
    return named.groupBy("host").agg(lists[0].alias("winners"), lists[1].alias("losers"))


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, path) for every row of `pages`.

    Blocks are in page order, white space inside one made one space, joined by two
    line ends; the text is empty when a page has none.  Null html is an empty page; a page whose
    url names no host is extracted on its own.  Repeated rows stay, an empty table gives no
    rows, other columns are not used.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), host(F.col(url)).alias("host"), F.col(html).alias("html")
    )
    paths = materialize(consensus(rows), "host-paths")
    chosen = rows.join(paths, "host", "left").select("page_id", "url", "winners", "losers", "html")
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [extract(parse(x.as_py() or ""), w.as_py() or (), l.as_py() or ()) for w, l, x in zip(*batch.columns[2:])]
            texts, taken = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(taken, pa.string())], names=["page_id", "url", "text", "path"]
            )

    return chosen.mapInArrow(run, f"page_id {kind}, url string, text string, path string")
