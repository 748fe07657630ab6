"""Main text of web pages by nearest-URL page differencing.

Pages of a site share their frame. Each page is cut into lines (the text of its blocks, in page
order); pages are paired with the pages before and behind them in the order of URL paths within the host, the lines of
a pair are aligned by longest common subsequence, and shared lines are deleted as frame.

Markup has its say where it is plain. Lines of menus, headers, footers, sidebars, notices, adverts, forms and
comments are frame whatever the neighbour holds, and lines right inside an article or main element are its text.
The alignment decides all other lines: those outside such elements, and those whose markup only hints at a
frame (a header inside an article, a class such as `share-price`). A pair that shares nearly
all it has is a pair of copies and tells nothing, but for lines that the page shares with both its neighbours.

Shape: one pass parses; rows are dealt by stretches of the order (host, path, url, page_id) and sorted, so a host of any
size is spread over many tasks. Pages at the edges of a stretch meet their neighbours in a second pass over the edges
alone (four pages a stretch), so the pairing is a function of the table and not of where it was cut.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import map_batches

#: Input bytes for each task, stretches of each, the most stretches, and urls sampled for each; a share of what a page holds beyond which a pair is one of copies.
TASK_BYTES, STRETCHES, MOST_STRETCHES, SAMPLED, COPIES_SHARE = 64 << 20, 4, 65_536, 8, 0.8

# ---- fixed values of HTML: element kinds
_RAW = {"script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes"}
_HIDDEN = {"svg", "template", "noscript", "object", "select", "canvas", "button", "audio", "video", "datalist", "annotation"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "math", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
_HEAD = {"meta", "link", "base"} | _RAW | _HIDDEN
_FRAME = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head"}
_MAIN = {"article", "main"}
#: Closed by the next of their kind, or by a block that can't stand inside them.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_FRAME_WORD = re.compile(r"ads?|adverts?|advert[a-z]*|banners?|sponsor[a-z]*|promos?|promotions?|cookies?|consent|gdpr|notices?|alerts?|popup|modal|sidebar|rail|widgets?|menu|nav|navbar|navigation|breadcrumbs?|masthead|header|footer|foot|comments?|respond|disqus|share|sharing|social|related|recommend[a-z]*|newsletter|subscribe|subscription|signup|login|search|toolbar|pagination|pager|copyright")
#: Words that say where or how, not what: beside frame words they leave a name plain.
_NEUTRAL_WORD = re.compile(r"\d+|[a-z]|area|bar|block|body|bottom|box|btn|buttons?|container|content|cta|form|global|group|icons?|inline|inner|item|items|left|links?|list|main|media|network|outer|page|pages|panel|policy|post|posts|reader|right|row|section|side|site|slot|stories|thread|title|top|unit|user|wrap|wrapper|articles")
_FRAME_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
_MAIN_NAME = re.compile(r"(?i)(?:^|\s)(?:article|article-body|article-content|entry-content|post-content|post-body|story-body|main-content)(?:$|\s)")
# ---- end of fixed values

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
# possessive, so that a broken tag is never read twice; a quote counts only behind =
_ATTRS = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>")
_ATTR = re.compile(r"([^\s=/\"'>]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")
_BARE_HIDDEN = re.compile(r"(?i)(?:^|\s)hidden(?:\s|=|$)")
_SPACE = re.compile(r"\s+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

#: What markup says of a line. DOUBT stands inside an article; it and PLAIN are decided by alignment.
FRAME, PLAIN, MAIN, DOUBT = 0, 1, 2, 3
#: Of a form while it is read: some pages are one form, so an article inside it counts.
_FORM = 4


def _named(names: str) -> int | None:
    """What class and id say: FRAME for a name made of frame words alone, DOUBT for one that holds such a word beside others."""
    found = None
    for name in names.split():
        parts = [p for p in re.split(r"[-_]+", _CAMEL.sub("-", name).lower()) if p]
        if any(map(_FRAME_WORD.fullmatch, parts)):
            if all(_FRAME_WORD.fullmatch(p) or _NEUTRAL_WORD.fullmatch(p) for p in parts):
                return FRAME
            found = DOUBT
    return found


def _zone(name: str, attrs: str, zone: int) -> int | None:
    """What an element inside a zone makes of its lines; None if they are as its parent's, -1 if they can't be seen."""
    if name == "header" and zone in (MAIN, DOUBT):
        return DOUBT
    if name in _FRAME:
        return _FORM if name == "form" else FRAME
    if "=" in attrs:
        values = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
        if values.get("aria-hidden", "").lower() == "true":
            return -1
        role = values.get("role", "").strip().lower()
        names = f"{values.get('class', '')} {values.get('id', '')}"
        said = None if name in ("body", "html", "main") else FRAME if role in _FRAME_ROLE else _named(names)
        if said == FRAME:
            return FRAME
        if role in ("main", "article") or name in _MAIN or _MAIN_NAME.search(names):
            return MAIN
        if said == DOUBT:
            return DOUBT if zone == MAIN else None
    if "hidden" in attrs and _BARE_HIDDEN.search(attrs):
        return -1
    return MAIN if name in _MAIN else None


def lines(page: str | None) -> list[tuple[int, str]]:
    """(zone, text) of each block with text, in page order; character references are decoded, white space is one space.

    Every character of page is looked at a fixed number of times, however broken the markup is.
    """
    if not page:
        return []
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # name, zone outside, whether it hides what it holds
    opened: Counter = Counter()
    zone, hidden, at, size = PLAIN, 0, 0, len(page)
    unclosed: set[str] = set()  # raw elements known not to be closed any more
    strict = True

    def flush() -> None:
        if parts:
            text = parts[0] if len(parts) == 1 else "".join(parts)
            text = _SPACE.sub(" ", entities.unescape(text) if "&" in text else text).strip()
            parts.clear()
            if text:
                out.append((FRAME if zone == _FORM else zone, text))

    def pop() -> str:
        nonlocal zone, hidden
        name, before, hides = stack.pop()
        opened[name] -= 1
        hidden -= hides
        if before != zone:
            flush()
            zone = before
        return name

    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at and not hidden:
            parts.append(page[at:start])
        if start == size:
            break
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith("<![CDATA[", start):
            end = page.find("]]>", start + 9)
            if not hidden:
                parts.append(page[start + 9 : size if end < 0 else end])
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = size if end < 0 else end + 1
            continue
        m = _NAME.match(page, start + 1)
        if m is None:  # a bare <
            if not hidden:
                parts.append("<")
            at = start + 1
            continue
        closing, name = page[start + 1] == "/", m[1].lower()
        rest = _ATTRS.match(page, m.end()) if strict else None
        if rest is None:
            # quotes don't pair up to the end of the page: from here on a tag ends at the first >
            strict = False
            end = page.find(">", m.end())
            if end < 0:
                if not hidden:
                    parts.append(page[start:])
                break
        else:
            end = rest.end() - 1
        attrs, at = page[m.end() : end], end + 1
        if closing:
            if name not in _INLINE and name not in _HIDDEN and not hidden:
                flush()
            if opened[name]:
                while pop() != name:
                    pass
            continue
        if stack and stack[-1][0] == "head" and name not in _HEAD:
            pop()
        if name in _RAW:
            if name not in ("script", "style") and not hidden:
                flush()
            if name not in unclosed:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                if end:
                    at = end.end()
                elif name in ("script", "style"):
                    break
                else:
                    unclosed.add(name)
            continue
        block = name not in _INLINE and name not in _HIDDEN and not hidden
        if block:
            flush()
        if name in _VOID or (attrs and _SELF_CLOSED.search(attrs)):
            continue
        if stack and name in _CLOSES and stack[-1][0] in _CLOSES[name]:
            pop()
        if block and stack and stack[-1][0] == "p":
            pop()
        own = -1 if name in _HIDDEN else _zone(name, attrs, zone) if attrs or name in _FRAME or name in _MAIN else None
        stack.append((name, zone, own == -1))
        opened[name] += 1
        if own == -1:
            hidden += 1
        elif own is not None and zone != FRAME and own != zone and (zone != _FORM or own == MAIN):
            flush()
            zone = own
    flush()
    return out


def shared(a: list[str], b: list[str]) -> set[int]:
    """Places in a of a longest common subsequence with b, by bit-parallel dynamic programming over b.

    Every root-th row is kept and the rows between are computed again on the way back, so that memory grows with the
    root of the number of lines times their number.
    """
    begin, enda, endb = 0, len(a), len(b)
    while begin < min(enda, endb) and a[begin] == b[begin]:
        begin += 1
    while enda > begin and endb > begin and a[enda - 1] == b[endb - 1]:
        enda, endb = enda - 1, endb - 1
    out = {*range(begin), *range(enda, len(a))}
    places: dict[str, int] = {}
    for i in range(begin, enda):
        places[a[i]] = places.get(a[i], 0) | 1 << (i - begin)
    width = enda - begin
    full = (1 << width) - 1
    kept = [places[b[j]] for j in range(begin, endb) if b[j] in places]
    step = max(1, int(len(kept) ** 0.5))

    def after(row: int, places_of: int) -> int:
        matched = row & places_of
        return ((row + matched) | (row - matched)) & full

    row, marks = full, []
    for j, own in enumerate(kept):
        if j % step == 0:
            marks.append(row)
        row = after(row, own)
    # a zero bit i in row j: the subsequence of a[:i+1] and b[:j+1] is longer than that of a[:i] and b[:j+1]
    i, j, first, rows = width - 1, len(kept) - 1, len(kept), []
    while i >= 0 and j >= 0:
        if j < first or not rows:
            first = j // step * step
            rows, row = [], marks[j // step]
            for own in kept[first : j + 1]:
                rows.append(row)  # before line j
                row = after(row, own)
            rows.append(row)
        if rows[j - first + 1] >> i & 1:
            i -= 1
        elif not rows[j - first] >> i & 1:
            j -= 1
        else:
            out.add(begin + i)
            i, j = i - 1, j - 1
    return out


def deleted(own: list[tuple[int, str]], others: list[list[tuple[int, str]]]) -> set[int]:
    """Places of lines that the neighbours share as frame.

    A pair that shares over COPIES_SHARE of what markup leaves open or calls text (in characters) is a pair of copies: then only
    what all neighbours share goes.
    """
    texts = [t for _, t in own]
    open_ = {i for i, (zone, _) in enumerate(own) if zone != FRAME}
    whole = sum(len(texts[i]) for i in open_)
    gone: set[int] = set()
    common: set[int] | None = None
    for other in others:
        same = shared(texts, [t for _, t in other]) & open_
        common = same if common is None else common & same
        if sum(len(texts[i]) for i in same) <= COPIES_SHARE * whole:
            gone |= same
    if len(others) > 1 and sum(len(texts[i]) for i in common) <= COPIES_SHARE * whole:
        gone |= common
    return {i for i in gone if own[i][0] != MAIN}


def main_text(own: list[tuple[int, str]], *others: list[tuple[int, str]]) -> str:
    """The lines that neither markup nor the neighbours call frame: those of articles if they hold half of what is left, else all."""
    gone = deleted(own, [*others]) if others else set()
    left = [(zone, text) for i, (zone, text) in enumerate(own) if zone != FRAME and i not in gone]
    main = [(zone, text) for zone, text in left if zone in (MAIN, DOUBT)]
    if 2 * sum(len(t) for _, t in main) >= sum(len(t) for _, t in left):
        left = main
    # where neighbours share all there is, the lines that aren't frame by markup stay
    return "\n".join(text for _, text in left or [x for x in own if x[0] != FRAME])


def split_url(url: str | None) -> tuple[str, str]:
    """(host without www and port, path) by plain text operations, so that no URL is too odd."""
    rest = (url or "").strip().split("#")[0].split("?")[0]
    rest = rest.partition("://")[2] if "://" in rest else rest.lstrip("/")
    host, _, path = rest.partition("/")
    return host.rpartition("@")[2].split(":")[0].lower().removeprefix("www."), "/" + path.rstrip("/")


Line = tuple[int, str]
_PARSED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string()), ("stretch", pa.int32()), ("name", pa.binary()), ("zones", pa.binary()), ("lines", pa.string())])
_ORDER = ("host", "path", "url", "page_id", "name")
_EDGE = pa.schema([*(_PARSED.field(c) for c in (*_ORDER, "zones", "lines")), ("edge", pa.binary())])
_EDGE_PAGE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("edge", pa.binary())])
_EDGE_TEXT = pa.schema([("edge", pa.binary()), ("text", pa.string())])
EXTRACTED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


class _Run:
    """Neighbouring pages of one host with equal lines: they are as one page to their neighbours."""

    __slots__ = ("key", "path", "zones", "text", "pages")

    def __init__(self, host: str, name: bytes, path: str, zones: bytes, text: str) -> None:
        self.key, self.path, self.zones, self.text = (host, name), path, zones, text
        self.pages: list[tuple[int | None, str | None]] = []

    def lines(self) -> list[Line]:
        return list(zip(self.zones, self.text.split("\n"), strict=True)) if self.zones else []


def _runs(batches) -> Iterator[tuple[int, _Run]]:
    """(stretch, run) of sorted rows; the ids of a run are held, its lines once."""
    run, here = None, -1
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids, urls, hosts, names, stretches = (part.column(c).to_pylist() for c in ("page_id", "url", "host", "name", "stretch"))
            for i, key in enumerate(zip(hosts, names, strict=True)):
                if run is None or run.key != key or stretches[i] != here:
                    if run is not None:
                        yield here, run
                    run, here = _Run(*key, *(part.column(c)[i].as_py() for c in ("path", "zones", "lines"))), stretches[i]
                run.pages.append((ids[i], urls[i]))
    if run is not None:
        yield here, run


def _edge(run: _Run, last: bool) -> bytes:
    """Names an edge by the first page of its run: pages that are the same in all that orders them are in one stretch."""
    return xxhash.xxh3_128_digest(repr((run.key, run.path, run.pages[0], last)).encode("utf-8", "surrogatepass"))


def _text(before: _Run | None, here: _Run, after: _Run | None) -> str:
    return main_text(here.lines(), *(x.lines() for x in (before, after) if x is not None and x.key[0] == here.key[0]))


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def made():
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str | bytes))
        if len(held) >= most or size > 4 << 20:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def _inner(batches):
    """Final rows of all runs but the first and the last of each stretch."""

    def rows():
        for _, runs in groupby(_runs(batches), key=itemgetter(0)):
            before = here = None
            for _, after in runs:
                if before is not None:
                    text = _text(before, here, after)
                    yield from ((page_id, url, text, len(text)) for page_id, url in here.pages)
                before, here = here, after

    return _batches(rows(), EXTRACTED)


def _edge_runs(batches):
    """The first two and the last two runs of each stretch; the first and the last bear the name of their edge."""

    def rows():
        for _, runs in groupby(_runs(batches), key=itemgetter(0)):
            head: list[_Run] = []
            tail: list[_Run] = []
            for _, run in runs:
                run.pages = run.pages[:1]
                if len(head) < 2:
                    head.append(run)
                else:
                    tail = [*tail, run][-2:]
            found = head + tail
            for n, run in enumerate(found):
                page_id, url = run.pages[0]
                edge = _edge(run, n > 0) if n in (0, len(found) - 1) else None
                yield run.key[0], run.path, url, page_id, run.key[1], run.zones, run.text, edge

    return _batches(rows(), _EDGE)


def _edge_pages(batches):
    """The pages of each stretch's first and last run, with the name of their edge."""

    def rows():
        for _, runs in groupby(_runs(batches), key=itemgetter(0)):
            first = last = None
            for _, run in runs:
                if first is None:
                    first = run
                    edge = _edge(run, False)
                    yield from ((*page, edge) for page in run.pages)
                last = run
            if last is not first:
                edge = _edge(last, True)
                yield from ((*page, edge) for page in last.pages)

    return _batches(rows(), _EDGE_PAGE, 4096)


def _edge_texts(batches):
    """The text of each edge, with its neighbours in other stretches: one walk over the sorted edges."""

    def rows():
        before = here = None
        edges: list[bytes] = []
        for batch in batches:
            for row in batch.to_pylist():
                after = _Run(*(row[c] for c in ("host", "name", "path", "zones", "lines")))
                if here is None or here.key != after.key:
                    if edges:
                        text = _text(before, here, after)
                        yield from ((edge, text) for edge in edges)
                    before, here, edges = here, after, []
                if row["edge"] is not None:
                    edges.append(row["edge"])
        if edges:
            text = _text(before, here, None)
            yield from ((edge, text) for edge in edges)

    return _batches(rows(), _EDGE_TEXT)


def _place(url: str | None, page_id: int | None) -> tuple:
    """Where a page stands; as Spark orders host, path, url and page_id, nulls first."""
    return (*split_url(url), url is not None, url or "", page_id is not None, page_id or 0)


def _borders(pages: DataFrame, stretches: int) -> list[tuple]:
    """About stretches - 1 places that part the pages evenly: every SAMPLED-th of a sample by hash of url and page_id."""
    wanted = stretches * SAMPLED
    every = max(1, pages.count() // wanted)
    drawn = pages.select("url", "page_id").where(F.pmod(F.xxhash64("url", "page_id"), F.lit(every)) == 0).distinct()
    places = sorted(_place(r["url"], r["page_id"]) for r in drawn.limit(2 * wanted).collect())  # 2 * SAMPLED * MOST_STRETCHES at most
    return places[SAMPLED::SAMPLED]


def extract(pages: DataFrame, stretches: int | None = None) -> DataFrame:
    """page_id, url, text (blocks joined by newlines, empty if none) and n_chars of each page.

    Null or empty html gives empty text; a null url counts as an empty one (its pages are neighbours); null ids stay;
    repeated rows each give a row; neighbours of equal lines are differenced as one page; an empty table gives none; other columns are
    not read. A page without a neighbour on its host keeps all lines that markup doesn't rule out. The result is the same
    for any number of stretches (by default STRETCHES for each task, of which there is one for TASK_BYTES of the input, the session's
    shuffle partitions at least).
    """
    spark = pages.sparkSession
    pages = pages.select(pages["page_id"].cast("long").alias("page_id"), "url", "html")
    size = int(str(pages._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size < 1 << 60  # where Spark knows no size it takes one beyond all tables
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(size // TASK_BYTES, MOST_STRETCHES) if known else 1)
    stretches = stretches or min(STRETCHES * tasks, MOST_STRETCHES)
    borders = spark.sparkContext.broadcast(_borders(pages, stretches))  # MOST_STRETCHES urls at most

    def parsed():
        def f(batch):
            ids, urls, found = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [lines(p) for p in batch.column(2).to_pylist()]
            places = [_place(u, i) for u, i in zip(urls, ids, strict=True)]
            stretch = [bisect_right(borders.value, p) for p in places]
            zones, texts = [bytes(z for z, _ in x) for x in found], ["\n".join(t for _, t in x) for x in found]
            names = [xxhash.xxh3_128_digest(z + b"\n" + t.encode("utf-8", "surrogatepass")) for z, t in zip(zones, texts, strict=True)]
            return [batch.column(0), batch.column(1), [p[0] for p in places], [p[1] for p in places], stretch, names, zones, texts]

        return f

    dealt = map_batches(pages, _PARSED, parsed).repartition(tasks, "stretch").sortWithinPartitions("stretch", *_ORDER)
    edges = dealt.mapInArrow(_edge_runs, from_arrow_schema(_EDGE)).repartition(1).sortWithinPartitions(*_ORDER)  # four pages a stretch
    texts = edges.mapInArrow(_edge_texts, from_arrow_schema(_EDGE_TEXT))
    at_edge = dealt.mapInArrow(_edge_pages, from_arrow_schema(_EDGE_PAGE)).join(texts, "edge").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    return dealt.mapInArrow(_inner, from_arrow_schema(EXTRACTED)).unionAll(at_edge)
