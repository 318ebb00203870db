"""Main text of web pages by differencing the nearest URLs.

A page is cut into text blocks in page order. Every page is paired with the page of the same host whose URL path is
nearest in path order (the longer common beginning, the earlier one at a tie) and whose content is another one; the lines of both are
aligned by longest common subsequence, and lines that both share are deleted, since a template repeats while an article doesn't. Where
the page on the other side has a line of the template too, only lines that it shares as well go: a quotation in two stories stays.
Lines inside an element marked as the main text (an article, else main, else a container named so) stay although they are shared.

An exact check follows, for what a template fills anew on every page: lines go that are left in containers whose tag, or a whole class or
id, names their role (menus, headers, footers, sidebars, notices, adverts, forms, comments), up to their end tag or, where it is omitted, to the
next of the row or the end of what holds them. `n_shared` counts the lines that differencing deleted, `n_named` those that the check did. Scripts, styles
and titles hold no lines.

Pages whose lines outside such containers are nearly the same (ALIKE) say nothing about a template and are passed over: copies of one story under two URLs would
otherwise lose their text. Of each side the nearest WINDOW different contents are looked at; where all of them are alike, the side has
no pair.

Pages move once, as lines, in runs of neighbouring (host, path, page id) of about RUN_BYTES, however many pages a host or a URL has, a partition
each; a run carries the nearest contents before and after it, which the driver finds from a few (place, hash) of each of at most MOST_RUNS
runs. What a page is paired with doesn't depend on the runs. The alignment keeps every k-th row of its table and works the rows between out again.

Edge cases: null html is empty text; a null or odd URL belongs to the empty host; a host's only page has no pair; repeated pages are
no pairs and lose no line by each other; crossed tags are taken as they come, a tag that doesn't close is text; texts have any length and are read in
linear time; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_of, partitions, small_batches

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose whole content is never text of the article.
DROPPED = frozenset("script style noscript template head nav footer aside form button select textarea iframe object svg canvas audio video dialog menu title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ROLES = (
    "(?:ads?|adverts?|advertisements?|banners?|promos?|sponsored|sponsor|sidebars?|side|menus?|nav|navbar|navigation|breadcrumbs?|header|footer|masthead|"
    "comments?|disqus|replies|notices?|cookies?|consent|gdpr|popup|modal|newsletter|subscribe|signup|login|search|share|social|related|recommended|widget|toolbar|pagination|pager)"
)
_PLACES = "(?:site|page|global|main|top|bottom|left|right|primary|secondary|sticky|mobile|desktop|user|post|entry|article)"
_PARTS = "(?:list|items?|box|bar|area|block|section|slot|unit|links?|buttons?|icons?|form|container|wrapper|wrap|inner|outer|content|body|text|\\d+)"
#: A whole class or id that names a role; the words around it tell the place or a part, never what a page is without or about.
ROLE = re.compile(f"(?!(?:post|entry|article)[_-]+header)(?:{_PLACES}[_-]+)*{_ROLES}(?:[_-]+(?:{_ROLES}|{_PLACES}|{_PARTS}))*", re.I)
#: Elements that hold others; inside the main text only these are left out by name.
CONTAINERS = frozenset("div section ul ol dl table center details fieldset figure li dd td th tr".split())
HEADINGS = frozenset(f"h{i}" for i in range(1, 7))
#: What stands between a tag's name and its end; an open angle outside quotes ends no tag, so a tag that doesn't close is given up there and read as text.
_REST = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+"
#: Comments, declarations and scripts that don't close go on to the end. No character is read again from more than two places.
_token = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|textarea|title)\b{_REST}>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s<>/]*+)({_REST})>|<[!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_pair = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Names (class, id) of containers of the main text, for pages without article and main.
NAMED = frozenset(
    "content main main-content maincontent page-content article article-body article-content article-text post post-body post-content "
    "entry entry-content entry-body story story-body story-content".split()
)
#: An end tag in front of which these elements stay open, since stray end tags are frequent.
FIRM = frozenset(("article", "main"))
#: Elements that end where one of the same row begins, and those that hold such rows.
SIBLINGS = {k: frozenset(group.split()) for group in ("li", "dt dd", "td th", "tr", "tbody thead tfoot", "option") for k in group.split()}
HOLDERS = frozenset("ul ol menu dir dl table select article main section body".split())
#: How many different contents on each side are looked at, and the share of characters in common lines, in hundredths, from which two pages are copies.
WINDOW, ALIKE = 8, 90
#: Bytes of html in a run, and how many runs there are at most.
RUN_BYTES, MOST_RUNS = 32 << 20, 20_000
#: What a line is: text, marked as main text, or in a container that names another role.
PLAIN, MAIN, NAMED_OTHER = "012"


def _attributes(text: str) -> dict[str, str]:
    """Attributes by name; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in _pair.findall(text):
        found.setdefault(name.lower(), "".join(values))
    return found


def _rank(tag: str, attributes: str) -> int:
    """How plainly an element is marked as the main text."""
    if tag == "article":
        return 3
    if tag == "main":
        return 2
    if tag in ("html", "body") or not attributes:
        return 0
    has = _attributes(attributes)
    if has.get("role", "").lower() in ("main", "article") or "articlebody" in has.get("itemprop", "").lower().split():
        return 2
    return int(tag in BLOCKS and not NAMED.isdisjoint(f"{has.get('class', '')} {has.get('id', '')}".lower().split()))


class _Open:
    """The open block elements, each with the highest rank around it."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.ranks: list[int] = []
        self.count: Counter[str] = Counter()

    def rank(self) -> int:
        return self.ranks[-1] if self.ranks else 0

    def cut(self, n: int) -> None:
        for tag in self.tags[n:]:
            self.count[tag] -= 1
        del self.tags[n:], self.ranks[n:]

    def make_room(self, tag: str) -> None:
        """Ends what the start of a block element ends."""
        if self.tags and self.tags[-1] in ("p", "head"):
            self.cut(len(self.tags) - 1)
        same = SIBLINGS.get(tag, ())
        if any(self.count[x] for x in same):
            for i in range(len(self.tags) - 1, -1, -1):
                if self.tags[i] in same:
                    self.cut(i)
                    break
                if self.tags[i] in HOLDERS:
                    break

    def start(self, tag: str, rank: int) -> None:
        self.tags.append(tag)
        self.ranks.append(max(rank, self.rank()))
        self.count[tag] += 1

    def end(self, tag: str, level: int) -> None:
        """Ends the innermost such element and all in it; what is left out (from `level` on) holds nothing firm."""
        if self.count[tag]:
            for i in range(len(self.tags) - 1, -1, -1):
                if self.tags[i] == tag:
                    self.cut(i)
                    break
                if i < level and self.tags[i] in FIRM and tag not in FIRM and tag not in ("body", "html"):
                    break


def _named(tag: str, has: dict[str, str], around: _Open) -> bool:
    """Whether a class or id names an unwanted role. Headings, and what stands in a line of text, have no such names."""
    block = around.tags[-1] if around.tags else ""
    inside = around.rank() > 0
    if tag in HEADINGS or inside and (tag not in CONTAINERS or block in HEADINGS) or tag not in BLOCKS and (block == "p" or block in HEADINGS):
        return False
    names = has.get("class", "").split()
    if not inside or tag != "section":  # a section's id in the main text is the anchor of its heading
        names += has.get("id", "").split()
    return any(ROLE.fullmatch(x) and not (inside and x.lower() in ("header", "masthead")) for x in names)


def _unwanted(tag: str, attributes: str, around: _Open) -> bool:
    if tag in DROPPED or tag == "header" and around.rank() < 2:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    has = _attributes(attributes)
    return (
        _named(tag, has, around)
        or has.get("role", "").lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar")
        or "hidden" in has
        or has.get("aria-hidden", "").lower() == "true"
        or bool(re.search(r"display\s*:\s*none", has.get("style", ""), re.I))
    )


def blocks(page: str) -> tuple[list[str], str]:
    """Text of every block, and for each what it is: MAIN stands in what the page marks most plainly as its main text, NAMED_OTHER in an unwanted container."""
    lines: list[str] = []
    ranks: list[int] = []  # -1 in an unwanted container
    open_text: list[str] = []
    around = _Open()
    skip, level = "", 0  # an element that is left out, and how many are open around it
    at = 0

    def close() -> None:
        if open_text:
            # references are decoded piece by piece: markup cuts a reference off
            line = " ".join("".join(open_text).split())
            open_text.clear()
            if line:
                lines.append(line)
                ranks.append(-1 if skip else around.rank())

    for m in _token.finditer(page):
        if m.start() > at:
            open_text.append(html.unescape(page[at : m.start()]))
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        closing = bool(m[2])
        alone = tag in VOID or m[4].endswith("/")
        if tag in BLOCKS:
            close()
        elif tag == "br":
            open_text.append(" ")
        if closing:
            around.end(tag, level if skip else len(around.tags))
        elif tag in BLOCKS:
            around.make_room(tag)
        if skip and len(around.tags) <= level:
            close()
            skip = ""
        if closing or alone:
            continue
        if skip:
            if tag in BLOCKS or tag in DROPPED or tag == skip:
                around.start(tag, 0)
        elif _unwanted(tag, m[4], around):
            close()
            skip, level = tag, len(around.tags)
            around.start(tag, 0)
        elif tag in BLOCKS:
            around.start(tag, _rank(tag, m[4]))
    if at < len(page):
        open_text.append(html.unescape(page[at:]))
    close()
    best = max(ranks, default=0)
    return lines, "".join(NAMED_OTHER if x < 0 else MAIN if 0 < x == best else PLAIN for x in ranks)


def shared_lines(mine: list[str], other: list[str]) -> set[int]:
    """Positions in `mine` of a longest common subsequence with `other`.

    Rows of the table are bit strings: a zero bit marks where the subsequence grows. Only every k-th row is kept, k near the root of
    their number; the way back works out the k rows that it passes again.
    """
    width = len(other)
    where: dict[str, int] = {}
    for j, line in enumerate(other):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << width) - 1

    def below(row: int, line: str) -> int:
        hit = row & where.get(line, 0)
        return ((row + hit) | (row - hit)) & full

    step = max(1, math.isqrt(len(mine)))
    kept, row = [full], full
    for i, line in enumerate(mine, 1):
        row = below(row, line)
        if i % step == 0:
            kept.append(row)
    found, j = set(), width
    for start in range((len(mine) - 1) // step * step, -1, -step):
        rows = [kept[start // step]]
        for line in mine[start : min(start + step, len(mine))]:
            rows.append(below(rows[-1], line))
        i = len(rows) - 1
        while i and j:
            if rows[i] >> (j - 1) & 1:
                j -= 1
                continue
            i -= 1
            if rows[i] >> (j - 1) & 1:
                found.add(start + i)
                j -= 1
    return found


def alike(mine: list[str], own: str, other: list[str], others: str, shared: set[int]) -> bool:
    """Whether two pages are (nearly) the same, by the characters of the lines at the `shared` positions of `mine`, apart from unwanted containers."""
    size = lambda lines, kinds: sum(len(x) for x, k in zip(lines, kinds, strict=True) if k != NAMED_OTHER)
    return 200 * sum(len(mine[i]) for i in shared if own[i] != NAMED_OTHER) >= ALIKE * (size(mine, own) + size(other, others))


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


@dataclass
class Page:
    """A page in order: its key, the hash of its content (lines outside unwanted containers), its lines and what they are."""

    key: str
    content: int
    lines: list[str]
    own: str
    row: tuple | None = None
    at: int = 0
    before: tuple[str, set[int]] | None = None


class _Neighbours:
    """Pages of one host in order; gives each page's text as soon as its pairs are known.

    Holds the last different contents, and pages whose next pair has not come yet: equal pages share their lines, and a page
    waits for WINDOW different contents at most.
    """

    def __init__(self) -> None:
        self.recent: dict[int, Page] = {}  # the last page of each content, oldest first
        self.waiting: dict[int, deque[Page]] = {}
        self.known: dict[tuple[int, int], tuple[list, list, set[int], bool]] = {}
        self.at = 0

    def compare(self, a: Page, b: Page) -> tuple[set[int], bool]:
        """Shared positions of a, and whether the two are copies. Pages that share their list of lines are compared once."""
        key = id(a.lines), id(b.lines)
        got = self.known.get(key)
        if got is None:
            if len(self.known) > 16 * WINDOW:
                self.known.clear()
            shared = shared_lines(a.lines, b.lines)
            got = self.known[key] = a.lines, b.lines, shared, alike(a.lines, a.own, b.lines, b.own, shared)  # the lists stay alive with their ids
        return got[2], got[3]

    def settle(self, page: Page, after: tuple[str, set[int]] | None) -> tuple:
        near = sorted((x for x in (page.before, after) if x), key=lambda x: -_common(x[0], page.key))  # stable: the earlier one at a tie
        gone = near[0][1] if near else set()
        if len(near) == 2 and gone & near[1][1]:
            gone = gone & near[1][1]
        left = [i for i in range(len(page.lines)) if page.own[i] == MAIN or i not in gone]
        kept = [page.lines[i] for i in left if page.own[i] != NAMED_OTHER]
        text = "\n".join(kept)
        return *page.row, text, len(text), len(page.lines) - len(left), len(left) - len(kept)

    def add(self, page: Page) -> Iterator[tuple]:
        """The next page; its row is (page_id, url) where its text is wanted."""
        c = page.content
        for d in [d for d in self.waiting if d != c]:
            stay: deque[Page] = deque()
            for waiting in self.waiting[d]:
                shared, copy = self.compare(waiting, page)
                if copy:
                    stay.append(waiting)
                else:
                    yield self.settle(waiting, (page.key, shared))
            if stay:
                self.waiting[d] = stay
            else:
                del self.waiting[d]
        self.at += 1
        page.at = self.at
        last = self.recent.pop(c, None)
        if last and last.lines == page.lines and last.own == page.own:
            page.lines, page.own = last.lines, last.own
        self.recent[c] = page
        if len(self.recent) > WINDOW + 2:
            del self.recent[next(iter(self.recent))]
        for d, pages in list(self.waiting.items()):
            ends = sorted((x.at for k, x in self.recent.items() if k != d), reverse=True)
            while pages and len(ends) >= WINDOW and ends[WINDOW - 1] > pages[0].at:
                yield self.settle(pages.popleft(), None)
            if not pages:
                del self.waiting[d]
        if page.row:
            for d in [k for k in reversed(self.recent) if k != c][:WINDOW]:
                shared, copy = self.compare(page, self.recent[d])
                if not copy:
                    page.before = self.recent[d].key, shared
                    break
            self.waiting.setdefault(c, deque()).append(page)

    def end(self) -> Iterator[tuple]:
        for pages in self.waiting.values():
            yield from (self.settle(page, None) for page in pages)


PARSED = "page_id long, url string, _place string, lines string, own string, _c long"
ENDS = "_run int, one boolean, head array<struct<k:string,c:long>>, tail array<struct<k:string,c:long>>"
EXTRACTED = "page_id long, url string, text string, n_chars long, n_shared long, n_named long"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of every page, what each is, and the hash of those outside unwanted containers."""
    for batch in batches:
        texts, owns, hashes = [], [], []
        for page in batch.column("html"):
            lines, own = blocks(page.as_py())
            texts.append("\n".join(lines))
            owns.append(own)
            content = "\n".join(x for x, k in zip(lines, own, strict=True) if k != NAMED_OTHER)
            hashes.append(int.from_bytes(hashlib.blake2b(content.encode(), digest_size=8).digest(), "big", signed=True))
        kept = [batch.column(c).cast(k) for c, k in (("page_id", pa.int64()), ("url", pa.string()), ("_place", pa.string()))]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array(owns, pa.string()), pa.array(hashes, pa.int64())], ["page_id", "url", "_place", "lines", "own", "_c"])


def _host(key: str) -> str:
    return key.split("\n")[0]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every run the first contents of its first host and the last ones of its last host, nearest to the end first."""
    made, run, host = [], None, None
    head: dict[int, str] = {}
    tail: dict[int, str] = {}
    one = True

    def flush() -> None:
        if run is not None:
            made.append({"_run": run, "one": one, "head": [{"k": k, "c": c} for c, k in head.items()], "tail": [{"k": k, "c": c} for c, k in reversed(tail.items())]})

    for batch in batches:
        for r, key, c in zip(*(batch.column(x).to_pylist() for x in ("_run", "_place", "_c")), strict=True):
            if r != run:
                flush()
                run, host, head, tail, one = r, _host(key), {}, {}, True
            if _host(key) != host:
                host, tail, one = _host(key), {}, False
            if one and len(head) <= WINDOW:
                head.setdefault(c, key)
            tail.pop(c, None)
            tail[c] = key
            if len(tail) > WINDOW + 1:
                del tail[next(iter(tail))]
    flush()
    if made:
        ends = pa.list_(pa.struct([("k", pa.string()), ("c", pa.int64())]))
        yield pa.RecordBatch.from_pylist(made, pa.schema([("_run", pa.int32()), ("one", pa.bool_()), ("head", ends), ("tail", ends)]))


def _guests(runs: list) -> dict[tuple[str, int], list[tuple[int, int]]]:
    """For (key, content): the runs it visits, and on which side (-1 before, 1 after)."""
    visits: dict[tuple[str, int], list[tuple[int, int]]] = {}
    runs = sorted(runs, key=lambda x: x["_run"])
    for i, run in enumerate(runs):
        for side, mine, theirs, others in ((-1, "head", "tail", range(i - 1, -1, -1)), (1, "tail", "head", range(i + 1, len(runs)))):
            host, found = _host(run[mine][0]["k"]), {}
            for j in others:
                if _host(runs[j][theirs][0]["k"]) != host:
                    break
                for x in runs[j][theirs]:
                    if len(found) <= WINDOW:
                        found.setdefault(x["c"], x["k"])
                if len(found) > WINDOW or not runs[j]["one"]:
                    break
            for c, key in found.items():
                visits.setdefault((key, c), []).append((run["_run"], side))
    return visits


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the own rows of each run."""

    def batch_of(made: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], [x.split()[0] for x in EXTRACTED.split(", ")])

    where, near = None, _Neighbours()
    for batch in batches:
        made: list[tuple] = []
        for page_id, url, place, text, own, c, run, guest in zip(*(batch.column(x).to_pylist() for x in ("page_id", "url", "_place", "lines", "own", "_c", "_run", "_guest")), strict=True):
            if (run, _host(place)) != where:
                made += near.end()
                where, near = (run, _host(place)), _Neighbours()
            made += near.add(Page(place.rsplit("\1", 1)[0], c, text.split("\n") if own else [], own, (page_id, url) if guest == 0 else None))
        if made:
            yield batch_of(made)
    if made := list(near.end()):
        yield batch_of(made)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points), n_shared and n_named of every page."""
    spark = pages.sparkSession
    small_batches(spark, 256)
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    key = F.coalesce(F.concat(host, F.lit("\n"), path), F.lit("\n"))
    # pages of one URL stand by id, so that a run can end between them
    half = F.lit(str(1 << 63)).cast("decimal(20,0)")
    number = F.lpad((F.coalesce(F.col("page_id").cast("decimal(20,0)"), -half) + half).cast("string"), 20, "0")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), F.concat(key, F.lit("\1"), number).alias("_place"))
    total = rows.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    most = min(max(partitions(spark), -(-total // RUN_BYTES)), MOST_RUNS)
    found = rows.select("_place").repartitionByRange(most, "_place").groupBy(F.spark_partition_id().alias("p")).agg(F.min("_place").alias("lo")).collect()
    firsts = sorted({r["lo"] for r in found})
    runs = max(1, len(firsts))
    parsed = rows.mapInArrow(_parse, PARSED).withColumn("_run", bucket_of(F.col("_place"), firsts, "string"))
    # pages are parsed twice: the first time only hashes move
    ends = parsed.select("_run", "_place", "_c").repartitionById(runs, F.col("_run")).sortWithinPartitions("_run", "_place", "_c").mapInArrow(_ends, ENDS)
    visits = _guests(ends.collect())
    own = F.array(F.struct(F.col("_run").alias("r"), F.lit(0).alias("g")))
    if visits:
        guests = spark.createDataFrame([(k, c, v) for (k, c), v in visits.items()], "_place string, _c long, _visits array<struct<r:int,g:int>>")
        parsed = parsed.join(F.broadcast(guests), ["_place", "_c"], "left")
        own = F.concat(own, F.coalesce("_visits", F.array().cast("array<struct<r:int,g:int>>")))
    spread = parsed.withColumn("_to", F.explode(own)).withColumns({"_run": F.col("_to.r"), "_guest": F.col("_to.g")})
    moved = spread.select("page_id", "url", "_place", "lines", "own", "_c", "_run", "_guest").repartitionById(runs, F.col("_run"))
    return moved.sortWithinPartitions("_run", "_guest", "_place", "_c").mapInArrow(_texts, EXTRACTED)
