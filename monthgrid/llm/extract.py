"""Main text of web pages: block parsing, and nearest-URL page differencing for what the mark-up leaves open.

Pages are sorted by host and path, so that a page's neighbours in its partition are the pages of its host with the nearest URLs.
Each page is paired with the neighbour whose path shares the longer prefix; exact copies of a page are passed over, because they share
every line. The text lines of the two are aligned by longest common subsequence and shared lines are deleted as template text.

Lines that the mark-up itself settles are not left to the comparison: what stands in menus, headers, footers, asides, forms,
scripts, adverts, notices and comment lists goes (inside an article only by class names that cannot be its topic) whatever the neighbour
holds, and where a page has an explicit <article> (or <main>), so does what stands outside it. Differencing decides on all other lines.
Articles of one host quote the same passages and those are text, so in an article a shared line goes only if the ``AROUND`` nearest
different pages on either side have it too, in the same order; near copies of the page are not asked.

Sorting is by (host, path, id), so a host with a third of all pages spreads over many tasks; a task holds ``2 * AROUND + 1`` pages
at a time, and ids and URLs of their copies.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict, deque
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DROPPED = frozenset("head nav header footer aside form script style noscript template iframe svg canvas select button textarea object dialog menu".split())
BLOCKS = frozenset("p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr td th caption blockquote pre section article main "
                   "figure figcaption address hr details summary body html center fieldset header footer nav aside form".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that mark template parts. A word counts alone or between separators: ``ad``, ``ad-box``, not ``shadow``.
MARKED = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|sidebar|side-bar|menu|nav|navbar|navigation|"
                    r"breadcrumb|breadcrumbs|header|masthead|footer|cookie|cookies|consent|notice|notices|disclaimer|popup|modal|overlay|newsletter|subscribe|"
                    r"social|share|sharing|related|recommended|comment|comments|replies|discussion|widget|toolbar|pagination|skip|search|login|signup)(?:$|[\s_-])", re.I)
#: Inside an article ids are anchors of its headings and sections and most words above are topics: only whole classes that name
#: nothing but a template part count, and only on containers.
TEMPLATE = frozenset("ad ads advert adverts advertisement advertising ad-box ad-slot ad-unit ad-container ad-wrapper ad-banner sponsored breadcrumb breadcrumbs sidebar navbar "
                     "pagination cookie-banner cookie-notice newsletter-signup share-buttons social-share social-links sharing-buttons related-posts related-articles "
                     "comments comment-list comments-list comment-form comments-section".split())
CONTAINERS = frozenset("div section ul ol dl table figure p span".split())
#: Different pages on either side of a page that are looked at, and how many at least must share a line of an article for it to be template text.
AROUND = 4
#: Elements whose end tag may be left out, and the tags that end them.
IMPLIED = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}


class _Blocks(HTMLParser):
    """Text blocks in page order, each with its place: True inside article or main, False elsewhere; dropped parts leave none."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[bool, str]] = []
        self.open: list[tuple[str, bool, bool]] = []  # tag, starts a dropped part, starts an article
        self.dropped = self.articles = 0
        self.text: list[str] = []

    def flush(self):
        line = " ".join("".join(self.text).split())
        if line:
            self.found.append((self.articles > 0, line))
        self.text.clear()

    def pop(self):
        _, drop, article = self.open.pop()
        self.dropped -= drop
        self.articles -= article

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br":
                self.text.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
            inner = self.open and next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] in BLOCKS), None)
            if inner is not None and self.open and tag in IMPLIED.get(self.open[inner][0], ()):
                while len(self.open) > inner:
                    self.pop()
        if self.articles:
            named = tag in CONTAINERS and any(k == "class" and v and not TEMPLATE.isdisjoint(v.lower().split()) for k, v in attrs)
        else:
            named = bool(MARKED.search(" ".join(v for k, v in attrs if k in ("class", "id", "role") and v)))
        hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)
        article = tag in ("article", "main")
        drop = tag in DROPPED or hidden or named and not article and tag not in ("body", "html")
        if drop and not self.dropped:
            self.flush()
        self.open.append((tag, drop, article))
        self.dropped += drop
        self.articles += article

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if tag in BLOCKS:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.flush() if any(x[1] for x in self.open[i:]) else None
                while len(self.open) > i:
                    self.pop()
                break
            if self.open[i][0] in ("article", "main", "body") and tag not in ("article", "main", "body", "html"):
                break  # a stray end tag does not close the article around it

    def handle_data(self, data):
        if not self.dropped:
            self.text.append(data)


def blocks(html: str | None) -> list[tuple[bool, str]]:
    """(inside article or main, text) of each block that the mark-up does not drop."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.found


def _columns(a: list[str], b: list[str]) -> int:
    """Bit j is 0 where b[j] makes the longest common subsequence of ``a`` and the lines of ``b`` up to there longer."""
    match = defaultdict(int)
    for j, line in enumerate(b):
        match[line] |= 1 << j
    v = every = (1 << len(b)) - 1
    for line in a:
        u = v & match.get(line, 0)
        v = (v + u | v - u) & every
    return v


def _halved(a: list[str], b: list[str], at: int = 0) -> set[int]:
    """Positions, from ``at`` on, of a longest common subsequence: ``b`` is cut where it goes best with the halves of ``a``.

    Rows of bits stand for the tables of lengths, so many equal lines cost no more than different ones, and no table is kept.
    """
    if not a or not b:
        return set()
    if len(a) == 1:
        return {at} if a[0] in b else set()
    half = len(a) // 2
    ahead, back = _columns(a[:half], b), _columns(a[half:][::-1], b[::-1])
    cut, best = 0, len(b) - back.bit_count()
    length = best
    for j, (gained, lost) in enumerate(zip(f"{ahead:0{len(b)}b}"[::-1], f"{back:0{len(b)}b}"), 1):
        length += (gained == "0") - (lost == "0")
        if length > best:
            best, cut = length, j
    return _halved(a[:half], b[:cut], at) | _halved(a[half:], b[cut:], at + half)


#: Pairs of equal lines up to which they are worked off one by one.
PAIRS = 100_000


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``: the longest increasing run of match positions."""
    where = defaultdict(list)
    for j in range(len(b) - 1, -1, -1):
        where[b[j]].append(j)
    if sum(len(where.get(line, ())) for line in a) > PAIRS:
        return _halved(a, b)
    tails, links, heads = [], [], []  # smallest last position of a run of each length, and how to walk it back
    for i, line in enumerate(a):
        for j in where.get(line, ()):
            k = bisect_left(tails, j)
            node = (i, heads[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                heads.append(node)
            else:
                tails[k], heads[k] = j, node
    out, node = set(), heads[-1] if heads else None
    while node:
        out.add(node[0])
        node = node[1]
    return out


def main_text(own: list[tuple[bool, str]], other: list[tuple[bool, str]] | None, around: Sequence[list[tuple[bool, str]]] = ()) -> str:
    """The blocks that are not template text by comparison with the paired page: the article's, or all where no article is marked.

    Articles of a host quote the same passages, so a shared line of an article goes only if it is on the longest common subsequence with
    each of the pages around as well, ``AROUND`` at least. Pages that share three quarters of the article's lines are copies and have no say.
    """
    article = [line for inside, line in own if inside]
    lines = article or [line for _, line in own]
    theirs = [line for _, line in other or ()]
    shared = common_lines(lines, theirs)
    if article and shared:
        others = [common_lines(lines, [line for _, line in page]) for page in around]
        others = [x for x in others if 4 * len(x) < 3 * len(lines)]
        shared = shared.intersection(*others) if len(others) >= AROUND else set()
    return "\n".join(line for i, line in enumerate(lines) if i not in shared)


def _pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages arrive sorted; each is compared with the nearest different pages before and after it on its host."""
    before: deque[tuple[str, list]] = deque(maxlen=AROUND)  # (path, blocks) of the last different pages of the host
    waiting: list[tuple[str, list, list]] = []  # (host, blocks, pages) of each run of equal pages that waits for different ones after it
    done: list[tuple] = []

    def settle():
        _, own, pages = waiting.pop(0)
        after = [(x[2][0][2], x[1]) for x in waiting]
        texts: dict = {}
        for page_id, url, path in pages:
            near = enumerate([*list(before)[-1:], *after[:1]])
            which, other = max(near, key=lambda x: len(commonprefix([x[1][0], path])), default=(None, None))
            if which not in texts:
                texts[which] = main_text(own, other and other[1], [x[1] for x in (*before, *after)])
            done.append((page_id, url, texts[which], len(texts[which])))
            if len(done) >= 200:
                yield out()
        before.append((pages[-1][2], own))

    def out():
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
        rows = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*done)) or [()] * 4, schema)], schema=schema)
        done.clear()
        return rows

    for b in batches:
        for page_id, url, html, host, path in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "host", "path"))):
            own = blocks(html)
            if waiting and waiting[-1][0] != host:
                while waiting:
                    yield from settle()
                before.clear()
            if waiting and waiting[-1][1] == own:  # an equal page: it needs no second copy of its blocks
                waiting[-1][2].append((page_id, url, path))
                continue
            waiting.append((host, own, [(page_id, url, path)]))
            if len(waiting) > AROUND:
                yield from settle()
    while waiting:
        yield from settle()
    yield out()


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    Null and empty html give an empty text, never null. Pages without a URL form one host. Repeated rows are copies of each other
    and get the same text; other columns are not read. A neighbour is looked for within the task's range of URLs, so the first
    and last page of a range may have one neighbour only.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"),
                        F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)).alias("host"),
                        F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*|#.*$", "").alias("path"))
    return (rows.repartitionByRange(n, "host", "path", "page_id").sortWithinPartitions("host", "path", "page_id")
            .mapInArrow(_pair, "page_id bigint, url string, text string, n_chars bigint"))


def op7_page_differencing(spark, sf_dir) -> DataFrame:
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
