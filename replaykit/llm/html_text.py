"""Main text of web pages: block structure, then differencing against the nearest page of the host.

A page becomes text blocks in page order.  Scripts, styles, menus, headers, footers, sidebars, notices, adverts,
forms and comments are left out by element, role and class words.  The blocks of a marked article, or on a page without such a
mark all blocks, are its content, and page differencing decides on them: pages are sorted by host and URL path, each is paired
with the nearest page before or after it whose path shares more leading segments, their blocks are aligned by longest common
subsequence, and shared blocks are deleted as part of the site.  A page of the same content (by digest) is a copy and no
partner: the next page of the host that is none takes its place.  An article is compared with pages that mark one too, and loses
a line only if the pages on both sides have it and no two of the three are editions of one article.

Sorting is by range, so a host with a third of all pages is spread over many tasks.  The pages that a range needs from other
ranges, eight at most, are found on keys and digests first and join it as guests, so texts do not depend on the ranges.
Null html gives empty text; a null URL sorts first and is paired with nothing.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replaykit.session import written_table

RANGES_A_SPLIT = 8
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
LEFT_OUT = frozenset(
    "script style title textarea xmp iframe noembed noframes noscript template head nav aside footer form button select option input "
    "dialog menu svg canvas object audio video map datalist".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Pages that have more of the shorter article's lines in common are editions of one article.
EDITION = 0.8
CLASS_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adbox|sponsor\w*|promo\w*|banner\w*|sidebar\w*|menu\w*|nav|navbar|navigation|breadcrumb\w*|comments?|commentlist|"
    r"respond|disqus\w*|cookie\w*|consent|notice\w*|alert|popup|modal|overlay|newsletter|subscribe|signup|share|sharing|social|related|"
    r"recommend\w*|widget\w*|toolbar|pagination|pager|skip)(?:$|[\s_-])",
    re.I,
)
EDGE_WORDS = re.compile(r"(?:^|[\s_-])(?:header|masthead|footer)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


class Block(NamedTuple):
    text: str
    main: bool
    heading: bool = False


def _hidden(name: str, attributes: str, in_main: bool) -> bool:
    if name in LEFT_OUT or name == "header" and not in_main:
        return True
    if "=" not in attributes:
        return bool(re.search(r"(?:^|\s)hidden(?:\s|/|$)", attributes))
    held = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in held or held.get("aria-hidden") == "true" or held.get("role", "").lower() in ROLES:
        return True
    if name in ("body", "html", "main"):
        return False
    marks = f"{held.get('class', '')} {held.get('id', '')}"
    return bool(CLASS_WORDS.search(marks)) or not in_main and bool(EDGE_WORDS.search(marks))


def blocks(page: str) -> list[Block]:
    """The text blocks that are not left out, in page order."""
    out: list[Block] = []
    held: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # element, left out here or above, inside a main element
    at = 0

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append(Block(text, bool(open_) and open_[-1][2], any(e[0] in HEADINGS for e in open_)))
        held.clear()

    def say(text: str) -> None:
        if text and not (open_ and open_[-1][1]):
            held.append(html.unescape(text))

    while True:
        m = _TOKEN.search(page, at)
        if not m:
            say(page[at:])
            flush()
            return out
        say(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            flush()
        elif name == "br":
            say(" ")
        if m[1] or m[4]:
            depth = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name), None)
            if depth is not None:
                del open_[depth:]
            continue
        attributes = m[3] or m[6] or ""
        if name in VOID:
            continue
        off, main = (open_[-1][1], open_[-1][2]) if open_ else (False, False)
        hidden = _hidden(name, attributes, main)
        if name in ("article", "main") and not hidden:
            # a marked text inside an element that was never closed
            if off and not any(e[0] in ("aside", "form", "article") or e[2] for e in open_ if e[1]):
                off = False
            main = main or not off
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?|\Z", re.I).search(page, at)
            at = end.end()
            continue
        if not attributes.endswith("/"):
            open_.append((name, off or hidden, main))


def common_lines(left: list[str], right: list[str]) -> set[int]:
    """Places of ``left`` that are in a longest common subsequence with ``right``.

    Rows of the table are bit sets in whole numbers, so a row costs a few operations on len(left) bits.
    """
    where: dict[str, int] = {}
    for i, x in enumerate(left):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(left)) - 1
    row, rows = full, [full]
    for x in right:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    out = set()
    i, j = len(left), len(right)
    length = lambda i, j: i - (rows[j] & ((1 << i) - 1)).bit_count()
    while i and j:
        if left[i - 1] == right[j - 1]:
            out.add(i - 1)
            i, j = i - 1, j - 1
        elif length(i - 1, j) >= length(i, j - 1):
            i -= 1
        else:
            j -= 1
    return out


class Page(NamedTuple):
    page_id: int | None
    url: str | None
    host: str
    path: list[str]
    blocks: list[Block]


def _nearness(a: Page, b: Page | None) -> int:
    if b is None or not a.host or a.host != b.host:
        return -1
    n = 0
    for x, y in zip(a.path, b.path, strict=False):
        if x != y:
            break
        n += 1
    return n


def _content(blocks_: list[Block]) -> list[str]:
    """Lines of the marked article, or of the whole page without such a mark."""
    return [b.text for b in blocks_ if b.main] or [b.text for b in blocks_]


def _common(a: Page, b: Page) -> tuple[set[int], bool]:
    """Places of a's content that b has too, and whether the two are editions of one article."""
    lines, others = _content(a.blocks), _content(b.blocks)
    shared = common_lines(lines, [x.text for x in b.blocks])
    return shared, len(common_lines(lines, others)) > EDITION * min(len(lines), len(others))


def main_text(page: Page, before: Page | None, after: Page | None) -> str:
    """What near pages do not share of the content.

    On a page without a marked article the nearest page decides.  Inside a marked article a line goes only if the pages on
    both sides have it, neither is an edition of this page and they are none of each other, and headings stay.
    """
    lines = _content(page.blocks)
    partners = [p for p in (before, after) if _nearness(page, p) >= 0]
    gone: set[int] = set()
    if any(b.main for b in page.blocks):
        if len(partners) == 2:
            (left, same_left), (right, same_right) = (_common(page, p) for p in partners)
            if left & right and not same_left and not same_right and not _common(*partners)[1]:
                headings = {i for i, b in enumerate([b for b in page.blocks if b.main]) if b.heading}
                gone = (left & right) - headings
    elif partners:
        near = max(partners, key=lambda other: _nearness(page, other))
        gone = common_lines(lines, [b.text for b in near.blocks])
    return "\n\n".join(x for i, x in enumerate(lines) if i not in gone)


class Sight(NamedTuple):
    """What pairing needs to know of a page; ``held`` is its key, or the page itself."""

    host: str
    marked: bool
    digest: str
    held: object


def _sight(host: str, page: list[Block], held: object) -> Sight:
    digest = hashlib.blake2b("\n".join(_content(page)).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
    return Sight(host, any(b.main for b in page), digest, held)


class Nearest:
    """Of the pages of one host seen so far the latest and the latest of another content, among all and among marked ones."""

    def __init__(self):
        self.host = ""
        self.pairs: dict[bool, tuple[Sight | None, Sight | None]] = {False: (None, None), True: (None, None)}

    def see(self, x: Sight) -> None:
        if x.host != self.host:
            self.__init__()
            self.host = x.host
        for marked in (False, True) if x.marked else (False,):
            last, other = self.pairs[marked]
            self.pairs[marked] = (x, other if last is None or last.digest == x.digest else last)

    def partner(self, x: Sight) -> Sight | None:
        if not x.host or x.host != self.host:
            return None
        last, other = self.pairs[x.marked]
        return other if last is not None and last.digest == x.digest else last

    def seen(self) -> list[Sight]:
        """The pages held, in no order."""
        return [x for pair in self.pairs.values() for x in pair if x is not None] if self.host else []


KEYS = ["host", "path", "place_url", "place_id", "place_hash"]
KEY_SCHEMA = "host string, path string, place_url string, place_id bigint, place_hash bigint"


def _sights(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        seen = [_sight(host, blocks(page or ""), None) for host, page in rows[["host", "html"]].itertuples(index=False)]
        yield rows[KEYS].assign(marked=[x.marked for x in seen], digest=[x.digest for x in seen])


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per range the pages that others may need: of its first host the first ones, of its last host the last ones."""
    part, first, last = None, [], Nearest()
    heads: dict[bool, list[Sight]] = {False: [], True: []}

    def found() -> list[tuple]:
        ends = [(0, x) for head in heads.values() for x in head] + [(1, x) for x in last.seen()]
        return [(part, side, *x.held, x.marked, x.digest) for side, x in ends]

    for rows in batches:
        out: list[tuple] = []
        for at, *key, marked, digest in rows[["part", *KEYS, "marked", "digest"]].itertuples(index=False):
            x = Sight(key[0], marked, digest, tuple(key))
            if at != part:
                out += found() if part is not None else []
                part, first, last, heads = at, x.host, Nearest(), {False: [], True: []}
            last.see(x)
            for kind in (False, True) if x.marked else (False,):
                head = heads[kind]
                if x.host and x.host == first and (not head or len(head) == 1 and head[0].digest != x.digest):
                    head.append(x)
        yield _end_rows(out)
    if part is not None:
        yield _end_rows(found())


END_COLUMNS = ["part", "side", *KEYS, "marked", "digest"]
END_SCHEMA = f"part int, side int, {KEY_SCHEMA}, marked boolean, digest string"


def _end_rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=END_COLUMNS).astype({"part": "int32", "side": "int32", "place_id": "int64", "place_hash": "int64", "marked": "bool"})


def guests(ends: list[tuple[int, int, Sight]]) -> dict[tuple, list[int]]:
    """Ranges that need a page of another range, by its key; ends are (range, 0 for head or 1 for tail, page)."""
    out: dict[tuple, list[int]] = defaultdict(list)
    sides: dict[int, dict[int, list[Sight]]] = {0: defaultdict(list), 1: defaultdict(list)}
    for part, side, x in ends:
        sides[side][part].append(x)
    parts = sorted({part for part, _, _ in ends})
    for order, near, far in ((parts, 0, 1), (parts[::-1], 1, 0)):
        carried = Nearest()
        for part in order:
            if any(x.host == carried.host for x in sides[near][part]):
                for x in carried.seen():
                    if part not in out[x.held]:
                        out[x.held].append(part)
            for x in sorted(sides[far][part], key=lambda x: x.held, reverse=far == 0):
                carried.see(x)
    return dict(out)


def _pages(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, bool, Page]]:
    for rows in batches:
        for part, own, page_id, url, host, path, page in rows[["part", "own", "page_id", "url", "host", "path", "html"]].itertuples(index=False):
            yield part, own, Page(None if pd.isna(page_id) else int(page_id), url, host or "", (path or "").strip("/").split("/"), blocks(page or ""))


TEXT_SCHEMA = "page_id bigint, url string, text string, n_chars bigint"


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out: list[tuple] = []
    # pages without a partner after them yet, by mark and digest: two groups at most, copies share their blocks
    waiting: dict[tuple[bool, str], list[tuple[Page, Page | None]]] = {}
    part, before = None, Nearest()

    def done(group: list[tuple[Page, Page | None]], after: Page | None) -> None:
        for page, previous in group:
            text = main_text(page, previous, after)
            out.append((page.page_id, page.url, text, len(text)))

    for at, own, page in _pages(batches):
        x = _sight(page.host, page.blocks, page)
        if at != part or x.host != before.host or not x.host:
            for group in waiting.values():
                done(group, None)
            waiting = {}
            if at != part:
                part, before = at, Nearest()
        for key in [k for k in waiting if k[1] != x.digest and (x.marked or not k[0])]:
            done(waiting.pop(key), page)
        partner = before.partner(x)
        if own:
            group = waiting.setdefault((x.marked, x.digest), [])
            group.append((page._replace(blocks=group[0][0].blocks) if group else page, partner.held if partner else None))
        before.see(x)
        if len(out) >= 1000:
            yield _frame(out)
            out.clear()
    for group in waiting.values():
        done(group, None)
    if out:
        yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["page_id", "url", "text", "n_chars"]).astype({"page_id": "Int64"})


def _placed(bounds: list[tuple], needed: dict[tuple, list[int]]):
    """The ranges of a key: its own one first, then those that it joins as a guest."""

    def places(host: pd.Series, path: pd.Series, url: pd.Series, page_id: pd.Series, digest: pd.Series) -> pd.Series:
        keys = zip(host, path, url, map(int, page_id), map(int, digest), strict=True)
        return pd.Series([[bisect_right(bounds, k), *needed.get(k, ())] for k in keys], dtype=object)

    return F.pandas_udf(places, "array<int>")(*KEYS)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The driver holds one key per range and the guests of ranges, so their number grows with that of ranges only.
    """
    address = F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)", 2)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.lower(address).alias("host"), path.alias("path"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumns({"place_url": F.coalesce("url", F.lit("")), "place_id": F.coalesce("page_id", F.lit(-(2**63))), "place_hash": F.xxhash64("html")})
    # several ranges for each task, so that tasks are even
    ranges = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), RANGES_A_SPLIT * pages.rdd.getNumPartitions())
    sights = written_table(rows.select(*KEYS, "html").mapInPandas(_sights, f"{KEY_SCHEMA}, marked boolean, digest string"), "page-sights")
    dealt = sights.select(F.struct(*KEYS).alias("key")).repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("key"))
    bounds = sorted(tuple(r["key"]) for r in dealt.collect())
    ends = sights.withColumn("part", F.get(_placed(bounds, {}), F.lit(0))).repartitionByRange("part").sortWithinPartitions("part", *KEYS).mapInPandas(_ends, END_SCHEMA)
    needed = guests([(r["part"], r["side"], Sight(r["host"], r["marked"], r["digest"], tuple(r[k] for k in KEYS))) for r in ends.collect()])
    placed = rows.select("*", F.posexplode(_placed(bounds, needed)).alias("guest", "part")).withColumn("own", F.col("guest") == 0).drop("guest")
    return placed.repartitionByRange("part").sortWithinPartitions("part", *KEYS).mapInPandas(_extract, TEXT_SCHEMA)
