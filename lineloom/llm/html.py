"""Main text of web pages: structure, and differences to the page with the nearest URL.

A page becomes lines, one per block of text, each marked by where it stands:
in an element that is never main text (menu, page header, footer, sidebar,
notice, advert, form, comments, …), in the article, or in neither. Only the
third kind is in doubt. The pages of a host are put in the order of their URL
paths and each is paired with the neighbour that shares the longer start of the
path; all lines of both are aligned by longest common subsequence, and lines that
both have are deleted. Structure comes second: a shared line of an article stays,
as two articles may say the same, and a line of the first kind goes though the
neighbour has it not. A neighbour that has more than MOST_SHARED of the
characters of a page's article (of its lines in doubt, if it has none) is a copy,
which tells nothing: the next one is taken, and copies stay whole.

If a page has an article, lines in doubt are left out, unless those that differ
from the neighbour's hold more characters than the article, which is a mere card
then; without an article, they are its text.

Null and empty pages give the empty text. Repeated rows (equal id, URL and
page) and equal URLs are neighbours like others. A page that is alone on its
host, or whose URL is null, is compared with none. Extra columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_arrow, parts_for, range_of, split_points, spread, total_bytes

LINES_SCHEMA = "page_id long, url string, at string, lines array<string>, kinds array<tinyint>"
TEXT_SCHEMA = "page_id long, url string, text string"
BOILERPLATE, DOUBT, MAIN = 0, 1, 2
# Shared characters, by kind, that make a copy: an article is mostly text, lines in doubt are often mostly frame.
MOST_SHARED = {MAIN: 0.5, DOUBT: 0.8}

# Element names of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset(
    "nav header footer aside form script style noscript template iframe svg math button select textarea dialog menu object canvas head".split()
)
_MAIN = frozenset(["article", "main"])
_BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section summary table tbody td tfoot th thead title tr ul""".split()
)
_CLOSE_P = _BLOCKS - frozenset("caption dd dt td th tr tbody thead tfoot li option optgroup summary legend".split())
_CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_FENCES = frozenset("article main section div nav aside header footer ul ol dl table form body html blockquote".split())
_NOT_MAIN = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|notification\w*|"
    r"popup|modal|overlay|newsletter|subscribe|subscription|signup|login|nav|navbar|navigation|menu|breadcrumbs?|sidebar|"
    r"widget\w*|footer|masthead|header|comments?|commentlist|disqus|replies|respond|share|sharing|social|related|"
    r"recommend\w*|pagination|pager|skip-link|toolbar|disclaimer|copyright)(?=$|[\s_-])",
    re.I,
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_MAIN_MARK = re.compile(
    r"(?:^|[\s_-])(?:article|post-?(?:body|content)|entry-?content|main-?content|story-?body|content-?body|articlebody)(?=$|[\s_-])",
    re.I,
)
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe|svg|math)\b(?:[^>"']|"[^"]*"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")


def _kind_of(name: str, attributes: str) -> int | None:
    """What an element says about its content, or None."""
    if name in _SKIPPED:
        return BOILERPLATE
    if attributes:
        found = {a[0].lower(): references.unescape(a[1] or a[2] or a[3]) for a in _ATTRIBUTE.findall(attributes)}
        marks = f"{found.get('class', '')} {found.get('id', '')}"
        if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in _ROLES:
            return BOILERPLATE
        if re.search(r"display\s*:\s*none", found.get("style", "")):
            return BOILERPLATE
        if name not in ("html", "body") and name not in _MAIN and marks.strip() and _NOT_MAIN.search(marks):
            return BOILERPLATE
        if marks.strip() and _MAIN_MARK.search(marks) or found.get("role", "").lower() in ("main", "article"):
            return MAIN
    return MAIN if name in _MAIN else None


def page_lines(page: str | None) -> tuple[list[str], list[int]]:
    """Lines of a page in order, and the kind of place of each."""
    lines: list[str] = []
    kinds: list[int] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and the kind inside

    def end_line() -> None:
        if held:
            line = _SPACE.sub(" ", references.unescape("".join(held))).strip()
            if line:
                lines.append(line)
                kinds.append(stack[-1][1] if stack else DOUBT)
            held.clear()

    at = 0
    page = page or ""
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            held.append(page[at : token.start()])
        at = token.end()
        closed, opened = token.group(2), token.group(3)
        if opened:
            name = opened.lower()
            if name in _BLOCKS:
                end_line()
            elif name == "br":
                held.append(" ")
            if name in _VOID or token.group(4).rstrip().endswith("/") and name not in _BLOCKS:
                continue
            if name in _CLOSE_P:
                _close(stack, frozenset(["p"]))
            if name in _CLOSES:
                _close(stack, _CLOSES[name])
            around = stack[-1][1] if stack else DOUBT
            inside = _kind_of(name, token.group(4))
            kind = around if inside is None or around == BOILERPLATE else inside
            if kind == MAIN == inside and around == DOUBT or kind != around:
                end_line()
            stack.append((name, kind))
        elif closed:
            name = closed.lower()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    if name in _BLOCKS or stack[-1][1] != (stack[depth - 1][1] if depth else DOUBT):
                        end_line()
                    del stack[depth:]
                    break
                if stack[depth][0] in _FENCES and name not in _FENCES:
                    break
            else:
                if name in _BLOCKS:
                    end_line()
    if at < len(page):
        held.append(page[at:])
    end_line()
    return lines, kinds


def _close(stack: list[tuple[str, int]], names: frozenset[str]) -> None:
    """End the nearest open element of these names, as far as its container."""
    for depth in range(len(stack) - 1, -1, -1):
        if stack[depth][0] in names:
            del stack[depth:]
            return
        if stack[depth][0] in _FENCES:
            return


def common_lines(a: list[str], b: list[str]) -> tuple[list[bool], list[bool]]:
    """Which lines of each belong to a longest common subsequence.

    Equal starts and ends are matched first; the rest goes by bit-parallel rows,
    a long integer per line, so that a step costs a few words.
    """
    in_a, in_b = [False] * len(a), [False] * len(b)
    lo, ha, hb = 0, len(a), len(b)
    while lo < min(ha, hb) and a[lo] == b[lo]:
        in_a[lo] = in_b[lo] = True
        lo += 1
    while ha > lo and hb > lo and a[ha - 1] == b[hb - 1]:
        ha, hb = ha - 1, hb - 1
        in_a[ha] = in_b[hb] = True
    rows: dict[str, int] = {}
    for i in range(lo, ha):
        rows[a[i]] = rows.get(a[i], 0) | 1 << (i - lo)
    wide = (1 << max(0, ha - lo)) - 1
    state, history = wide, []
    for j in range(lo, hb):
        match = rows.get(b[j], 0)
        found = state & match
        state = ((state + found) | (state - found)) & wide
        history.append(state)
    # Going back, a zero bit says that the common length rises there.
    i, j = ha - lo - 1, len(history) - 1
    while i >= 0 and j >= 0:
        if history[j] >> i & 1:
            i -= 1
        elif j and not history[j - 1] >> i & 1:
            j -= 1
        else:
            in_a[lo + i] = in_b[lo + j] = True
            i, j = i - 1, j - 1
    return in_a, in_b


def _place(url: str) -> Column:
    """Host and path of a URL, without scheme, query, fragment and ending."""
    bare = F.regexp_replace(F.lower(url), r"^[a-z][a-z0-9+.-]*:|[?#].*$", "")
    return F.regexp_replace(F.regexp_replace(bare, "^//", ""), r"(/index)?(\.html?)?/*$", "")


def _sort_key() -> Column:
    """Orders pages by place, then id; NULL without a place."""
    number = F.lpad(F.coalesce("page_id", F.lit(0)).cast("string"), 20, "0")
    return F.when(F.col("at").isNotNull(), F.concat_ws("\t", "at", number))


def split_pages(pages: DataFrame, *, page_id: str, url: str, html: str) -> DataFrame:
    """Each page's lines and their kinds; `at` is host and path, by which pages are neighbours."""
    picked = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    keyed = picked.withColumn("at", _place("url"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [page_lines(p) for p in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("page_id").cast(pa.int64()),
                batch.column("url"),
                batch.column("at"),
                pa.array([f[0] for f in found], pa.list_(pa.string())),
                pa.array([f[1] for f in found], pa.list_(pa.int8())),
            ],
            [c.split()[0] for c in LINES_SCHEMA.split(", ")],
        )

    return map_arrow(spread(keyed), cut, LINES_SCHEMA)


def _near(a: str | None, b: str | None) -> int:
    """Characters that two places have in common at the start; 0 on different hosts."""
    if a is None or b is None or a.split("/", 1)[0] != b.split("/", 1)[0]:
        return 0
    n = min(len(a), len(b))
    same = next((i for i in range(n) if a[i] != b[i]), n)
    return same


def _is_copy(lines: list[str], kinds: list[int], shared: list[bool]) -> bool:
    """Whether a page with these shared lines would lose its text by leaving them out."""
    kind = MAIN if MAIN in kinds else DOUBT
    sizes = [(len(line), s) for line, k, s in zip(lines, kinds, shared) if k == kind]
    return sum(n for n, s in sizes if s) > MOST_SHARED[kind] * sum(n for n, _ in sizes)


class _Row(NamedTuple):
    page_id: int | None
    url: str | None
    at: str | None
    lines: list[str]
    kinds: list[int]
    copy: bool


class _Range:
    """Pages in order of place, and which page each is compared with."""

    def __init__(self, rows: list[_Row]):
        self.rows = rows
        self.met: dict[tuple[int, int], bool] = {}
        self.found: dict[tuple[int, int], int | None] = {}

    def near(self, i: int, j: int) -> int:
        return _near(self.rows[i].at, self.rows[j].at) if 0 <= j < len(self.rows) else 0

    def copied(self, i: int, j: int) -> bool:
        a, b = self.rows[i], self.rows[j]
        pair = (id(a.lines), id(b.lines))  # equal pages share one list
        if pair not in self.met:
            self.met[pair] = _is_copy(a.lines, a.kinds, common_lines(a.lines, b.lines)[0])
        return self.met[pair]

    def beside(self, i: int, step: int) -> int | None:
        """The nearest page on one side (step = -1 or 1) that is no copy."""
        at, stack = {}, [i]
        while stack:
            k = stack[-1]
            j = at.setdefault(k, k + step)
            if (k, step) in self.found:
                stack.pop()
            elif j is None or not self.near(k, j):
                self.found[k, step] = None
            elif not self.copied(k, j):
                self.found[k, step] = j
            elif (j, step) in self.found:
                at[k] = self.found[j, step]
            else:
                stack.append(j)
        return self.found[i, step]

    def other(self, i: int) -> _Row | None:
        """The page that row i is compared with: that with the longer equal start of the place."""
        best, most = None, 0
        for step in sorted((-1, 1), key=lambda step: -self.near(i, i + step)):
            if self.near(i, i + step) > most and (j := self.beside(i, step)) is not None and self.near(i, j) > most:
                best, most = self.rows[j], self.near(i, j)
        return best


def _settled(page: tuple, other: tuple | None) -> str:
    _, _, _, lines, kinds = page
    shared = [False] * len(lines) if other is None else common_lines(lines, other[3])[0]
    if _is_copy(lines, kinds, shared):
        shared = [False] * len(lines)
    left = [(line, k) for line, k, s in zip(lines, kinds, shared) if not s or k == MAIN]
    size = lambda kind: sum(len(line) for line, k in left if k == kind)
    wanted = {DOUBT} if MAIN not in kinds else {MAIN, DOUBT} if size(DOUBT) > size(MAIN) else {MAIN}
    return "\n".join(line for line, k in left if k in wanted)


def main_text(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", part_bytes: int = 4 << 20
) -> DataFrame:
    """(page_id, url, text) of every page.

    Pages are dealt out by ranges of host and path, so a host of any size is
    spread over tasks; rows beyond both ends of a range are copied to it, where
    they are neighbours but give no result.
    """
    lines = split_pages(pages, page_id=page_id, url=url, html=html)
    places = pages.select(F.col(page_id).alias("page_id"), _place(url).alias("at")).select("at", _sort_key().alias("key"))
    points = split_points(places, "key", parts_for(total_bytes(pages, html), part_bytes))
    edges = _edges(places.where("key IS NOT NULL"), points) if points else {}

    place = lambda part, copy: F.struct(part.cast("int").alias("part"), copy.alias("copy"))
    keyed = lines.withColumn("key", _sort_key())
    own = place(range_of("key", points), F.lit(False))
    if edges:
        there = pages.sparkSession.createDataFrame([(k, sorted(v)) for k, v in edges.items()], "edge string, ranges array<int>")
        keyed = keyed.join(F.broadcast(there), F.col("key") == F.col("edge"), "left")
        copies = F.transform(F.coalesce("ranges", F.array().cast("array<int>")), lambda r: place(r, F.lit(True)))
        to = F.concat(F.array(own), copies)
    else:
        to = F.array(own)
    dealt = keyed.select(*lines.columns, "key", F.explode(to).alias("to")).select(*lines.columns, "key", "to.*")
    ordered = dealt.repartitionById(len(points) + 1, F.col("part")).sortWithinPartitions("key", "url", "copy")

    def texts(rows: list[_Row]) -> Iterator[pa.RecordBatch]:
        pages = _Range(rows)
        for lo in range(0, len(rows), 512):
            out = [
                (rows[i].page_id, rows[i].url, _settled(rows[i][:5], pages.other(i)))
                for i in range(lo, min(lo + 512, len(rows)))
                if not rows[i].copy
            ]
            if out:
                arrays = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Row] = []  # a host's pages in this range
        host, known = None, {}
        for rows in _portions(batches):
            alone = [r for r in rows if r.at is None]
            yield from texts(alone)
            for row in rows[len(alone) :]:  # rows without a place come first
                if row.at.split("/", 1)[0] != host:
                    yield from texts(held)
                    held, host, known = [], row.at.split("/", 1)[0], {}
                same = known.setdefault((tuple(row.lines), bytes(row.kinds)), row)
                held.append(row._replace(lines=same.lines, kinds=same.kinds))
        yield from texts(held)

    return ordered.select("page_id", "url", "at", "lines", "kinds", "copy").mapInArrow(run, TEXT_SCHEMA)


def _edges(places: DataFrame, points: list[str]) -> dict[str, set[int]]:
    """{key: ranges it is copied to}: on either side of a range the next row, and the next with another place.

    Rows of one place are mostly copies of each other, and may fill many ranges.
    """
    place = lambda key: key.rsplit("\t", 1)[0]
    ranged = places.withColumn("part", range_of("key", points))
    last = {r["part"]: r["key"] for r in ranged.groupBy("part").agg(F.max("key").alias("key")).collect()}
    first = {k + 1: key for k, key in enumerate(points)}
    spark = places.sparkSession
    bounds = [(k, place(first[k]) if k else None, place(last[k])) for k in last]
    bounds = F.broadcast(spark.createDataFrame(bounds, "part int, head string, tail string"))
    inner = ranged.join(bounds, "part").groupBy("part").agg(
        F.min(F.when(F.col("at") > F.col("head"), F.col("key"))).alias("after"),
        F.max(F.when(F.col("at") < F.col("tail"), F.col("key"))).alias("before"),
    )
    inner = {r["part"]: r for r in inner.collect()}
    out: dict[str, set[int]] = {}

    def copy(key: str | None, part: int) -> None:
        if key is not None:
            out.setdefault(key, set()).add(part)

    beyond = None  # the first key behind range k's first place
    for k in range(len(points), 0, -1):
        if k in inner and inner[k]["after"] is not None:
            beyond = inner[k]["after"]
        elif k < len(points) and place(first[k + 1]) != place(first[k]):
            beyond = first[k + 1]
        copy(first[k], k - 1)
        copy(beyond, k - 1)
    beyond = None
    for k in sorted(last)[:-1]:
        if inner[k]["before"] is not None:
            beyond = inner[k]["before"]
        elif k - 1 in last and place(last[k - 1]) != place(last[k]):
            beyond = last[k - 1]
        copy(last[k], k + 1)
        copy(beyond, k + 1)
    return out


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[list[_Row]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            yield [_Row(*r) for r in zip(*(c.to_pylist() for c in batch.slice(lo, 512).columns))]
