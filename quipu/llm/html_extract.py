"""Main text of HTML pages by nearest-URL page differencing.

Pages are cut into text lines, one per block element.  Within each host, distinct pages
are sorted by URL path and query, and each is paired with the nearest page of another path
before or behind it, the one that shares the longest start with it; on a host of one path,
with the nearest page that differs.  Lines that the longest common subsequence of both pages aligns
are the site's furniture and go; so do lines inside elements that never hold main text
(menus, footers, forms, adverts, comments, ...).  What the page itself marks as its
article or main part stays, even where pages share a passage, except lines that the neighbour
shares of a main part around an article, or of a block whose name only raises a doubt (``WEAK``:
the name may be furniture's or an article's own, as in ``share price`` or ``related-work``).  Where more text stands outside of the marks
that the neighbour does not share, the marks are no main text (a card, a teaser), and the
alignment alone decides.

The sort is a range partitioning, and each partition is walked in both directions; what the
open ends of partitions lack comes from the first and last rows of the others, so the pairing
does not depend on where partitions end, and a large host is spread like any other.  Only
hashes of lines are sorted.  Pages are parsed twice, which moves less than writing their lines:
the second pass sends each page's lines, compressed, to the hashes of its neighbour.

Defined cases: null html is empty and gives an empty text; a null URL, or one
without ``://``, belongs to the host with the empty name and one path; pages of a host with
equal lines are compared with the same neighbour, never with each other.  Pages next to each
other in the sort whose text is almost equal (``COPY_SHARE``) are passed over as copies; where
all of a host's pages are, none is compared, so that no text is lost.  Unclosed elements end with their parent, an
unfinished tag at the end is dropped; a head ends where text or an element of the body begins.
``html``, ``body``, ``main`` and ``article`` are never furniture by their names, nor is a frame
around the page's text; of a form that holds it only the controls go.  Empty tables give empty tables; columns other
than those named are not read.
"""

from __future__ import annotations

import html
import itertools
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from quipu.llm import url_filter
from quipu.llm.common import column
from quipu.session import settle

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|textarea|title|iframe|object)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*+>"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
ATTR = re.compile(r"([^\s=>\"'/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
NEVER = frozenset("head nav footer aside form button select menu dialog".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent "
    "commentarea commentbox commentlist commentsection commentthread contentinfo cookie cookies disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination popup promo promoted related search share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar".split()
)
#: Hints that an article's own blocks may have in their names; inside of marks they only raise a doubt.
WEAK = frozenset(
    "alert banner login modal notice notices overlay pager popup promo promoted related search share sharing signup social "
    "subscribe toolbar".split()
)
#: An article has a header of its own, which holds its title; a page's header is furniture.
PAGE_HINTS = frozenset("header masthead topbar".split())
#: Words of a layout: a name with one of them tells what stands beside the text, as in ``main-with-sidebar``.
LAYOUT = frozenset("main layout with has no".split())
MARKS = frozenset(("article", "main"))
ROOTS = frozenset(("html", "body"))
CONTROLS = frozenset("label legend optgroup option datalist output".split())
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
SKIPPED, LOOSE, MAIN, DOUBTFUL, ARTICLE = range(5)
_SIGN = 1 << 63
WEIGHT = 15


class _Element:
    """An element of a page; ``chars`` and ``holds`` tell what stands in it, at any depth."""

    __slots__ = ("name", "names", "unseen", "parent", "closed", "chars", "holds", "place", "lost", "aside", "in_form", "in_mark")

    def __init__(self, name: str, attrs: str, parent: _Element | None):
        self.name, self.parent = name, parent
        self.names, self.unseen = _attributes(attrs)
        self.closed, self.chars, self.holds, self.place = False, 0, set(), LOOSE
        self.lost = self.aside = self.in_form = self.in_mark = False

    def hinted(self, hints: frozenset[str]) -> bool:
        return any(not hints.isdisjoint(name) for name in self.names)


def _attributes(attrs: str) -> tuple[list[list[str]], bool]:
    """(words of every class, id and role name, whether the element is unseen)."""
    names: list[list[str]] = []
    unseen = False
    for key, *values in ATTR.findall(attrs) if attrs else ():
        key, value = key.lower(), "".join(values)
        if key in ("class", "id", "role"):
            names += [re.split(r"[_-]+", name) for name in value.lower().split()]
        elif key == "hidden" or key == "style" and NO_DISPLAY.search(value):
            unseen = True
    return names, unseen


def _tree(page: str) -> tuple[list[_Element], list[tuple[str, _Element]]]:
    """Elements, parents first, and the lines with the element in which each ends."""
    root = _Element("", "", None)
    elements, lines = [root], []
    stack = [root]
    count: dict[str, int] = {}
    parts: list[str] = []

    def flush() -> None:
        line = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if line:
            lines.append((line, stack[-1]))

    def shut(name: str) -> None:
        while True:
            last = stack.pop()
            count[last.name] -= 1
            if last.name == name:
                return

    for token in TOKEN.finditer(page):
        body = token["text"]
        if body is not None:
            if body == "<" and page.find(">", token.end()) < 0 and re.match(r"[a-zA-Z/!]", page[token.end() :][:1]):
                break
            if stack[-1].name == "head" and not body.isspace():
                flush()
                shut("head")
            parts.append(body)
            continue
        if token["name"] is None:
            continue
        name = token["name"].lower()
        if name not in INLINE or name == "label" and count.get("form"):
            flush()
        if token["close"]:
            if count.get(name):
                shut_at = next(e for e in reversed(stack) if e.name == name)
                shut_at.closed = True
                shut(name)
            continue
        if name in VOID or token["attrs"].endswith("/"):
            continue
        if stack[-1].name == "head":
            shut("head")  # what may stand in a head is void or taken whole
        if name in ("p", "li", "option", "dt", "dd", "tr", "td", "th") and count.get(name):
            _imply_end(name, [e.name for e in stack[-8:]], shut)
        made = _Element(name, token["attrs"], stack[-1])
        elements.append(made)
        stack.append(made)
        count[name] = count.get(name, 0) + 1
    flush()
    return elements, lines


def text_lines(page: str | None) -> list[tuple[str, int]]:
    """(line, place) of every block with text, in page order; the place is one of the five constants."""
    elements, lines = _tree(page or "")
    for line, element in lines:
        element.chars += len(line)
    for element in reversed(elements[1:]):
        above = element.parent
        above.chars += element.chars
        above.holds |= element.holds
        if element.name in MARKS or element.name == "h1":
            above.holds.add(element.name)
    free, marked = False, 0  # whether an article stands outside of all that may be skipped, and characters of articles
    for element in elements[1:]:
        above, name = element.parent, element.name
        element.in_form = above.in_form or name == "form"
        element.aside = above.aside or element.unseen
        if name in MARKS:
            free = free or not element.aside
            marked += 0 if above.in_mark else element.chars
        elif name not in ROOTS:
            skips = (name in NEVER or name == "header") and name != "form" and element.closed
            element.aside = element.aside or skips or element.hinted(HINTS | PAGE_HINTS)
        element.in_mark = above.in_mark or name in MARKS
    for element in elements[1:]:
        element.place = _place(element, elements[0].chars, free, marked)
    return [(line, element.place) for line, element in lines]


def _place(element: _Element, chars: int, free: bool, marked: int) -> int:
    """The place of an element below one that has its place; also notes whether articles in it are furniture."""
    above, name = element.parent, element.name
    place = LOOSE if name in ROOTS else above.place
    element.lost = above.lost and name not in ROOTS
    skip = keep = False
    if name in MARKS:
        skip = element.unseen
    elif name in ROOTS:
        pass
    elif element.unseen:
        skip = True
    elif name == "form":
        whole = place < DOUBTFUL and (element.holds & MARKS or element.chars * 2 > chars)
        skip = element.closed and not whole
    elif name in NEVER or name == "header" and place < DOUBTFUL:
        skip, keep = True, not element.closed  # an article does not stand in a menu or head that has no end
    elif place >= MAIN and element.hinted(WEAK) and not element.hinted(HINTS - WEAK if place > MAIN else (HINTS - WEAK) | PAGE_HINTS):
        place = DOUBTFUL
    elif element.hinted(HINTS if place > MAIN else HINTS | PAGE_HINTS):
        skip = place > MAIN or not _frames(element, chars, free, marked)
    elif name in CONTROLS:
        skip = element.in_form
    element.lost = element.lost or skip and not keep
    if skip:
        return SKIPPED
    if name in MARKS and not element.lost and place != DOUBTFUL:
        return max(place, ARTICLE if name == "article" else MAIN)
    return place


def _frames(element: _Element, chars: int, free: bool, marked: int) -> bool:
    """Whether an element with a hint in its names is the frame of the page's text, and no furniture.

    It is if it holds the main part, most of the articles where none stands outside of
    hints, or the top heading with most of the text; or if the hint is part of a layout's name.
    """
    holds = element.holds
    if "main" in holds or "article" in holds and not free and element.chars * 2 >= marked:
        return True
    if "h1" in holds and element.chars * 2 > chars:
        return True
    hints = [name for name in element.names if not (HINTS | PAGE_HINTS).isdisjoint(name)]
    return bool(holds) and all(not LAYOUT.isdisjoint(name) for name in hints)


def _imply_end(name: str, open_names: list[str], shut) -> None:
    """A new paragraph, item or cell ends the one before, unless a container stands between them."""
    for at in range(len(open_names) - 1, max(-1, len(open_names) - 9), -1):
        if open_names[at] == name:
            shut(name)
            return
        if open_names[at] not in INLINE:
            return


def shared_lines(own: Sequence[int], other: Sequence[int]) -> list[bool]:
    """Which of the own lines a longest common subsequence aligns with the other page.

    Lines are hashes.  Rows of the usual table are bits of one number.
    """
    common = set(own) & set(other)
    flags = [False] * len(own)
    if not common:
        return flags
    rows = [i for i, line in enumerate(own) if line in common]
    cols = [line for line in other if line in common]
    where: dict[int, int] = {}
    for j, line in enumerate(cols):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(cols)) - 1
    state, states = full, []
    for i in rows:
        hit = state & where[own[i]]
        state = ((state + hit) | (state - hit)) & full
        states.append(state)
    # A cleared bit j of a state counts one more aligned line among the first j + 1 columns.
    j = len(cols)
    for at in range(len(rows) - 1, -1, -1):
        above = states[at - 1] if at else full
        mask = (1 << j) - 1
        if (~states[at] & mask).bit_count() == (~above & mask).bit_count():
            continue
        j = _match(states[at], where[own[rows[at]]], j)
        flags[rows[at]] = True
    return flags


def _match(state: int, places: int, j: int) -> int:
    """The last column before ``j`` that holds the line and still leaves the count of its row."""
    need = (~state & ((1 << j) - 1)).bit_count()
    best = -1
    left = places & ((1 << j) - 1)
    while left:
        k = left.bit_length() - 1
        if (~state & ((1 << (k + 1)) - 1)).bit_count() == need:
            best = k
            break
        left &= ~(1 << k)
    return best


def _common_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def prints_of(lines: Sequence[str]) -> list[int]:
    """Signed hashes of the lines; of the 64 bits the last four are left for weights."""
    return [((xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) & ~WEIGHT) ^ _SIGN) - _SIGN for line in lines]


def weighted(prints: Sequence[int], lines: Sequence[tuple[str, int]]) -> list[int]:
    """Hashes with the bit length of each line's length; lines that cannot be main text weigh nothing."""
    return [p | min(WEIGHT, len(line).bit_length()) if place != SKIPPED else p for p, (line, place) in zip(prints, lines, strict=True)]


def digest_of(prints: Sequence[int]) -> int:
    """Signed 64-bit hash of a page's lines; pages of a host with equal digests are copies."""
    return (xxhash.xxh64_intdigest(array("q", prints).tobytes()) ^ _SIGN) - _SIGN


def page_prints(page: Column) -> Column:
    kind = pa.struct([("digest", pa.int64()), ("prints", pa.list_(pa.int64()))])

    @F.arrow_udf("digest long, prints array<long>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for p in batch:
                lines = text_lines(p.as_py())
                prints = prints_of([line for line, _ in lines])
                out.append({"digest": digest_of(prints), "prints": weighted(prints, lines)})
            yield pa.array(out, kind)

    return run(page)


def packed_lines(page: Column) -> Column:
    """Places and lines of a page, compressed: what a join has to move of it; and the digest of the lines."""
    kind = pa.struct([("digest", pa.int64()), ("packed", pa.binary())])

    @F.arrow_udf("digest long, packed binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for p in batch:
                lines = text_lines(p.as_py())
                whole = "\n".join(["".join(str(place) for _, place in lines), *(line for line, _ in lines)])
                packed = zlib.compress(whole.encode("utf-8", "surrogatepass"), 1)
                out.append({"digest": digest_of(prints_of([line for line, _ in lines])), "packed": packed})
            yield pa.array(out, kind)

    return run(page)


def main_lines(lines: Sequence[str], places: Sequence[int], shared: Sequence[bool]) -> list[str]:
    """The lines of the main text, given which of them the neighbour shares.

    Marks count if their lines hold at least as much text as the loose lines that are
    not shared.  Lines of an article all stay, doubtful lines and those of a main part around an
    article unless they are shared.  Else all lines outside of furniture that are not shared stay.
    """
    rows = [row for row in zip(lines, places, shared, strict=True) if row[1] != SKIPPED]
    loose = sum(len(line) for line, place, twice in rows if place == LOOSE and not twice)
    marked = sum(len(line) for line, place, _ in rows if place > LOOSE)
    if not marked or marked < loose:
        return [line for line, _, twice in rows if not twice]
    top = max((place for _, place, _ in rows if place != DOUBTFUL), default=ARTICLE)
    return [line for line, place, twice in rows if place == top or place > LOOSE and not twice]


def main_text(packed: Column, near: Column) -> Column:
    """Text of a page, given the hashes of its neighbour's lines (null: no neighbour)."""

    @F.arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for pages, others in batches:
            out = []
            for page, other in zip(pages, others, strict=True):
                head, *lines = zlib.decompress(page.as_py()).decode("utf-8", "surrogatepass").split("\n")
                lines = lines[: len(head)]
                shared = shared_lines(prints_of(lines), [x & ~WEIGHT for x in other.as_py() or ()])
                out.append(" ".join(main_lines(lines, [int(c) for c in head], shared)))
            yield pa.array(out, pa.string())

    return run(packed, near)


# --- pairing -------------------------------------------------------------------

KEYS = [("host", pa.string()), ("path", pa.string()), ("query", pa.string()), ("digest", pa.int64())]
PRINTS = pa.list_(pa.int64())
ENTRY = pa.struct([("host", pa.string()), ("path", pa.string()), ("query", pa.string()), ("prints", PRINTS)])
SIDES = [("before", pa.list_(ENTRY)), ("before_open", pa.list_(pa.bool_())), ("behind", pa.list_(ENTRY)), ("behind_open", pa.list_(pa.bool_()))]
#: First pages of another path, then any page that is no copy.
LEVELS = 2
#: Pages are almost equal if lines of less than this share of either's text are not in the other.
COPY_SHARE = 0.05


def _rest(own: Sequence[int], other: set[int]) -> float:
    """The share of a page's text in lines that the other has not, by weights of about the lines' lengths."""
    weights = [(x, 1 << (x & WEIGHT) if x & WEIGHT else 0) for x in own]
    return sum(w for x, w in weights if x & ~WEIGHT not in other) / max(1, sum(w for _, w in weights))


def almost_equal(a: Sequence[int], b: Sequence[int]) -> bool:
    if a == b:
        return True
    sets = [{x & ~WEIGHT for x in page} for page in (a, b)]
    return not sets[0].isdisjoint(sets[1]) and _rest(a, sets[1]) < COPY_SHARE and _rest(b, sets[0]) < COPY_SHARE


def apart(a: dict, b: dict) -> tuple[bool, bool]:
    """Per level, whether two different versions of one host, neighbours in the sort, may be compared."""
    new = not almost_equal(a["prints"], b["prints"])
    return new and a["path"] != b["path"], new


def choose(own: dict, before: Sequence[dict | None], behind: Sequence[dict | None]) -> list[int] | None:
    """Line hashes of the nearest page at the first level that has one: the longest common start, else the one before."""
    link = f"{own['path']}?{own['query']}"
    for prev, next_ in zip(before, behind, strict=True):
        if prev and next_:
            starts = [_common_start(link, f"{x['path']}?{x['query']}") for x in (prev, next_)]
            return (next_ if starts[1] > starts[0] else prev)["prints"]
        if prev or next_:
            return (prev or next_)["prints"]
    return None


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from batch.slice(at, 256).to_pylist()


def _batches(rows: Iterator[dict], fields: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    while part := list(itertools.islice(rows, 256)):
        yield pa.RecordBatch.from_pylist(part, pa.schema(fields))


def _walk(rows: Iterator[dict], side: str) -> Iterator[dict]:
    """Adds to sorted rows, per level, the last version that is apart from the present run of versions.

    A run that began with the rows is open: what is apart from it may stand in the next partition.
    """
    last, found, open_ = None, [None] * LEVELS, [True] * LEVELS
    for row in rows:
        entry = {name: row[name] for name in ("host", "path", "query", "prints")}
        if last and last["host"] != entry["host"]:
            found, open_ = [None] * LEVELS, [False] * LEVELS
        elif last:
            for level, new in enumerate(apart(last, entry)):
                if new:
                    found[level], open_[level] = last, False
        yield {**row, side: list(found), f"{side}_open": list(open_), f"{side}_edge": last is None}
        last = entry


def _look_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batches(_walk(_rows(batches), "before"), LOOKED)


def _look_ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows from the last to the first: those whose neighbour is sure get it, the rest keep what is known."""

    def judged() -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        for row in _walk(_rows(batches), "behind"):
            sure = any(row["before"][:1] + row["behind"][:1]) and not row["before_open"][0] and not row["behind_open"][0]
            if sure or not any(row["before_open"] + row["behind_open"]):
                near = choose(row, row["before"], row["behind"])
                yield {**{name: row[name] for name, _ in KEYS}, "part": part, "sure": True, "near": near}
            else:
                prints = row["prints"] if row["before_edge"] or row["behind_edge"] else None
                yield {**row, "part": part, "sure": False, "prints": prints}

    yield from _batches(judged(), JUDGED)


LOOKED = [*KEYS, ("prints", PRINTS), *SIDES[:2], ("before_edge", pa.bool_())]
JUDGED = [*LOOKED, *SIDES[2:], ("behind_edge", pa.bool_()), ("part", pa.int32()), ("sure", pa.bool_()), ("near", PRINTS)]
ENDS = [("of", pa.int32()), ("past", pa.list_(ENTRY)), ("coming", pa.list_(ENTRY))]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the first and last row of every partition: what is apart from a partition's open runs."""
    firsts, lasts = {}, {}
    for row in _rows(batches):
        if row["before_edge"]:
            firsts[row["part"]] = row
        if row["behind_edge"]:
            lasts[row["part"]] = row

    def beyond(parts: list[int], near_edge: dict, far_edge: dict, side: str) -> dict:
        got, at = {}, None
        for part in parts:
            got[part] = [None] * LEVELS
            if at is not None and far_edge[at]["host"] == near_edge[part]["host"]:
                edge = far_edge[at]
                entry = {name: edge[name] for name in ("host", "path", "query", "prints")}
                for level, new in enumerate(apart(edge, near_edge[part])):
                    known = got[at] if edge[f"{side}_open"][level] else edge[side]
                    got[part][level] = entry if new else known[level]
            at = part
        return got

    parts = sorted(firsts)
    past = beyond(parts, firsts, lasts, "before")
    coming = beyond(parts[::-1], lasts, firsts, "behind")
    yield from _batches(iter([{"of": p, "past": past[p], "coming": coming[p]} for p in parts]), ENDS)


def _look_beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def chosen() -> Iterator[dict]:
        for row in _rows(batches):
            before = [y if o else x for x, o, y in zip(row["before"], row["before_open"], row["past"], strict=True)]
            behind = [y if o else x for x, o, y in zip(row["behind"], row["behind_open"], row["coming"], strict=True)]
            yield {"host": row["host"], "digest": row["digest"], "near": choose(row, before, behind)}

    yield from _batches(chosen(), [("host", pa.string()), ("digest", pa.int64()), ("near", PRINTS)])


def _query(link: Column) -> Column:
    """What follows the path; all of a link that has no host."""
    return F.when(F.contains(link, F.lit("://")), F.regexp_extract(link, r"\?([^#]*)", 1)).otherwise(link)


def nearest_prints(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, digest, near): for every distinct list of lines of a host, those of the nearest different page.

    One row stands for all copies within a host, so copies are never compared with
    each other and a page with many copies is one row here.  Pages without lines have none.
    """
    order = ["host", "path", "query", "digest"]
    link = F.coalesce(column(pages, url), F.lit(""))
    rows = pages.select(
        url_filter.host(link).alias("host"), url_filter.path(link).alias("path"), _query(link).alias("query"), page_prints(column(pages, page)).alias("of")
    )
    rows = rows.select("host", "path", "query", "of.digest", "of.prints")
    one = rows.groupBy("host", "digest").agg(F.min(F.struct("path", "query")).alias("at"), F.max("prints").alias("prints"))
    one = one.select("host", "at.path", "at.query", "digest", "prints").where(F.size("prints") > 0)
    placed = one.repartitionByRange(*order).sortWithinPartitions(*order)
    looked = placed.mapInArrow(_look_back, from_arrow_schema(pa.schema(LOOKED)))
    looked = looked.sortWithinPartitions(*[F.desc(c) for c in order])
    judged = settle(looked.mapInArrow(_look_ahead, from_arrow_schema(pa.schema(JUDGED))), "op5-sorted")
    edges = judged.where("before_edge OR behind_edge").repartition(1)  # two rows per partition
    ends = edges.mapInArrow(_ends, from_arrow_schema(pa.schema(ENDS)))
    rest = judged.where("NOT sure").join(ends, F.col("part") == F.col("of"))
    kind = from_arrow_schema(pa.schema([("host", pa.string()), ("digest", pa.int64()), ("near", PRINTS)]))
    return judged.where("sure").select("host", "digest", "near").unionByName(rest.mapInArrow(_look_beyond, kind))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    near = nearest_prints(pages, url, page).withColumnsRenamed({"host": "of_host", "digest": "of_digest"})
    link = F.coalesce(column(pages, url), F.lit(""))
    rows = pages.select(
        column(pages, key).alias("page_id"),
        column(pages, url).alias("url"),
        url_filter.host(link).alias("host"),
        packed_lines(column(pages, page)).alias("of"),
    ).select("page_id", "url", "host", "of.digest", "of.packed")
    joined = rows.join(near, (F.col("host") == F.col("of_host")) & (F.col("digest") == F.col("of_digest")), "left")
    texts = joined.select("page_id", "url", main_text(F.col("packed"), F.col("near")).alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
