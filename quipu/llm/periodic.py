"""Periodic stretches of words (runs), found as maximal pairs of repeats.

A run is a stretch with smallest period q and at least ``EXPONENT`` * q and ``LEAST`` words
that no neighbouring word extends.  The repeat at distance q inside it, from the run's
start and from q words later, cannot be extended to either side: it is a maximal pair
whose distance is at most a third of its length.  So runs need no extension: all maximal
pairs are enumerated on the tree of LCP intervals, from the deepest interval up.  An
interval keeps its places in lists by the word to their left; when intervals join, two
places form a maximal pair if their left words differ, and only places nearer than the
distance bound are looked up.  Pairs whose distance is a multiple of the period have the
same start and end as the run and fall to the pair of smallest distance.

Suffixes of many documents are sorted together by doubling with numpy; a suffix leaves
the sort as soon as it is unique in its document, so ordinary prose costs two sorts, and
only suffixes that share four words with another one reach the tree.

Defined cases: null and empty texts have no words and no runs.  Texts of any length are
treated whole.  Repeated rows give equal results; a null key rewrites no words; empty
tables give empty tables.  Ties between runs go to the smaller start, then period.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import column

LEAST = 6  # fixed value: words of the shortest run
EXPONENT = 4  # fixed value: least number of periods in a run
#: Shared words of the shortest maximal pair of a run, less one; a power of two.
PREFIX = 4
CHUNK_WORDS = 1 << 19
RESULT = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
NO_RUNS = hashlib.sha256(b"").hexdigest()


def split_words(text: str | None) -> list[bytes]:
    """Runs of characters other than blank, tab, line feed, vertical tab, form feed and carriage return."""
    return (text or "").encode().split()


def echo(words: list[bytes], key: int | None) -> list[bytes]:
    """Every tenth document, by a hash of its key, repeats a stretch of its words up to the end.

    This rewriting belongs to the query over the synthetic documents, which hold no runs.
    """
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    unit = words[first : first + period]
    times = -(-(n - first) // period)
    return words[:first] + (unit * times)[: n - first]


def sorted_repeats(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Starts of suffixes that share ``PREFIX`` words with another one of their document, sorted as suffixes.

    ``ids`` are word numbers from 1, with a 0 after every document; ``doc`` is the document of every word.
    """
    n, size = len(ids), int(ids.max()) + 1
    active = np.flatnonzero(ids)
    # Document, word and next word in one number; documents and different words number no more than all words.
    key = (doc[active] * size + ids[active]) * size + ids[active + 1]
    rank = np.full(n + 1, -1, np.int64)
    base = np.zeros(len(active), np.int64)
    members, width = active[:0], 1
    while len(active):
        order = np.argsort(key, kind="stable")
        active, base, key = active[order], base[order], key[order]
        new, former = np.ones(len(active), bool), np.ones(len(active), bool)
        new[1:], former[1:] = key[1:] != key[:-1], base[1:] != base[:-1]
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(active)))
        # The rank of a group: the suffixes before its former group, and those before it in that group.
        now = base + np.repeat(first, counts) - np.flatnonzero(former)[np.cumsum(former) - 1]
        rank[active] = now
        several = np.repeat(counts > 1, counts)
        active, base = active[several], now[several]
        width *= 2
        if width == PREFIX:
            members = active
        key = base * (n + 2) + rank[np.minimum(active + width, n)] + 1
    return members[np.argsort(rank[members])]


def shared_words(order: list[int], ids: list[int], doc: list[int]) -> list[int]:
    """Number of words that every suffix of ``order`` shares with the one before it.

    Taken in text order: a suffix shares at most one word less than the suffix that
    starts one word earlier.  A document's end is no word, so no count goes beyond it.
    """
    shared, index = [0] * len(order), dict(zip(order, range(len(order))))
    last, h = -2, 0
    for place in sorted(order):
        # The word less is certain only while the suffix it comes from is in ``order`` too.
        h = h - 1 if place == last + 1 and h > PREFIX else 0
        last, i = place, index[place]
        other = order[i - 1]
        if not i or doc[other] != doc[place]:
            h = 0
            continue
        while ids[place + h] == ids[other + h]:
            h += 1
        shared[i] = h
    return shared


class Interval:
    """An LCP interval: the places of its suffixes, in all and by left word."""

    __slots__ = ("lcp", "places", "classes")

    def __init__(self, lcp: int, place: int | None = None, left: int = 0) -> None:
        self.lcp = lcp
        self.places = [] if place is None else [place]
        self.classes = {} if place is None else {left: [place]}


def join(parent: Interval, child: Interval, left: list[int], found: list[tuple[int, int, int]]) -> None:
    """Enumerate the maximal pairs between both, near enough for a run; then the places of the child join the parent.

    Two places of an interval whose distance is at most a third of its words have a period
    of those words as distance.  So the places near to one place lie at multiples of the
    smallest such period, and all but the first of them have the same left word: the
    class of the next place holds all partners to the right, and only the first place
    within reach can be a partner to the left.
    """
    if len(child.places) > len(parent.places):
        parent.places, child.places = child.places, parent.places
        parent.classes, child.classes = child.classes, parent.classes
    words = parent.lcp
    reach = words // (EXPONENT - 1)
    places, classes = parent.places, parent.classes
    if places:
        for place in child.places:
            own = left[place]
            i = bisect_right(places, place)
            if i < len(places) and places[i] - place <= reach and left[places[i]] != own:
                partners = classes[left[places[i]]]
                for j in range(bisect_left(partners, places[i]), len(partners)):
                    if partners[j] - place > reach:
                        break
                    found.append((place, partners[j] + words, partners[j] - place))
            i = bisect_left(places, place - reach, 0, i)
            if i < len(places) and places[i] < place and left[places[i]] != own:
                found.append((places[i], place + words, place - places[i]))
    few = len(child.places) < 8
    for mine, theirs in chain([(places, child.places)], ((classes.setdefault(c, []), p) for c, p in child.classes.items())):
        if few and len(mine) > 64:
            for place in theirs:
                mine.insert(bisect_left(mine, place), place)
        else:
            mine += theirs
            mine.sort()


def maximal_pairs(order: list[int], shared: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """(start, end, distance) of the maximal pairs that are near enough for a run.

    Intervals of ``PREFIX`` words or fewer hold no run and are not built.
    """
    found: list[tuple[int, int, int]] = []
    stack: list[Interval] = []
    closed: Interval | None = None
    for place, lcp in zip([*order, -1], [*shared, 0]):
        while stack and stack[-1].lcp > lcp:
            join(stack[-1], closed, left, found)
            closed = stack.pop()
        if closed is not None and lcp > PREFIX:
            if not stack or stack[-1].lcp < lcp:
                stack.append(Interval(lcp))
            join(stack[-1], closed, left, found)
        closed = Interval(0, place, left[place])
    return found


def runs_of(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of every document as (start, length, period), by start and then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not any(map(len, documents)):
        return out
    number = defaultdict(count(1).__next__).__getitem__
    ends = np.cumsum([len(d) + 1 for d in documents])
    ids = np.zeros(ends[-1], np.int64)
    words = np.ones(ends[-1], bool)
    words[ends - 1] = False
    ids[words] = np.fromiter(map(number, chain.from_iterable(documents)), np.int64, int(words.sum()))
    doc = np.repeat(np.arange(len(documents)), np.diff(ends, prepend=0))
    order = sorted_repeats(ids, doc)
    if not len(order):
        return out
    # Only documents with such repeats go on.
    keep = np.zeros(len(documents), bool)
    keep[doc[order]] = True
    keep = keep[doc]
    order = (np.cumsum(keep) - 1)[order].tolist()
    first = np.flatnonzero(np.diff(doc[keep], prepend=-1))
    starts = dict(zip(doc[keep][first].tolist(), first.tolist()))
    id_list, doc_list = ids[keep].tolist(), doc[keep].tolist()
    left = [0, *id_list[:-1]]
    smallest: dict[tuple[int, int], int] = {}
    for start, end, distance in maximal_pairs(order, shared_words(order, id_list, doc_list), left):
        if end - start >= LEAST and distance < smallest.get((start, end), distance + 1):
            smallest[start, end] = distance
    for (start, end), period in smallest.items():
        out[doc_list[start]].append((start - starts[doc_list[start]], end - start, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that some run contains after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop).tolist()) if not d]


def digest(words: list[bytes], runs: list[tuple[int, int, int]]) -> dict[str, int | str | None]:
    best = None
    for run in runs:  # by start and then period, so the first of equal exponents stays
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    start, length, period = best or (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return {
        "n_runs": len(runs),
        "start": start,
        "length": length,
        "period": period,
        "exponent_milli": 1000 * length // period if best else None,
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest() if runs else NO_RUNS,
        "collapsed_sha256": hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest(),
    }


def chunks(words: Iterator[list[bytes]], size: int = CHUNK_WORDS) -> Iterator[list[list[bytes]]]:
    """Documents in groups of about ``size`` words; a longer document is a group of its own."""
    group: list[list[bytes]] = []
    total = 0
    for own in words:
        if group and total + len(own) > size:
            yield group
            group, total = [], 0
        group.append(own)
        total += len(own)
    if group:
        yield group


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", echoes: bool = False) -> DataFrame:
    """Adds the columns of ``RESULT`` to every row, replacing columns of these names.

    ``echoes`` rewrites every tenth document (see ``echo``) before the search.
    """
    fields = pa.struct(
        [(n, pa.string() if t == "string" else pa.int64()) for n, t in (f.split() for f in RESULT.split(", "))]
    )

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for keys, texts in batches:
            rows = zip(keys, texts)
            words = (echo(split_words(t.as_py()), k.as_py()) if echoes else split_words(t.as_py()) for k, t in rows)
            results = [digest(w, r) for group in chunks(words) for w, r in zip(group, runs_of(group))]
            yield pa.array(results, fields)

    names = [f.name for f in fields]
    kept = [column(docs, c) for c in docs.columns if c not in names]
    found = docs.select(*kept, run(column(docs, key), column(docs, text)).alias("__runs"))
    return found.select(*["`" + c.replace("`", "``") + "`" for c in docs.columns if c not in names], "__runs.*")


def runs(text: Column) -> Column:
    """All runs of every text as array<struct<start, length, period>>."""

    @F.arrow_udf("array<struct<start: long, length: long, period: long>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parts = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            groups = chunks(split_words(t.as_py()) for t in batch)
            found = [r for group in groups for r in runs_of(group)]
            yield pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found], parts)

    return run(text)
