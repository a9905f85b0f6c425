"""Personal data: fixed patterns, and a semi-Markov conditional random field for the rest.

The fixed patterns of the contract find base spans, which always stay.  The field
cuts every stretch of text that holds digits or ``@`` into segments of bounded length
and labels them jointly: whole-span features (shape, digit counts, checksum, parts in
range, the word before) score each candidate, label pairs score their sequence, and
dynamic programming finds the best cut.  Its spans are added where no base span is.
Long stretches, also chunks without any blank, are cut in overlapping windows, and a span is
taken from the window that owns its start, so memory is bounded and no text is left out.

The field is trained by gradient ascent on a bounded sample of stretches (``FIT_REGIONS``):
on their base spans, on these spans written otherwise (a telephone number without its plus
sign or with other separators, a card number in groups with dots, cue words before them), and
on numbers that only look alike (a wrong check digit, dates, book numbers, thousands, parts
out of range).  ``measure`` gives precision and recall on stretches kept out of the training.

Defined cases: a null or empty text has no spans; offsets are code points; base spans
of different kinds may overlap and all stay; repeated texts get equal spans.  Documents are
searched for stretches with base spans until there are enough or all are read; if no
document has any, only base spans are found.  Empty tables give empty tables.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import column

KINDS = ("email", "ip", "card", "phone")
FIT_REGIONS = 600
EPOCHS = 12
MAX_ATOMS = 24
MAX_CHARS = 80
REGION_CHARS = 400

#: The patterns of the contract, written so that they never scan a run of characters twice.
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, end, kind's number


def luhn(digits: str) -> bool:
    total = 0
    for at, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if at % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small_parts(address: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in address.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their ``@``."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        tail = DOMAIN.match(text, at + 1) if start < at else None
        if tail:
            done = tail.end()
            yield start, done
        at = text.find("@", at + 1)


def base_spans(text: str | None) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    text = text or ""
    spans = [(s, e, 0) for s, e in emails(text)]
    spans += [(m.start(), m.end(), 1) for m in IP.finditer(text) if _small_parts(m[0])]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), m.end(), 2))
    if "+" in text:
        spans += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


# --- stretches and candidate segments ----------------------------------------

TRIGGER = re.compile(r"[0-9@]\S*")
MARK = re.compile(r"[0-9@]+")
ATOM = re.compile(r"[A-Za-z0-9_%-]+|\s+|.", re.S)
IP_SHAPE = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
CARD_SHAPE = re.compile(r"[0-9](?:[\x20.-]?[0-9])+")
PHONE_SHAPE = re.compile(r"[+(]?[0-9][\x20()./0-9-]*[0-9]")
EMAIL_SHAPE = re.compile(r"[^\s@]+@[^\s@.]+(?:\.[^\s@.]+)*")
#: Words that announce a kind.
CUES = (
    frozenset(("mail", "email", "e-mail", "mailto")),
    frozenset(("ip", "host", "address", "server")),
    frozenset(("card", "visa", "mastercard", "credit")),
    frozenset(("tel", "telephone", "phone", "call", "mobile", "fax", "cell")),
)


#: Words that announce numbers of other kinds.
OTHER_CUES = frozenset(("isbn", "issn", "doi", "version", "order", "id", "no", "date", "on", "since", "until", "page", "total"))
DATE = re.compile(r"[0-9]{4}[ ./-][0-9]{1,2}[ ./-][0-9]{1,2}(?:[ -][0-9]+)?|[0-9]{1,2}[ ./-][0-9]{1,2}[ ./-][0-9]{4}|[12][0-9]{3} ?[-/] ?[12][0-9]{3}")
THOUSANDS = re.compile(r"[0-9]{1,3}(?:([ .])[0-9]{3})(?:\1[0-9]{3})*")
CHECKED = re.compile(r"97[89][ -]?[0-9][0-9 -]*|[0-9][0-9 -]*[ -][0-9]")
QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
GROUPS = re.compile(r"[0-9]+")
GROUP_BEFORE = re.compile(r"(?<![0-9])[0-9]{1,4}[ .-]?$")
GROUP_AFTER = re.compile(r"[ .-]?[0-9]{1,4}(?![0-9])")


def _phone_features(text: str) -> list[str]:
    """How the digits are grouped, and what else the number could be."""
    groups = [len(g) for g in GROUPS.findall(text)]
    own = ["phone_area"] if re.match(r"(?:\+[0-9]{1,3} ?)?\([0-9]{2,5}\)", text) else []
    if text[0] == "+":
        groups = groups[1:] if len(groups) > 1 else groups
    if len(groups) >= 2 + (text[0] not in "+(") and all(2 <= g <= 4 for g in groups) and groups[-1] >= 3:
        own.append("phone_groups")
    if len(groups) <= 2 and text[0] not in "+(":
        own.append("phone_run")
    if text[0] not in "+(":
        shapes = (("phone_date", DATE), ("phone_thousands", THOUSANDS), ("phone_check", CHECKED), ("quad", QUAD))
        own += [name for name, shape in shapes if shape.fullmatch(text)]
    return own


def _stretches(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of neighbouring chunks with digits or ``@``, each with one chunk before it.

    Of a chunk longer than a window only what is near a digit or ``@`` is taken: no span is longer than ``MAX_CHARS``.
    """
    start = end = -1
    seen = 0
    for m in TRIGGER.finditer(text):
        low = max(seen, m.start() - MAX_CHARS)
        left = m.start() - len(text[low : m.start()].split()[-1]) if low < m.start() and not text[m.start() - 1].isspace() else m.start()
        if m.end() - m.start() <= REGION_CHARS:
            pieces = [(left, m.end())]
        else:
            marks = MARK.finditer(text, m.start(), m.end())
            pieces = ((max(left, x.start() - MAX_CHARS), min(m.end(), x.end() + MAX_CHARS)) for x in marks)
        for low, high in pieces:
            if start >= 0 and low - end <= 1:
                end = high
            else:
                if start >= 0:
                    yield start, end
                start, end = low, high
        seen = m.end()
    if start >= 0:
        yield start, end


def windows(text: str | None) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, first, last) of windows of at most ``REGION_CHARS`` over all stretches.

    A window owns the spans that start in [first, last).  Windows of a long stretch
    overlap, so that a span of ``MAX_CHARS`` stands whole in the window that owns it,
    with as much text before it.
    """
    for start, end in _stretches(text or ""):
        first = low = start
        while end - low > REGION_CHARS:
            high = low + REGION_CHARS
            yield low, high, first, high - MAX_CHARS
            first = high - MAX_CHARS
            low = first - MAX_CHARS
        yield low, end, first, end


def regions(text: str | None) -> Iterator[tuple[int, int]]:
    """The windows' bounds."""
    for start, end, _, _ in windows(text):
        yield start, end


#: Names of the features; each is a weight of its own for the kinds that use it.
FEATURES = {
    name: i
    for i, name in enumerate(
        (
            "email", "email_dot", "email_plain_domain", "email_strict", "ip", "card", "card_luhn", "card_wrong",
            "phone", "phone_plus", "phone_marks", "phone_length", "phone_other_length", "cue", "touches_left",
            "touches_right", "out_digits", "out_long_digits", "out_at", "out_plus", "phone_area", "phone_groups",
            "phone_date", "phone_thousands", "phone_check", "quad", "phone_run", "other_cue", "card_part", "phone_part",
        )
    )
}
N_LABELS = len(KINDS) + 1  # the last is "out"
OUT = len(KINDS)


def _segment_features(text: str, before: str, after: str, cue: str) -> list[tuple[int, list[int]]]:
    """(kind, features) of every kind that the span could be; ``before`` and ``after`` are up to six characters."""
    f = FEATURES
    made: list[tuple[int, list[int]]] = []
    digits = sum("0" <= c <= "9" for c in text)
    part = GROUP_BEFORE.search(before) or GROUP_AFTER.match(after)  # more digits in groups stand beside it
    before, after = before[-1:], after[:1]
    if text.count("@") == 1 and EMAIL_SHAPE.fullmatch(text):
        domain = text.partition("@")[2]
        own = [f["email"]] + ([f["email_dot"]] if "." in domain else [f["email_plain_domain"]])
        if DOMAIN.fullmatch(domain) and LOCAL.issuperset(text.partition("@")[0]):
            own.append(f["email_strict"])
        made.append((0, own))
    if digits >= 4 and IP_SHAPE.fullmatch(text) and _small_parts(text):
        made.append((1, [f["ip"]]))
    if 12 <= digits <= 19 and CARD_SHAPE.fullmatch(text):
        own = [f["card"], f["card_luhn"] if luhn(_digits(text)) else f["card_wrong"]]
        own += [f["card_part"]] if part and not text.isdigit() else []
        own += [f["quad"]] if QUAD.fullmatch(text) else []
        made.append((2, own))
    if 7 <= digits <= 15 and PHONE_SHAPE.fullmatch(text) and not text.isdigit():
        own = [f["phone"], f["phone_length"] if 9 <= digits <= 15 else f["phone_other_length"]]
        own += [f["phone_plus"]] if text[0] == "+" else []
        own += [f["phone_marks"]] if any(c in " ()./-" for c in text) else []
        own += [f[name] for name in _phone_features(text)]
        own += [f["phone_part"]] if part else []
        made.append((3, own))
    for kind, own in made:
        if cue in CUES[kind]:
            own.append(f["cue"])
        elif cue in OTHER_CUES:
            own.append(f["other_cue"])
        if before and (before.isalnum() or before in "+@"):
            own.append(f["touches_left"])
        if after and (after.isalnum() or after == "@"):
            own.append(f["touches_right"])
    return made


@dataclass
class Lattice:
    """Candidate segments of a stretch: for each end atom, (first atom, label, features)."""

    bounds: list[int]
    ending: list[list[tuple[int, int, list[int]]]]


def lattice(text: str, start: int, end: int) -> Lattice:
    body = text[start:end]
    atoms = [(m.start(), m.end()) for m in ATOM.finditer(body)]
    bounds = [start + a for a, _ in atoms] + [end]
    ending: list[list[tuple[int, int, list[int]]]] = [[] for _ in range(len(atoms) + 1)]
    head = re.search(r"([A-Za-z-]+)\W{0,2}$", text[max(0, start - 20) : start])
    cue = head[1].lower() if head else ""
    f = FEATURES
    for i, (a, b) in enumerate(atoms):
        atom = body[a:b]
        out: list[int] = []  # plain text is the reference, with score zero
        if atom[0].isdigit():
            out.append(f["out_long_digits"] if len(atom) > 6 else f["out_digits"])
        elif atom in "@+":
            out.append(f["out_at"] if atom == "@" else f["out_plus"])
        ending[i + 1].append((i, OUT, out))
        if atom.isspace() or atom in ").,;:":
            continue
        marks = has_digit = False
        for j in range(i, min(len(atoms), i + MAX_ATOMS)):
            c, d = atoms[j]
            if d - a > MAX_CHARS:
                break
            piece = body[c:d]
            marks = marks or "@" in piece
            has_digit = has_digit or any("0" <= x <= "9" for x in piece)
            if not (marks or has_digit) and j > i + 8:
                break
            if (marks or has_digit) and not piece.isspace() and piece[-1].isalnum():
                before = text[max(0, start + a - 6) : start + a]
                for kind, own in _segment_features(body[a:d], before, text[start + d : start + d + 6], cue):
                    ending[j + 1].append((i, kind, own))
        if atom.isalpha():
            cue = atom.lower()
    return Lattice(bounds, ending)


# --- the field ---------------------------------------------------------------


@dataclass
class Field:
    """Weights of the features and of pairs of neighbouring labels."""

    weights: np.ndarray
    pairs: np.ndarray

    def best(self, grid: Lattice) -> list[tuple[int, int, int]]:
        """The best cut: (first atom, end atom, label) of the segments that are no "out"."""
        n = len(grid.ending) - 1
        pairs = self.pairs.tolist()
        weights = self.weights.tolist()
        score = [[-math.inf] * N_LABELS for _ in range(n + 1)]
        back: list[list[tuple[int, int] | None]] = [[None] * N_LABELS for _ in range(n + 1)]
        score[0][OUT] = 0.0
        for end in range(1, n + 1):
            for first, label, own in grid.ending[end]:
                gain = sum(weights[x] for x in own)
                for prev in range(N_LABELS):
                    value = score[first][prev] + pairs[prev][label] + gain
                    if value > score[end][label]:
                        score[end][label] = value
                        back[end][label] = (first, prev)
        found = []
        end, label = n, max(range(N_LABELS), key=lambda x: score[n][x])
        while end > 0:
            first, prev = back[end][label]
            if label != OUT:
                found.append((first, end, label))
            end, label = first, prev
        return found[::-1]


def _log_sum(values: Sequence[float]) -> float:
    top = max(values, default=-math.inf)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


def _gradient(field_: Field, grid: Lattice, gold: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Observed minus expected counts of features and label pairs."""
    n = len(grid.ending) - 1
    scores = [[(i, y, own, sum(field_.weights[x] for x in own)) for i, y, own in row] for row in grid.ending]
    pairs = field_.pairs
    ahead = [[-math.inf] * N_LABELS for _ in range(n + 1)]
    ahead[0][OUT] = 0.0
    for end in range(1, n + 1):
        got: list[list[float]] = [[] for _ in range(N_LABELS)]
        for i, y, _, s in scores[end]:
            got[y].append(s + _log_sum([ahead[i][p] + pairs[p, y] for p in range(N_LABELS)]))
        ahead[end] = [_log_sum(g) for g in got]
    behind: list[list[list[float]]] = [[[] for _ in range(N_LABELS)] for _ in range(n + 1)]
    after = [[-math.inf] * N_LABELS for _ in range(n + 1)]
    after[n] = [0.0] * N_LABELS
    total = _log_sum(ahead[n])
    w, t = np.zeros(len(FEATURES)), np.zeros((N_LABELS, N_LABELS))
    for end in range(n, 0, -1):
        if end < n:
            after[end] = [_log_sum(g) for g in behind[end]]
        for i, y, own, s in scores[end]:
            for p in range(N_LABELS):
                rest = pairs[p, y] + s + after[end][y]
                behind[i][p].append(rest)
                share = math.exp(min(0.0, ahead[i][p] + rest - total)) if ahead[i][p] > -math.inf else 0.0
                if share > 1e-9:
                    w[own] -= share
                    t[p, y] -= share
    prev, at = OUT, 0
    features = {(i, end, y): own for end, row in enumerate(grid.ending) for i, y, own in row}
    for first, end, label in [*gold, (n, n, -1)]:
        for i in range(at, first):
            w[features[i, i + 1, OUT]] += 1
            t[prev, OUT] += 1
            prev = OUT
        if label >= 0:
            w[features[first, end, label]] += 1
            t[prev, label] += 1
            prev, at = label, end
    return w, t


def _gold(marked: Sequence[Span], grid: Lattice) -> list[tuple[int, int, int]] | None:
    """Marked spans as segments, longer ones first where they overlap; None if one is no candidate."""
    index = {b: i for i, b in enumerate(grid.bounds)}
    known = {(i, end, y) for end, row in enumerate(grid.ending) for i, y, _ in row}
    chosen: list[tuple[int, int, int]] = []
    for start, end, kind in sorted(marked, key=lambda s: (s[0] - s[1], s[2])):
        segment = (index.get(start, -1), index.get(end, -1), kind)
        if segment not in known:
            return None
        if all(segment[1] <= a or segment[0] >= b for a, b, _ in chosen):
            chosen.append(segment)
    return sorted(chosen)


# --- spans written otherwise, and numbers that look alike ---------------------


def _wrong_check(digits: str) -> str:
    return digits[:-1] + str((int(digits[-1]) + 1) % 10)


def _rewritten(found: str, kind: int, rng: random.Random) -> tuple[str, bool]:
    """Another form of a base span, and whether it still is one of its kind."""
    digits = _digits(found)
    if kind == 0:
        return (found, True) if rng.random() < 0.5 else (found.partition("@")[0] + "@" + found.partition("@")[2].replace(".", ""), False)
    if kind == 1:
        parts = found.split(".")
        parts[rng.randrange(4)] = str(rng.randint(256, 999))
        return ".".join(parts), False
    if kind == 2:
        real = rng.random() < 0.5
        digits = digits if real else _wrong_check(digits)
        mark = rng.choice(["", " ", "-", "."])
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4)), real
    local = digits[-10:]
    forms = ("{0}-{1}-{2}", "{0}.{1}.{2}", "{0} {1} {2}", "({0}) {1}-{2}", "({0}) {1} {2}", "(0{0}) {1} {2}", "0{0} {1} {2}", "+44 {0} {1} {2}")
    return rng.choice(forms).format(local[:-7], local[-7:-4], local[-4:]), True


def _alike(rng: random.Random) -> str:
    """A number that is no personal data."""
    year, month, day = rng.randint(1900, 2039), rng.randint(1, 12), rng.randint(1, 28)
    n = rng.randrange(10**9)
    forms = (
        f"{year}-{month:02}-{day:02}",
        f"{day:02}/{month:02}/{year}",
        f"{day:02}.{month:02}.{year}",
        f"{year}-{month:02}-{day:02} {n % 24:02}",
        f"{year}-{min(2100, year + n % 60)}",
        f"978-{n % 10}-{n % 89 + 10}-{n % 900000 + 100000}-{n % 7}",
        f"{n % 10}-{n % 900 + 100}-{n % 90000 + 10000}-{n % 8}",
        f"{n % 900 + 100} {n // 1000 % 900 + 100} {n // 7 % 900 + 100}",
        f"{n % 90 + 10}.{n // 100 % 900 + 100}.{n // 11 % 900 + 100}",
        f"{n % 9 + 1}.{n:09}",
        f"{n // 10**5}-{n % 10**5:05}",
    )
    return rng.choice(forms)


def variants(text: str, count: int = 3) -> list[tuple[str, list[Span]]]:
    """Up to ``count`` stretches made from the base spans of ``text``, with what they really hold.

    Draws follow from the text alone.  Forms that hold other base spans than they should are left out.
    """
    rng = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    made: list[tuple[str, list[Span]]] = []
    found = base_spans(text)
    for _ in range(count if found else 0):
        start, end, kind = rng.choice(found)
        body, real = (_alike(rng), False) if rng.random() < 0.35 else _rewritten(text[start:end], kind, rng)
        words = sorted(CUES[kind]) if real or rng.random() < 0.3 else sorted(OTHER_CUES)
        head = rng.choice(words) + rng.choice([" ", ": "]) if rng.random() < 0.5 else ""
        marked = [(len(head), len(head) + len(body), kind)] if real else []
        if all(s in marked for s in base_spans(head + body)):
            made.append((head + body, marked))
        if kind == 3 and rng.random() < 0.2:  # a number that is the beginning of an address
            address = f"{_digits(text[start:end])[-10:]}@example.org"
            made.append((address, [(0, len(address), 0)]))
    return made


def measure(model: Field | None, stretches: Sequence[str], count: int = 3) -> dict[str, tuple[int, int, int]]:
    """Per kind (found and right, found, to be found) over the variants of stretches kept out of the training."""
    out = {kind: [0, 0, 0] for kind in KINDS}
    for text in stretches:
        for body, marked in variants(text, count):
            found = set(spans(body, model)[1])
            for s in found:
                out[KINDS[s[2]]][0] += s in marked
                out[KINDS[s[2]]][1] += 1
            for s in marked:
                out[KINDS[s[2]]][2] += 1
    return {kind: tuple(n) for kind, n in out.items()}


def learn(stretches: Sequence[str], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4) -> Field | None:
    """Gradient ascent, one stretch at a time, with steps that shrink where gradients were large."""
    examples = []
    for stretch in stretches:
        for text, marked in [(stretch, base_spans(stretch)), *variants(stretch)]:
            grid = lattice(text, 0, len(text))
            gold = _gold(marked, grid)
            if gold is not None:
                examples.append((grid, gold))
    if not any(gold for _, gold in examples):
        return None
    made = Field(np.zeros(len(FEATURES)), np.zeros((N_LABELS, N_LABELS)))
    seen_w, seen_t = np.full(len(FEATURES), 1e-2), np.full((N_LABELS, N_LABELS), 1e-2)
    for _ in range(epochs):
        for grid, gold in examples:
            w, t = _gradient(made, grid, gold)
            t[:, OUT] = 0.0
            w -= decay * made.weights
            t -= decay * made.pairs
            seen_w += w * w
            seen_t += t * t
            made.weights += rate * w / np.sqrt(seen_w)
            made.pairs += rate * t / np.sqrt(seen_t)
    return made


def spans(text: str | None, model: Field | None) -> tuple[list[Span], list[Span]]:
    """(base, all) spans, both by start and then kind."""
    text = text or ""
    base = base_spans(text)
    if model is None:
        return base, base
    more: list[Span] = []
    covered = sorted((s, e) for s, e, _ in base)
    at = 0
    done = 0
    for start, end, own, stop in windows(text):
        grid = lattice(text, start, end)
        if all(len(row) <= 1 for row in grid.ending):
            continue
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        near = [c for c in covered[at : at + MAX_CHARS * 8] if c[0] < end]
        for first, last, label in model.best(grid):
            s, e = grid.bounds[first], grid.bounds[last]
            if max(own, done) <= s < stop:
                done = e
                if all(e <= a or s >= b for a, b in near):
                    more.append((s, e, label))
    return base, sorted(base + more, key=lambda s: (s[0], s[2], s[1]))


def listed(found: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in found)


# --- Spark -------------------------------------------------------------------


def sample_stretches(docs: DataFrame, text: str = "text", key: str = "doc_id", fit_regions: int = FIT_REGIONS) -> list[str]:
    """At most ``fit_regions`` stretches of at most ``REGION_CHARS`` characters, those of the smallest hashes.

    Stretches with base spans come first and make up two thirds if there are as many.  About
    ``fit_regions * 10`` documents, chosen by hash, are read for it, and 16 times as many as
    long as stretches with base spans are lacking, at most all.
    """
    share = min(1.0, fit_regions * 10 / max(1, docs.count()))
    mix = F.pmod(F.xxhash64(column(docs, key).cast("string"), F.lit("pii")), F.lit(1_000_000_000))

    @F.arrow_udf("array<struct<s: string, held: boolean>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("s", pa.string()), ("held", pa.bool_())]))
        for batch in batches:
            texts = [t.as_py() or "" for t in batch]
            # A chunk of context stays outside, so that a stretch is learned from as it stands.
            pieces = ([t[a:b] for a, b in regions(t)] for t in texts)
            yield pa.array([[{"s": p, "held": bool(base_spans(p))} for p in row] for row in pieces], kind)

    wanted = fit_regions * 2 // 3
    while True:
        chosen = docs.where(mix < int(share * 1_000_000_000) + 1)
        stretches = chosen.select(F.inline(cut(column(docs, text)))).distinct()
        order = [F.xxhash64("s"), F.col("s")]
        heads = [stretches.where(F.col("held") == held).orderBy(*order).limit(fit_regions) for held in (True, False)]
        rows = heads[0].unionByName(heads[1]).collect()
        held, plain = ([r["s"] for r in rows if r["held"] == x] for x in (True, False))
        if len(held) >= wanted or share >= 1.0:
            held = held[: max(wanted, fit_regions - len(plain))]
            return held + plain[: fit_regions - len(held)]
        share = min(1.0, share * 16)


def fit(docs: DataFrame, **names) -> Field | None:
    return learn(sample_stretches(docs, **names))


def find(text: Column, model: Field | None) -> Column:
    """Struct of the base spans, all spans, and counts and digest of the base spans."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    counts = [f"n_{k}" for k in KINDS]
    kind = pa.struct(
        [*[(c, pa.int64()) for c in counts], ("base_sha256", pa.string()), ("listed", pa.string()), ("spans", pa.list_(span))]
    )

    def row(value: str | None) -> dict:
        base, every = spans(value, model)
        out = {c: sum(k == i for _, _, k in base) for i, c in enumerate(counts)}
        out["base_sha256"] = hashlib.sha256(listed(base).encode()).hexdigest()
        out["listed"] = listed(every)
        out["spans"] = [{"start": s, "end": e, "kind": KINDS[k]} for s, e, k in every]
        return out

    @F.arrow_udf(
        ", ".join(f"{c} long" for c in counts)
        + ", base_sha256 string, listed string, spans array<struct<start: long, end: long, kind: string>>"
    )
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([row(t.as_py()) for t in batch], kind)

    return run(text)
