"""BPE encoding with a priority queue of merges, and decoding by concatenating vocabulary strings.

A text is split into words by the vocabulary's own pattern.  The bytes of a word are a
doubly linked list of symbols; every neighbouring pair that the vocabulary can merge
waits in a queue by (rank, place).  A queue entry whose pair has changed meanwhile is
stale and skipped.  Words repeat, so their ids are kept in a bounded table.

Special tokens in a text become their own id, as the vocabulary file says; their
strings split the text before the pattern does.  Long texts are split in parts at
places that no word spans, so one part's words are in memory at a time.

Defined cases: a null text counts as empty and has no tokens.  Repeated rows give equal
results; empty tables give empty tables; other columns pass through unchanged.  A word
of any length is merged as a whole, in memory and time about linear in its length.
Ids that the vocabulary does not know, and null ids, decode to nothing.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import sys
import unicodedata
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import column
from quipu.llm.tokens import DIGEST_TYPE, pieces

# Fixed value: the published pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{l}{n}]+|\s+(?!\S)|\s+"
#: Words in the table of known words, and the longest word that is kept there.
TABLE_WORDS, TABLE_LENGTH = 600_000, 64
#: Bits of an id, and of a place in a word.
SHIFT, PLACE = 24, 40
MASK = (1 << PLACE) - 1


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def younger_characters() -> str:
    """Ranges of letters and numbers that the pattern's library knows and the vocabulary's Unicode tables do not."""
    word = regex.compile(r"[\p{L}\p{N}]")
    codes = (c for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn")
    ranges: list[list[int]] = []
    for c in codes:
        if word.match(chr(c)):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


class Words(dict):
    """Ids of words seen lately; unknown words are merged and, unless very long, kept.

    When the table is full it becomes the older half: a word found there moves to the
    new half, so frequent words stay and the others go.
    """

    def __init__(self, merge) -> None:
        super().__init__()
        self.merge, self.older = merge, {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            ids = tuple(self.merge(word.encode()))
        if len(word) <= TABLE_LENGTH:
            if 2 * len(self) >= TABLE_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Vocabulary:
    """A byte-level vocabulary file: symbols, ranked merges and special tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        symbols: dict[str, int] = content["model"]["vocab"]
        alphabet = byte_alphabet()
        self.first = [0] * 256
        for char, byte in alphabet.items():
            self.first[byte] = symbols[char]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"])
        #: Rank of a pair, by both ids in one number; and the id of the merged pair, by rank.
        self.ranks: dict[int, int] = {}
        self.both: list[int] = []
        for rank, (a, b) in enumerate(pairs):
            self.ranks[symbols[a] << SHIFT | symbols[b]] = rank
            self.both.append(symbols[a + b])
        self.special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        self.raw = {i: bytes(alphabet[c] for c in s) for s, i in symbols.items()}
        self.raw |= {i: s.encode() for s, i in self.special.items()}
        self.decimal = {i: str(i) for i in self.raw}
        self.words = Words(self.merge)
        names = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.fast = regex.compile(PATTERN.format(L=r"\p{L}", N=r"\p{N}", l=r"\p{L}", n=r"\p{N}"))

    @functools.cached_property
    def young(self) -> frozenset[str]:
        return frozenset(regex.findall(f"[{younger_characters()}]", "".join(map(chr, range(0x80, 0xD800))) + "".join(map(chr, range(0xE000, sys.maxunicode + 1)))))

    @functools.cached_property
    def exact(self) -> regex.Pattern:
        young = younger_characters()
        parts = {"L": rf"[\p{{L}}--[{young}]]", "N": rf"[\p{{N}}--[{young}]]"}
        rest = rf"[^\s[\p{{L}}--[{young}]][\p{{N}}--[{young}]]]"
        return regex.compile(PATTERN.replace(r"[^\s{l}{n}]", rest).format(**parts), regex.V1)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        ids = [self.first[b] for b in word]
        known, merged = self.ranks.get, self.both
        # A queue entry is rank and place in one number, so equal ranks come from left to right.
        queue = [
            rank << PLACE | place
            for place, (a, b) in enumerate(zip(ids, ids[1:]))
            if (rank := known(a << SHIFT | b)) is not None
        ]
        heapq.heapify(queue)
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        while queue:
            entry = heapq.heappop(queue)
            rank, place = entry >> PLACE, entry & MASK
            right = after[place]
            # Stale: the symbol is gone, is the last one now, or another pair begins here.
            if ids[place] < 0 or right < 0 or known(ids[place] << SHIFT | ids[right]) != rank:
                continue
            ids[place], ids[right] = both, _ = merged[rank], -1
            after[place] = beyond = after[right]
            if beyond >= 0:
                before[beyond] = place
                if (found := known(both << SHIFT | ids[beyond])) is not None:
                    heapq.heappush(queue, found << PLACE | place)
            left = before[place]
            if left >= 0 and (found := known(ids[left] << SHIFT | both)) is not None:
                heapq.heappush(queue, found << PLACE | left)
        return [i for i in ids if i >= 0]

    def parts(self, text: str) -> Iterator[str | int]:
        """Stretches of ordinary text, and the ids of special tokens between them."""
        at = 0
        for found in self.split.finditer(text) if self.split else ():
            yield from pieces(text[at : found.start()])
            yield self.special[found.group()]
            at = found.end()
        yield from pieces(text[at:] if at else text)

    def encode(self, text: str | None) -> Iterator[list[int]]:
        """Ids of the text, part by part."""
        for part in self.parts(text or ""):
            if isinstance(part, int):
                yield [part]
            else:
                pattern = self.fast if part.isascii() or self.young.isdisjoint(part) else self.exact
                yield list(chain.from_iterable(map(self.words.__getitem__, pattern.findall(part))))

    def decode(self, ids) -> bytes:
        """The bytes of the vocabulary strings, one after the other."""
        return b"".join([self.raw.get(i, b"") for i in ids])


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Read once per worker."""
    return Vocabulary(path)


def lossy(raw: bytes) -> bytes:
    """UTF-8 of the text that ``raw`` decodes to, with replacement characters for what is no UTF-8."""
    return raw.decode("utf-8", "replace").encode()


def digest_text(text: str | None, path: str) -> dict[str, int | str]:
    """Number of ids, digest of the ids and of the text that they decode to."""
    words = vocabulary(path)
    decimal, count = words.decimal, 0
    ids_hash, text_hash, open_bytes = hashlib.sha256(), hashlib.sha256(), b""
    for ids in words.encode(text):
        if ids:
            ids_hash.update((("," if count else "") + ",".join(map(decimal.__getitem__, ids))).encode())
            text_hash.update(lossy(b"".join(map(words.raw.__getitem__, ids))))
            count += len(ids)
    return {"n_tokens": count, "ids_sha256": ids_hash.hexdigest(), "decoded_sha256": text_hash.hexdigest()}


def encoded(text: Column, path: str | None = None) -> Column:
    """The ids of every text as array<int>."""
    path = path or default_vocabulary()

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = vocabulary(path)
        for batch in batches:
            yield pa.array([list(chain.from_iterable(words.encode(t.as_py()))) for t in batch], pa.list_(pa.int32()))

    return run(text)


def decoded(ids: Column, path: str | None = None) -> Column:
    """The text of every list of ids; null counts as no ids."""
    path = path or default_vocabulary()

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = vocabulary(path)
        for batch in batches:
            yield pa.array([words.decode(i.as_py() or []).decode("utf-8", "replace") for i in batch], pa.string())

    return run(ids)


def digests(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256, replacing columns of these names."""
    path = path or default_vocabulary()
    fields = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    @F.arrow_udf(DIGEST_TYPE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([digest_text(t.as_py(), path) for t in batch], fields)

    kept = [column(docs, c) for c in docs.columns if c not in fields.names]
    return docs.select(*kept, run(column(docs, text)).alias("__digest")).select(
        *["`" + c.replace("`", "``") + "`" for c in docs.columns if c not in fields.names], "__digest.*"
    )
