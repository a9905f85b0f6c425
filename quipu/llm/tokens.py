"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Texts longer than a piece are cut where no match of the pre-splitting pattern can
cross, so pieces encode exactly as the whole text would and the ids of one piece only
are in memory at a time.  Decoding works on raw bytes.

Defined cases: a null text counts as empty and has no tokens.  Repeated rows give
equal results; empty tables give empty tables; other columns pass through unchanged.
Texts without any safe boundary are encoded in one piece.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import column

PIECE = 1 << 16
#: No match of the pattern spans these places: the end of a run of letters or of digits, or where blanks follow a mark.
SAFE = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=\S)(?=\s)")
DIGEST_TYPE = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> tuple[tiktoken.Encoding, list[bytes], list[str]]:
    """The encoder, the bytes of every id and its decimal form; read once per worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    size = max(ranks.values()) + 1
    raw = [b""] * size
    for token, rank in ranks.items():
        raw[rank] = token
    encoder = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return encoder, raw, [str(i) for i in range(size)]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut at safe places."""
    start = 0
    while len(text) - start > size:
        found = SAFE.search(text, start + size)
        if found is None or found.start() >= len(text):
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode_text(text: str | None, path: str, pattern: str, size: int = PIECE) -> Iterator[list[int]]:
    """Ids of the text, piece by piece."""
    encoder = codec(path, pattern)[0]
    for piece in pieces(text or "", size):
        yield encoder.encode_ordinary(piece)


def decode_ids(ids: list[int], path: str, pattern: str) -> bytes:
    return b"".join(map(codec(path, pattern)[1].__getitem__, ids))


def digest_text(text: str | None, path: str, pattern: str, size: int = PIECE) -> dict[str, int | str]:
    """Number of ids, digest of the ids and of the bytes that they decode to."""
    decimal = codec(path, pattern)[2]
    count, ids_hash, bytes_hash = 0, hashlib.sha256(), hashlib.sha256()
    for ids in encode_text(text, path, pattern, size):
        if ids:
            ids_hash.update((("," if count else "") + ",".join(map(decimal.__getitem__, ids))).encode())
            bytes_hash.update(decode_ids(ids, path, pattern))
            count += len(ids)
    return {"n_tokens": count, "ids_sha256": ids_hash.hexdigest(), "decoded_sha256": bytes_hash.hexdigest()}


def encoded(text: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """The ids of every text as array<int>."""
    path, pattern = path or default_ranks(), pattern or default_pattern()

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ids = [[i for part in encode_text(t.as_py(), path, pattern) for i in part] for t in batch]
            yield pa.array(ids, pa.list_(pa.int32()))

    return run(text)


def decoded(ids: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """The raw bytes of every list of ids; null counts as no ids."""
    path, pattern = path or default_ranks(), pattern or default_pattern()

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([decode_ids(i.as_py() or [], path, pattern) for i in batch], pa.binary())

    return run(ids)


def digests(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256, replacing columns of these names."""
    path, pattern = path or default_ranks(), pattern or default_pattern()
    fields = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    @F.arrow_udf(DIGEST_TYPE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([digest_text(t.as_py(), path, pattern) for t in batch], fields)

    kept = [column(docs, c) for c in docs.columns if c not in fields.names]
    return docs.select(*kept, run(column(docs, text)).alias("__digest")).select(
        *["`" + c.replace("`", "``") + "`" for c in docs.columns if c not in fields.names], "__digest.*"
    )
