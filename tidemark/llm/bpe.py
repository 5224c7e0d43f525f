"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

``encode_table`` gives the ids of every text, ``decode_table`` the raw bytes of
every id list, and ``round_trip`` both in one pass.  Defined results: a null text counts as empty, an empty text has
no ids; repeated rows are encoded each; an empty table gives an empty table;
columns of the input other than the named ones are ignored, so clashing names
do no harm.  A text is never shortened: long ones are pre-split at places that
no match of the pattern can cross, and encoded piece by piece.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textblocks import BLOCK_BYTES, giving_back, text_slices

#: Longest piece given to the library at once, in characters, where the text has a safe place to cut.
PIECE_CHARS = 1 << 16


_CODECS: dict[tuple[str, str], Codec] = {}


class Codec:
    """An encoding read from a rank file: one base64 token and its rank a line, no special tokens."""

    def __init__(self, rank_file: str, pattern: str):
        import tiktoken

        with open(rank_file, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self._encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._matches = regex.compile(pattern)

    @classmethod
    def of(cls, rank_file: str, pattern: str) -> Codec:
        """One codec per Python worker, built at first use."""
        key = rank_file, pattern
        if key not in _CODECS:
            _CODECS[key] = cls(rank_file, pattern)
        return _CODECS[key]

    def encode(self, text: str) -> np.ndarray:
        """Ids of the text, the matches of the pattern encoded separately."""
        parts = [self._piece(p) for p in split_safely(text)]
        return np.concatenate(parts).astype("<u4") if parts else np.zeros(0, dtype="<u4")

    def _piece(self, piece: str) -> np.ndarray:
        if len(piece) <= PIECE_CHARS:
            return self._encoding.encode_to_numpy(piece, disallowed_special=())
        # No safe cut for very long: one match may be huge, so match here and merge each match by itself.
        ids: list[int] = []
        for m in self._matches.finditer(piece):
            ids.extend(self._encoding._encode_single_piece(m.group()))
        return np.array(ids, dtype="<u4")

    def decode(self, ids) -> bytes:
        """The raw bytes; no replacement of invalid UTF-8."""
        return self._encoding.decode_bytes(list(ids))


def split_safely(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Pieces of about ``limit`` characters whose ids, put together, are those of the text.

    No match runs from a non-space into white space, and only white space looks
    ahead, so a place between a non-space and a following blank or line break
    is always the edge of two matches.  Without such a place the piece grows.
    """
    at, n = 0, len(text)
    while n - at > limit:
        cut = _last_edge(text, at + 1, at + limit)
        if cut < 0:
            cut = _next_edge(text, at + limit)
        yield text[at:cut]
        at = cut
    if at < n:
        yield text[at:]


def _edge(text: str, i: int) -> bool:
    return not text[i - 1].isspace()


def _last_edge(text: str, low: int, high: int) -> int:
    while high > low:
        high = max(text.rfind(" ", low, high), text.rfind("\n", low, high))
        if high < 0 or _edge(text, high):
            return high
    return -1


def _next_edge(text: str, low: int) -> int:
    for m in regex.finditer(r"[ \n]", text, pos=low):
        if _edge(text, m.start()):
            return m.start()
    return len(text)


def encode_table(
    docs: DataFrame, rank_file: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, ids binary`` (little-endian unsigned 32-bit) per row.

    ``rank_file`` must be readable at that path on every executor (an installed
    package, or a file shipped with the job).
    """

    def run(batches):
        codec = Codec.of(rank_file, pattern)
        for ids_of, texts in _texts(batches):
            ids = [codec.encode(t or "").tobytes() for t in texts]
            yield pa.record_batch([ids_of, pa.array(ids, pa.binary())], names=["id", "ids"])

    source = _source(docs, id_column, text_column)
    return source.mapInArrow(giving_back(run), f"id {source.schema['id'].dataType.simpleString()}, ids binary")


def decode_table(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``id, ids, decoded binary``: the raw bytes that the ids stand for."""

    def run(batches):
        codec = Codec.of(rank_file, pattern)
        for batch in batches:
            for a, b in text_slices(batch.column("ids"), 4 * BLOCK_BYTES):
                part = batch.slice(a, b - a)
                out = [codec.decode(np.frombuffer(x.as_py() or b"", dtype="<u4")) for x in part.column("ids")]
                yield pa.record_batch([part.column("id"), part.column("ids"), pa.array(out, pa.binary())], names=["id", "ids", "decoded"])

    kind = encoded.schema["id"].dataType.simpleString()
    return encoded.mapInArrow(giving_back(run), f"id {kind}, ids binary, decoded binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, ids, decoded``: encoding and decoding of the ids in one pass, with one codec per worker."""

    def run(batches):
        codec = Codec.of(rank_file, pattern)
        for ids_of, texts in _texts(batches):
            ids = [codec.encode(t or "") for t in texts]
            out = [codec.decode(x) for x in ids]
            yield pa.record_batch([ids_of, pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(out, pa.binary())], names=["id", "ids", "decoded"])

    source = _source(docs, id_column, text_column)
    return source.mapInArrow(giving_back(run), f"id {source.schema['id'].dataType.simpleString()}, ids binary, decoded binary")


def _source(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))


def _texts(batches) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts in blocks of bounded size."""
    for batch in batches:
        for a, b in text_slices(batch.column(1)):
            yield batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a).to_pylist()


def digests(decoded: DataFrame) -> DataFrame:
    """Token count and digests of ids and decoded bytes."""
    return decoded.select(
        F.col("id").alias("doc_id"),
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def brute_digests(codec: Codec, text: str | None) -> tuple[int, str, str]:
    """The same three values from one call of the library on the whole text (for tests)."""
    ids = codec._encoding.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
