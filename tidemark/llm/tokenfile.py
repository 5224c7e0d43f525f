"""Token ids of a corpus as ORC files, sorted by document id.

``write`` encodes every text with a tokenizer of the tokenizers library, adds an
end id and stores ``id, tie, ids`` in ascending order of the ids over all files.
What ORC offers is used as it is: id lists are integer columns and so run-length
encoded, files consist of stripes that are read in parallel, a row index holds
the smallest and largest id of every few rows, and Bloom filters on the id let
a search for single documents pass over whole stripes and row groups.  ``read``
gives the rows, ``lookup`` those of some documents, ``positions`` the place of
every document in the one long sequence of ids.

Encoding is exact and cheap: a text is cut where white space follows something
else, or a punctuation mark a letter or digit, which no match of a byte-level
pattern crosses, and the library encodes each distinct piece once while it is
remembered.  Cuts and distinct pieces are found on the bytes of a block.  The
memory of pieces is bounded and only saves time.

Defined results: a null text counts as empty; an empty text is stored as the
end id alone.  Null ids come first.  Rows with the same id follow the hash of
their text (``tie``), equal rows each have their own place.  An empty table gives empty files.
Columns other than the named ones are ignored, so clashing names do no harm.
Long texts are encoded piece by piece and never shortened.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import split_safely
from tidemark.llm.textblocks import IS_SPACE, as_bytes, text_slices
from tidemark.session import materialize

#: Id put behind every document.
END_ID = 2
#: Characters of white space as the pattern of the tokenizer knows them (the property White_Space); a fixed value.
WHITE = frozenset("\t\n\v\f\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))))
#: Those of two and of three bytes, as numbers.
WHITE_2, WHITE_3 = (np.array([int.from_bytes(c.encode()) for c in sorted(WHITE) if len(c.encode()) == n]) for n in (2, 3))
#: ASCII letters and digits, and the other visible ASCII characters.
IS_ALNUM = np.array([i < 128 and chr(i).isalnum() for i in range(256)])
IS_MARK = np.array([32 < i < 127 and not chr(i).isalnum() for i in range(256)])
#: Pieces remembered per Python worker, and ids of theirs; a piece longer than PIECE_BYTES is forgotten first.
REMEMBERED = 700_000
REMEMBERED_IDS = 8_000_000
PIECE_BYTES = 64
#: Characters given to the library at once.
CALL_CHARS = 2_000
#: Bytes of text looked up together; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20


@dataclass(frozen=True)
class Layout:
    """How the files are laid out: bytes of a stripe, rows of an index entry, share of false hits of a Bloom filter."""

    stripe_bytes: int = 16 << 20
    index_rows: int = 1000
    false_hits: float = 0.01
    compression: str = "zstd"

    def options(self) -> dict[str, str]:
        return {
            "orc.stripe.size": str(self.stripe_bytes),
            "orc.create.index": "true",
            "orc.row.index.stride": str(self.index_rows),
            "orc.bloom.filter.columns": "id",
            "orc.bloom.filter.fpp": str(self.false_hits),
            "compression": self.compression,
        }


_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts by a tokenizer file, each distinct piece encoded once as long as it is remembered.

    The file must describe a byte-level model without prefix space: a character
    of a token's name then stands for one byte of text.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True  # their names in a text are text
        self._bytes = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self._bytes[number] = len(token)
        self._remember({}, np.zeros(0, np.int32), np.zeros(0, np.int64))

    @classmethod
    def of(cls, tokenizer_file: str) -> Encoder:
        """One encoder per Python worker, built at first use."""
        if tokenizer_file not in _ENCODERS:
            _ENCODERS[tokenizer_file] = cls(tokenizer_file)
        return _ENCODERS[tokenizer_file]

    def _remember(self, number: dict[bytes, int], ids: np.ndarray, counts: np.ndarray) -> None:
        self._number, self._ids, self._counts = number, ids, counts
        self._hits = np.zeros(len(counts), dtype=np.int64)

    def _forget(self) -> None:
        """Keep the short pieces met more than once since the last time, half of the room at most."""
        known = [(p, i) for p, i in self._number.items() if len(p) <= PIECE_BYTES and self._hits[i] > 1][-REMEMBERED // 2 :]
        kept = np.array([i for _, i in known], dtype=np.int64)
        ids = _gather(self._ids, np.cumsum(self._counts) - self._counts, self._counts, kept)
        number = {p: i for i, (p, _) in enumerate(known)}
        if len(ids) > REMEMBERED_IDS // 2:
            number, kept, ids = {}, kept[:0], ids[:0]
        self._remember(number, ids, self._counts[kept])

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row and how many each has, by few calls of the library.

        Pieces from white space to something else may stand one behind the
        other without meeting in a token, so they are encoded as one string;
        the bytes of the tokens tell where a piece ends.
        """
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        strings, size, open_ended = [], CALL_CHARS, False
        for piece in pieces:
            text = piece.decode()
            joins = piece[:1].isspace() and text[-1] not in WHITE
            if joins and open_ended and size < CALL_CHARS:
                strings[-1].append(text)
                size += len(text)
            else:
                strings.append([text])
                size, open_ended = len(text), joins
        batch = ["".join(x) for x in strings]
        ids = np.concatenate([np.array(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)])
        ends = np.searchsorted(np.cumsum(self._bytes[ids]), np.cumsum(lengths), side="right")
        return ids, np.diff(ends, prepend=0)

    def _lookup(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and how many each piece has."""
        if len(self._number) > REMEMBERED or len(self._ids) > REMEMBERED_IDS:
            self._forget()
        coded = pieces.dictionary_encode()
        distinct, place = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(coded.indices)
        new = sorted((p for p in distinct if p not in self._number), key=lambda p: not p[:1].isspace())
        if new:
            ids, counts = self._encode(new)
            self._number.update(zip(new, range(len(self._counts), len(self._counts) + len(new)), strict=True))
            self._ids = np.concatenate([self._ids, ids])
            self._counts = np.concatenate([self._counts, counts])
            self._hits = np.concatenate([self._hits, np.zeros(len(new), dtype=np.int64)])
        known = np.fromiter(map(self._number.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        self._hits[known] += np.bincount(place, minlength=len(distinct))
        which = known[place]
        return _gather(self._ids, np.cumsum(self._counts) - self._counts, self._counts, which), self._counts[which]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where those of each text begin (one more at the end); the texts are looked up together."""
        data, offsets = as_bytes(texts)
        if not len(data):
            return np.zeros(0, dtype=np.int32), np.zeros(len(offsets), dtype=np.int64)
        cuts = _cuts(data, offsets)
        bounds = np.append(cuts, len(data)).astype(np.int32)
        ids, counts = self._lookup(pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]))
        return ids, np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(cuts, offsets)]

    def encode_block(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        ids, bounds = self.encode_column(pa.array(texts, pa.large_string()))
        return [ids[bounds[i] : bounds[i + 1]] for i in range(len(texts))]

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text, however long."""
        parts = [self.encode_block([p])[0] for p in split_safely(text, 1 << 20)]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts begin: places that are the edge of two matches, whatever stands around them.

    These are ASCII white space behind something else, and a mark behind an
    ASCII letter or digit or a letter from U+00C0 to U+00FF.
    """
    edge = np.zeros(len(data) + 1, dtype=bool)
    space, last = IS_SPACE[data], data[:-1]
    edge[1:-1] = space[1:] & ~space[:-1]
    wide = np.flatnonzero(edge[1:-1] & (last >= 0x80))  # the last byte of a longer character
    code = data[wide].astype(np.int64) | data[wide - 1].astype(np.int64) << 8
    edge[wide + 1] = ~np.isin(code, WHITE_2) & ~np.isin(code | data[wide - 2].astype(np.int64) << 16, WHITE_3)
    mark = np.flatnonzero(IS_MARK[data[1:]])
    before, two = data[mark], data[mark - 1]
    latin = (before >= 0x80) & (two == 0xC3) & (before != 0x97) & (before != 0xB7)
    edge[mark[IS_ALNUM[before] | latin] + 1] = True
    edge[offsets] = True
    return np.flatnonzero(edge[:-1])


def _gather(flat: np.ndarray, first: np.ndarray, counts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``flat[first : first + counts]`` of the numbered pieces, one behind the other."""
    n = counts[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(first[which] - ends + n, n)]


def _encoded(tokenizer_file: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer_file)
        for batch in batches:
            for low, high in text_slices(batch.column("text"), BLOCK_BYTES):
                part = batch.slice(low, high - low)
                if len(part) == 1:
                    flat = encoder.encode(part.column("text")[0].as_py() or "")
                    bounds = np.array([0, len(flat)])
                else:
                    flat, bounds = encoder.encode_column(part.column("text"))
                offsets = (bounds + np.arange(len(bounds))).astype(np.int32)
                closed = np.full(offsets[-1], end_id, dtype=np.int32)
                inside = np.ones(len(closed), dtype=bool)
                inside[offsets[1:] - 1] = False
                closed[inside] = flat
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(closed))
                yield pa.record_batch([part.column("id"), part.column("tie"), lists], names=["id", "tie", "ids"])

    return run


def schema_of(id_type: T.DataType) -> T.StructType:
    """The columns of the files."""
    return T.StructType().add("id", id_type).add("tie", T.LongType()).add("ids", T.ArrayType(T.IntegerType()))


def write(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int = END_ID,
    layout: Layout | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> T.StructType:
    """Encode all texts and write them below ``path``; returns the schema of the files.

    One range shuffle orders the documents over all files.  Ranges are cut
    within equal ids too, so many rows of one id (or of none) do not meet in
    one file; ``tokenizer_file`` must be readable on every executor.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    source = docs.select(F.col(id_column).alias("id"), text.alias("text")).withColumn("tie", F.xxhash64("text"))
    order = [F.col("id").asc_nulls_first(), F.col("tie")]
    ranged = source.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    schema = schema_of(source.schema["id"].dataType)
    ranged.mapInArrow(_encoded(tokenizer_file, end_id), schema).write.options(**(layout or Layout()).options()).orc(path)
    return schema


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``id, tie, ids`` of all files; stripes are read in parallel."""
    return spark.read.schema(schema).orc(path)


def lookup(spark: SparkSession, path: str, schema: T.StructType, ids: list) -> DataFrame:
    """The stored rows of the named documents.

    The condition goes to the ORC reader, which passes over stripes and row
    groups by their smallest and largest id and by the Bloom filters.
    """
    return read(spark, path, schema).where(F.col("id").isin(*ids))


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat = np.asarray(ids.flatten()).astype("<u4", copy=False)
        ends = np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths()))])
        crc = [zlib.crc32(flat[ends[i] : ends[i + 1]]) for i in range(len(ids))]
        yield pa.record_batch(
            [batch.column("id"), batch.column("tie"), batch.column("file"), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
            names=["id", "tie", "file", "n_tokens", "ids_crc32"],
        )


def positions(stored: DataFrame) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every stored document.

    ``start`` is a prefix sum in two phases: running counts within each file,
    and the counts of all earlier files, one row a file.  The checksum is that
    of the ids as little-endian unsigned 32-bit integers.
    """
    kind = stored.schema["id"].dataType.simpleString()
    named = stored.select("id", "tie", "ids", F.col("_metadata.file_path").alias("file"))
    found = named.mapInArrow(_checked, f"id {kind}, tie bigint, file string, n_tokens bigint, ids_crc32 bigint")
    facts = materialize(found, "token-positions")
    first = F.struct(F.col("id").isNotNull().alias("known"), "id", "tie")
    files = facts.groupBy("file").agg(F.min(first).alias("first"), F.sum("n_tokens").alias("n"))
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("file").orderBy(F.col("id").asc_nulls_first(), "tie").rowsBetween(Window.unboundedPreceding, -1)
    running = facts.withColumn("within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return running.join(files, "file").select("id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
