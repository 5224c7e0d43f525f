"""Removal of every byte covered by a long string that also starts anywhere else.

Two equal strings of ``length`` bytes agree on which of their short k-grams has
the smallest hash.  So each window of ``length`` bytes is filed under that
k-gram, its anchor; neighbouring windows with one anchor make a piece of text.
Pieces under an anchor that occurs once hold no repeat, and equal pieces are
repeats throughout; neither needs its text.  What is left are different pieces
with equal anchors, mostly the edges of repeated passages: their suffixes are
sorted in buckets (``suffixsort``) and neighbours in the order tell which of
their windows occur again.

No group is handled whole: equal pieces are counted by partial aggregation, and
an anchor with more different pieces than ``GROUP`` takes another exact way,
where each of its windows is counted by two hashes.

``keep_first`` leaves the first occurrence of every repeated string, the one of
the smallest row key and place: equal pieces but the first, and windows that
occur in a piece before theirs.  Bytes shared by a first occurrence and another
string's later one go with the later one; they stay where that one came first.

Repeats can be asked for in words as well: each word is written as a code of
``CODE`` bytes, and repeats of so many codes are looked for in the same way.

Defined results: a null text counts as empty; texts shorter than ``length``
stay whole; repeated rows are repeats of each other; an empty table gives an
empty table; further columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.neardup import keyed
from tidemark.llm.suffixsort import Pieces, repeated_windows
from tidemark.llm.textblocks import (
    BASE,
    BLOCK_BYTES,
    BYTE_VALUE,
    IS_SPACE,
    as_bytes,
    giving_back,
    mix,
    powers,
    text_slices,
    word_bounds,
    word_hashes,
)
from tidemark.session import materialize

#: Different pieces of one anchor that are sorted together at most; about 10 MB of text and 80 MB of hashes.
GROUP = 20_000
#: Bytes of pieces in a bucket, on average.
BUCKET_BYTES = 2 << 20
#: Low bits of a key that hold a place in the block; a block has fewer bytes.
PLACE_BITS = 22
#: Bytes of the code of a word, its hash.
CODE = 8

_POWERS: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, made once per worker."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = np.full(n, np.uint64(pow(int(BASE), -1, 2**64)), dtype=np.uint64)
        inverse[0] = 1
        _POWERS[:] = [powers(n), np.multiply.accumulate(inverse)]
    return _POWERS[0], _POWERS[1]


def kgram(length: int) -> int:
    """Bytes of an anchor."""
    return max(4, length // 8)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring values: running minima from both sides of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def inner_words(data: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Words of each window of ``length`` bytes that have a blank on both sides in it: told by the bytes of the window alone."""
    starts = np.zeros(len(data) + 1, dtype=np.int64)
    starts[word_bounds(data, offsets)[0] + 1] = 1
    before = np.cumsum(starts)
    begun = before[length:] - before[1 : len(data) - length + 2]
    return np.maximum(begun - ~IS_SPACE[data[length - 1 :]], 0)


def anchored(data: np.ndarray, offsets: np.ndarray, length: int, under_words: int | None = None) -> tuple[np.ndarray, ...]:
    """Pieces of the texts of a block: text number, first and last window, anchor (places in the block), hash of the anchor.

    With ``under_words``, of the windows with fewer inner words only.
    """
    k = kgram(length)
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + (np.zeros(0, dtype=np.uint64),)
    power, inverse = _power_tables(n + 1)
    prefix = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_VALUE[data] * power[:n])])
    grams = mix((prefix[k:] - prefix[:-k]) * inverse[: n - k + 1])
    place = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_least((grams & ~low) | place, length - k + 1)
    anchor = (least & low).astype(np.int64)
    text = np.searchsorted(offsets, np.arange(len(anchor)), side="right") - 1
    inside = np.arange(len(anchor)) + length <= offsets[text + 1]
    if under_words is not None:
        inside &= inner_words(data, offsets, length) < under_words
    window = np.flatnonzero(inside)
    if not len(window):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + (np.zeros(0, dtype=np.uint64),)
    new = np.ones(len(window), dtype=bool)
    new[1:] = (anchor[window[1:]] != anchor[window[:-1]]) | (text[window[1:]] != text[window[:-1]]) | (np.diff(window) > 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    at = anchor[window[first]]
    return text[window[first]], window[first], window[last], at, grams[at]


def _blocks(column: pa.Array, length: int):
    """Bytes, offsets, and for each text its row and the place where it begins in the row's bytes.

    A text longer than a block comes in parts that overlap by ``length - 1``
    bytes, so that each window lies in exactly one of them.
    """
    for a, b in text_slices(column):
        data, offsets = as_bytes(column.slice(a, b - a))
        if b - a > 1 or len(data) <= 2 * BLOCK_BYTES:
            yield data, offsets, np.arange(a, b), np.zeros(b - a, dtype=np.int64)
            continue
        for at in range(0, len(data) - length + 1, BLOCK_BYTES):
            part = data[at : at + BLOCK_BYTES + length - 1]
            yield part, np.array([0, len(part)]), np.array([a]), np.array([at])


def _pieces(rows: DataFrame, length: int, under_words: int | None = None, keep_first: bool = False) -> DataFrame:
    """``anchor, content, weight, row_key, low, at, high``: one row per piece; or, with a null anchor, a stretch of sure repeats.

    A piece that comes several times in a block is a repeat: its first place is
    kept as a piece of weight 2, and all its places (with ``keep_first`` all but
    that one) as stretches, joined where they touch.
    """

    def run(batches):
        for batch in batches:
            keys = np.asarray(batch.column(0))
            for data, offsets, row, begin in _blocks(batch.column(1), length):
                text, low, high, at, gram = anchored(data, offsets, length, under_words)
                if not len(text):
                    continue
                raw = data.tobytes()
                content = np.fromiter(
                    (xxhash.xxh3_64_intdigest(raw[a : b + length], s) for a, b, s in zip(low.tolist(), high.tolist(), (at - low).tolist(), strict=True)),
                    dtype=np.uint64,
                    count=len(low),
                )
                shift = begin[text] - offsets[text]
                key = keys[row[text]]
                if keep_first:  # so that the first place of a piece is that of the smallest key
                    by_key = np.lexsort((low + shift, key))
                    text, low, high, at, gram, content, shift, key = (x[by_key] for x in (text, low, high, at, gram, content, shift, key))
                both = np.stack([gram, content], axis=1)
                _, first, back, count = np.unique(both, axis=0, return_index=True, return_inverse=True, return_counts=True)
                again = count[back.ravel()] > 1
                if keep_first:
                    mine = first[back.ravel()]
                    again &= (key != key[mine]) | (low + shift != (low + shift)[mine])
                out = [pa.array(gram.view(np.int64)[first]), pa.array(content.view(np.int64)[first]), pa.array(np.minimum(count, 2).astype(np.int32))]
                out += [pa.array(key[first])] + [pa.array((x + shift)[first]) for x in (low, at, high)]
                yield pa.record_batch(out, names=NAMES)
                if again.any():
                    i = np.flatnonzero(again)
                    a, z, t = low[i], high[i], text[i]
                    new = np.ones(len(i), dtype=bool)
                    new[1:] = (t[1:] != t[:-1]) | (a[1:] > z[:-1] + length)
                    s = np.flatnonzero(new)
                    e = np.append(s[1:], len(i)) - 1
                    none = pa.nulls(len(s), pa.int64())
                    move = shift[i][s]
                    yield pa.record_batch(
                        [none, none, pa.nulls(len(s), pa.int32()), pa.array(key[i][s]), pa.array(a[s] + move), none, pa.array(z[e] + move)],
                        names=NAMES,
                    )

    schema = "anchor bigint, content bigint, weight int, row_key bigint, low bigint, at bigint, high bigint"
    return rows.select("row_key", "text").mapInArrow(giving_back(run), schema)


NAMES = ["anchor", "content", "weight", "row_key", "low", "at", "high"]
FIELDS = ["in_words", "anchor", "content", "weight", "low", "at", "high", "in_group"]


def _texts_of(pieces: DataFrame, rows: DataFrame, lengths: dict[bool, int]) -> DataFrame:
    """``pieces`` with their bytes, fetched in one pass from the texts they lie in or, ``in_words``, from the codes of their words."""
    listed = pieces.groupBy("row_key").agg(F.collect_list(F.struct(*FIELDS)).alias("pieces"))
    # Rows with the same key have the same text; one of each is enough.
    texts = rows.groupBy("row_key").agg(F.first("text").alias("text"))

    def cut(batches):
        for batch in batches:
            for a, b in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                flat = part.column("pieces").flatten()
                parents = pc.list_parent_indices(part.column("pieces"))
                in_words = flat.field("in_words").to_pylist()
                wanted = {w: sorted({i for i, x in zip(parents.to_pylist(), in_words, strict=True) if x == w}) for w in (False, True)}
                column = {w: part.column("text").take(pa.array(wanted[w], pa.int64())) for w in wanted}
                found = {False: column[False].cast(pa.binary()), True: codes_of(column[True]) if wanted[True] else column[True]}
                raw = {w: dict(zip(wanted[w], found[w].to_pylist(), strict=True)) for w in wanted}
                low, high = flat.field("low").to_pylist(), flat.field("high").to_pylist()
                body = [raw[w][i][s : e + lengths[w]] for w, i, s, e in zip(in_words, parents.to_pylist(), low, high, strict=True)]
                fields = [flat.field(n) for n in FIELDS]
                yield pa.record_batch(
                    [*fields, part.column("row_key").take(parents), pa.array(body, pa.binary())],
                    names=[*FIELDS, "row_key", "body"],
                )

    return texts.join(listed, "row_key").select("row_key", "text", "pieces").mapInArrow(
        giving_back(cut),
        "in_words boolean, anchor bigint, content bigint, weight int, low bigint, at bigint, high bigint, in_group bigint, row_key bigint, body binary",
    )


def _sorted_repeats(pieces: DataFrame, buckets: dict[bool, int], lengths: dict[bool, int], keep_first: bool = False) -> DataFrame:
    """``row_key, start, end, in_words``: repeated stretches of single pieces, by sorting suffixes bucket by bucket."""

    def of_bucket(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        in_words = key[0].as_py()
        length = lengths[in_words]
        t = table.combine_chunks().sort_by([("anchor", "ascending"), ("content", "ascending")])
        col = {n: np.asarray(t.column(n)) for n in ("anchor", "content", "weight", "row_key", "low", "at", "high")}
        body = t.column("body").to_pylist()
        _, group = np.unique(col["anchor"], return_inverse=True)
        sorted_pieces = Pieces(body, col["at"] - col["low"], group)
        if keep_first:
            rank = np.empty(len(body), dtype=np.int64)
            rank[np.lexsort((col["low"], col["row_key"]))] = np.arange(len(body))
            found = repeated_windows(sorted_pieces, length, np.ones(len(body), dtype=bool), rank)
        else:
            found = repeated_windows(sorted_pieces, length, col["weight"] == 1)
        i = np.array([f[0] for f in found], dtype=np.int64)
        near, far = (np.array([f[k] for f in found], dtype=np.int64) for k in (1, 2))
        at = col["at"][i]
        told = pa.array(np.full(len(i), in_words, dtype=bool))
        return pa.table({"row_key": col["row_key"][i], "start": at - far, "end": at - near + length, "in_words": told})

    several = F.when(F.col("in_words"), F.lit(buckets.get(True, 1))).otherwise(F.lit(buckets.get(False, 1)))
    bucket = F.pmod(F.xxhash64("anchor"), several).cast("int")
    schema = "row_key bigint, start bigint, end bigint, in_words boolean"
    return pieces.groupBy("in_words", bucket.alias("bucket")).applyInArrow(of_bucket, schema)


def _counted_repeats(pieces: DataFrame, length: int, keep_first: bool = False) -> DataFrame:
    """The same for anchors with very many different pieces: every window is counted by two hashes of its bytes."""

    def windows(batches):
        for batch in batches:
            for row in batch.to_pylist():
                body, n = row["body"], len(row["body"]) - length + 1
                pairs = [xxhash.xxh3_128_intdigest(body[i : i + length]) for i in range(n)]
                yield pa.record_batch(
                    {
                        "one": pa.array([(p >> 64) - (1 << 63) for p in pairs], pa.int64()),
                        "two": pa.array([(p & (2**64 - 1)) - (1 << 63) for p in pairs], pa.int64()),
                        "weight": pa.array([row["weight"]] * n, pa.int32()),
                        "row_key": pa.array([row["row_key"]] * n, pa.int64()),
                        "start": pa.array(range(row["low"], row["low"] + n), pa.int64()),
                    }
                )

    every = pieces.mapInArrow(windows, "one bigint, two bigint, weight int, row_key bigint, start bigint")
    place = F.struct("row_key", "start")
    again = every.groupBy("one", "two").agg(F.sum("weight").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    hit = every.where(F.lit(True) if keep_first else F.col("weight") == 1).join(again, ["one", "two"])
    if keep_first:
        hit = hit.where(place != F.col("first"))
    return hit.select("row_key", "start", (F.col("start") + length).alias("end"))


def _told_apart(rows: DataFrame, length: int, under_words: int | None, keep_first: bool) -> tuple[DataFrame, DataFrame]:
    """``row_key, start, end`` of the repeats that need no text, and the pieces that do, with the number of those of their anchor."""
    pieces = materialize(_pieces(rows, length, under_words, keep_first), "suffix-pieces")
    sure = pieces.where("anchor is null").select("row_key", F.col("low").alias("start"), (F.col("high") + length).alias("end"))
    single = pieces.where("anchor is not null")
    shared = single.groupBy("anchor").agg(F.sum("weight").alias("n")).where("n > 1").select("anchor")
    shared = materialize(single.join(shared, "anchor"), "suffix-shared")
    distinct = shared.groupBy("anchor", "content").agg(
        F.sum("weight").alias("n"),
        F.min("row_key").alias("row_key"),
        *[F.min_by(c, F.struct("row_key", "low")).alias(c) for c in ("low", "at", "high")],
    )
    distinct = materialize(
        distinct.withColumn("weight", F.least("n", F.lit(2)).cast("int")).drop("n"), "suffix-distinct"
    )
    twice = distinct.where("weight = 2").select("anchor", "content", F.struct("row_key", "low").alias("first"))
    equal = shared.join(twice, ["anchor", "content"])
    if keep_first:
        equal = equal.where(F.struct("row_key", "low") != F.col("first"))
    equal = equal.select("row_key", F.col("low").alias("start"), (F.col("high") + length).alias("end"))
    groups = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("weight").alias("least"))
    groups = groups.where("n > 1" if keep_first else "n > 1 and least = 1")
    mixed = distinct.join(groups.select("anchor", F.col("n").alias("in_group")), "anchor")
    return sure.unionAll(equal), mixed


def _stretches(rows: DataFrame, lengths: dict[bool, int], under_words: int | None = None, keep_first: bool = False) -> DataFrame:
    """``row_key, start, end, in_words``: repeats of bytes (``lengths[False]``) and of codes of words (``lengths[True]``), in words.

    The texts are shuffled once for both.
    """
    told, mixed = [], []
    for in_words, length in lengths.items():
        source = word_codes(rows) if in_words else rows
        sure, pieces = _told_apart(source, length, None if in_words else under_words, keep_first)
        told.append(sure.withColumn("in_words", F.lit(in_words)))
        mixed.append(pieces.withColumn("in_words", F.lit(in_words)))
    mixed = materialize(reduce(DataFrame.unionByName, mixed), "suffix-mixed")
    span = F.sum(F.col("high") - F.col("low")).alias("span")
    sizes = mixed.groupBy("in_words").agg(span, F.count(F.lit(1)).alias("n"), F.max("in_group").alias("largest")).collect()
    if sizes:
        bodies = _texts_of(mixed, rows, lengths)
        large = [r["in_words"] for r in sizes if r["largest"] > GROUP]
        if large:  # read several times
            bodies = materialize(bodies, "suffix-bodies")
        few = bodies.where(F.col("in_group") <= GROUP).drop("in_group")
        buckets = {r["in_words"]: math.ceil((r["span"] + r["n"] * lengths[r["in_words"]]) / BUCKET_BYTES) for r in sizes}
        told.append(_sorted_repeats(few, buckets, lengths, keep_first))
        for in_words in large:
            many = bodies.where((F.col("in_group") > GROUP) & (F.col("in_words") == in_words))
            told.append(_counted_repeats(many, lengths[in_words], keep_first).withColumn("in_words", F.lit(in_words)))
    out = reduce(DataFrame.unionByName, told)
    if True in lengths:  # A hash may end like another one: only whole codes count.
        start, end = (F.when(F.col("in_words"), f(F.col(c) / CODE)).otherwise(F.col(c)) for f, c in ((F.ceil, "start"), (F.floor, "end")))
        out = out.select("row_key", start.alias("start"), end.alias("end"), "in_words")
        out = out.where(~F.col("in_words") | (F.col("end") - F.col("start") >= lengths[True] // CODE))
    return materialize(out.distinct(), "suffix-stretches")


def repeated_stretches(rows: DataFrame, length: int, under_words: int | None = None, keep_first: bool = False) -> DataFrame:
    """``row_key, start, end`` of byte stretches of ``rows`` (row_key, text) to remove; they may overlap."""
    return _stretches(rows, {False: length}, under_words, keep_first).drop("in_words")


def codes_of(column: pa.Array) -> pa.Array:
    """The words of each text as codes of ``CODE`` bytes, one after the other."""
    data, offsets = as_bytes(column)
    starts, ends, first = word_bounds(data, offsets)
    codes = word_hashes(data, starts, ends)
    return pa.array([codes[x:y].tobytes() for x, y in zip(first[:-1], first[1:], strict=True)], pa.binary())


def word_codes(rows: DataFrame) -> DataFrame:
    """``row_key, text``: the texts as ``codes_of`` their words."""

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                out = codes_of(batch.column(1).slice(a, b - a))
                yield pa.record_batch([batch.column(0).slice(a, b - a), out], names=["row_key", "text"])

    return rows.select("row_key", "text").mapInArrow(giving_back(run), "row_key bigint, text binary")


def repeated_words(rows: DataFrame, words: int, keep_first: bool = False) -> DataFrame:
    """``row_key, start, end``, in words: stretches of ``words`` words or more that occur again, whatever the blanks between them."""
    return _stretches(rows, {True: CODE * words}, keep_first=keep_first).drop("in_words")


def remove_repeats(
    docs: DataFrame, length: int = 400, id_column: str = "doc_id", text_column: str = "text", words: int | None = None
) -> DataFrame:
    """``id, row_key, n_bytes, n_removed, spans, kept`` of every row: the removed runs and the remaining bytes, put together.

    With ``words`` also ``n_repeated_words``: how many of its words lie in
    stretches of so many words that occur again; nothing is removed for them.
    """
    rows = keyed(docs, id_column, text_column)
    stretches = _stretches(rows, {False: length} if words is None else {False: length, True: CODE * words})
    done = _removed(rows, stretches.where("not in_words"))
    if words is None:
        return done
    again = stretches.where("in_words").groupBy("row_key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))
    # Stretches may overlap: each counts from where the ones before it end.
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("at"))

    def add(a, x):
        return F.struct(
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["at"]))).cast("bigint").alias("n"),
            F.greatest(a["at"], x["end"]).cast("bigint").alias("at"),
        )

    counted = again.select("row_key", F.aggregate("runs", start, add, lambda a: a["n"]).alias("n_repeated_words"))
    found = done.join(counted, "row_key", "left")
    return found.select(*done.columns, F.coalesce("n_repeated_words", F.lit(0)).cast("bigint").alias("n_repeated_words"))


def _removed(rows: DataFrame, stretches: DataFrame) -> DataFrame:
    listed = stretches.groupBy("row_key").agg(F.collect_list(F.struct("start", "end")).alias("cuts"))

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                bodies, spans, removed, sizes = [], [], [], []
                for text, cuts in zip(part.column("text").to_pylist(), part.column("cuts"), strict=True):
                    raw = (text or "").encode()
                    runs = joined_runs(cuts.values if cuts.is_valid else None)
                    at, keep = 0, []
                    for s, e in runs:
                        keep.append(raw[at:s])
                        at = e
                    keep.append(raw[at:])
                    bodies.append(b"".join(keep))
                    spans.append([{"start": s, "end": e} for s, e in runs])
                    removed.append(len(raw) - len(bodies[-1]))
                    sizes.append(len(raw))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.record_batch(
                    [part.column("id"), part.column("row_key"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(bodies, pa.binary())],
                    names=["id", "row_key", "n_bytes", "n_removed", "spans", "kept"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.join(listed, "row_key", "left").select("id", "row_key", "text", "cuts").mapInArrow(
        giving_back(run),
        f"id {kind}, row_key bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary",
    )


def joined_runs(cuts: pa.StructArray | None) -> list[tuple[int, int]]:
    """Stretches that touch or overlap made one, in order."""
    if cuts is None or not len(cuts):
        return []
    start, end = np.asarray(cuts.field("start")), np.asarray(cuts.field("end"))
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    last = np.append(first[1:], len(start)) - 1
    return list(zip(start[first].tolist(), end[last].tolist(), strict=True))


def byte_cuts(cuts: pa.StructArray, raw: bytes) -> pa.StructArray:
    """``cuts`` (start, end, in_words), those in words turned into bytes of the text."""
    start, end = np.array(cuts.field("start")), np.array(cuts.field("end"))
    told = np.asarray(cuts.field("in_words").cast(pa.int8())) > 0
    if told.any():
        first, last, _ = word_bounds(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        start[told], end[told] = first[start[told]], last[end[told] - 1]
    return pa.StructArray.from_arrays([pa.array(start), pa.array(end)], names=["start", "end"])


def without_repeats(
    docs: DataFrame,
    length: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    size_column: str = "n_chars",
    words: int | None = None,
    keep_first: bool = False,
) -> DataFrame:
    """``docs`` with the repeats cut out of the texts, without rows of which nothing is left; columns unchanged.

    Repeats are those of ``length`` bytes and, if given, those of ``words``
    words, which are cut out from the first to the last whole word; windows of
    bytes that hold so many words are left to them.  With ``keep_first`` the
    first occurrence of each stays.  Of a character that was
    cut in two nothing stays.  ``size_column``, if there, becomes the number of
    characters of a text that was cut.
    """
    rows = keyed(docs, id_column, text_column)
    stretches = _stretches(rows, {False: length} if words is None else {False: length, True: CODE * words}, words, keep_first)
    listed = stretches.groupBy("row_key").agg(F.collect_list(F.struct("start", "end", "in_words")).alias("cuts"))
    names = [f"d{i}" for i in range(len(docs.columns))]
    of = dict(zip(docs.columns, names, strict=True))
    plain = docs.toDF(*names)
    key = F.xxhash64(F.col(of[id_column]), F.col(of[text_column]).cast("string"))
    joined = plain.withColumn("row_key", key).join(listed, "row_key", "left").select(*names, "cuts")
    place = docs.columns.index(text_column)

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(place).cast(pa.string())):
                part = batch.slice(a, b - a)
                texts = []
                for text, cuts in zip(part.column(place).to_pylist(), part.column("cuts"), strict=True):
                    raw = text.encode() if cuts.is_valid else b""
                    runs = joined_runs(byte_cuts(cuts.values, raw) if cuts.is_valid else None)
                    if runs:
                        at, keep = 0, []
                        for s, e in runs:
                            keep.append(raw[at:s].decode(errors="ignore"))
                            at = e
                        text = "".join([*keep, raw[at:].decode(errors="ignore")])
                        text = text if text.strip() else None  # nothing is left
                        texts.append((text, text is not None))
                    else:
                        texts.append((text, True))
                columns = part.columns[: len(names)]
                columns[place] = pa.array([t for t, _ in texts], part.schema.field(place).type)
                yield pa.record_batch(columns, names=names).filter(pa.array([stays for _, stays in texts]))

    cut = joined.mapInArrow(giving_back(run), plain.schema)
    if size_column in of:
        n, t = F.col(of[size_column]), F.col(of[text_column])
        kind = docs.schema[size_column].dataType
        cut = cut.withColumn(of[size_column], F.when(t.isNotNull(), F.char_length(t).cast(kind)).otherwise(n))
    return cut.toDF(*docs.columns)
