"""MinHash near-duplicate detection that loses no link to large groups of copies.

A document is the set of its distinct word shingles.  Documents with equal sets
form a class.  Each class has minima of many universal hashes; classes that
agree on a band of minima share a bucket.  Within a bucket not all pairs are
compared: one class, its pivot, is compared with the others, links are
confirmed on the full sets, and connected components are taken.  The pivot is
the class that shares most buckets with others, which is what the others were
copied from, if it is there.  Where a bucket still holds several components,
the members outside its largest one are compared with the members of other
components, unless one of these says that there is no link:

* the sizes of the sets, and the counts of their shingles in parts of the hash
  range, whose smaller ones add up to no less than what the sets share;
* the distances to the pivot, since 1 - similarity is a metric;
* the signatures, which agree in so few minima that a pair at the threshold
  does so no more often than it shares no bucket;
* an earlier bucket that the pair shares (it is compared there).

The components are therefore those of all pairs that share a bucket, at a cost
near the number of members.

With bands of 4 minima, 32 of them, a pair of similarity 0.85 shares no bucket
with probability 6e-11, one of 0.8 with 5e-8; the signatures drop it with
probability 3e-11 and 3e-8.

Defined results: null texts and texts without words have the empty set, are
linked with nothing and stay.  A text with fewer words than a shingle has its
whole sequence as its only shingle.  Repeated rows fall in one class; a null id
counts as larger than any other.  An empty table gives an empty table; further
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.textblocks import LOWER, as_bytes, giving_back, gram_hashes, mix, text_slices, word_bounds, word_hashes
from tidemark.session import materialize


@dataclass(frozen=True)
class Setting:
    """Words of a shingle, similarity as a ratio of whole numbers, bands and minima per band."""

    width: int = 5
    similar: int = 80  # percent
    bands: int = 32
    rows: int = 4
    seed: int = 3

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and where each text begins."""
    data, offsets = as_bytes(column)
    starts, ends, first = word_bounds(data, offsets)
    grams, begin = gram_hashes(word_hashes(LOWER[data], starts, ends), first, width)
    out, sizes = [], [0]
    for i in range(len(column)):
        part = np.sort(grams[begin[i] : begin[i + 1]])
        if len(part):
            part = part[np.concatenate([[True], part[1:] != part[:-1]])]
            out.append(part)
        sizes.append(len(part))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.cumsum(sizes)


def minima(grams: np.ndarray, begin: np.ndarray, setting: Setting) -> np.ndarray:
    """The smallest value of each hash ``(a * x + b) mod 2**64`` over each non-empty set, upper 32 bits."""
    rng = np.random.default_rng(setting.seed)
    a = rng.integers(0, 2**63, setting.hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**64, setting.hashes, dtype=np.uint64)
    full = np.flatnonzero(np.diff(begin))
    out = np.zeros((len(begin) - 1, setting.hashes), dtype=np.uint32)
    if len(full):
        at = begin[:-1][full]
        for k in range(setting.hashes):
            out[full, k] = (np.minimum.reduceat(grams * a[k] + b[k], at) >> np.uint64(32)).astype(np.uint32)
    return out


def fingerprints(grams: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: equal for equal sets, and else practically never."""
    one = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams))])
    two = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)))])
    return tuple((x[begin[1:]] - x[begin[:-1]]).view(np.int64) for x in (one, two))


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id, row_key, text``; the key is a hash of id and text, so equal rows share it."""
    text = F.col(text_column).cast("string")
    return docs.select(F.col(id_column).alias("id"), F.xxhash64(F.col(id_column), text).alias("row_key"), text.alias("text"))


def signatures(rows: DataFrame, setting: Setting) -> DataFrame:
    """``id, row_key, n_shingles, f1, f2, signature`` of every row of ``keyed``."""

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(2)):
                part = batch.slice(a, b - a)
                grams, begin = shingle_sets(part.column(2), setting.width)
                f1, f2 = fingerprints(grams, begin)
                minimum = minima(grams, begin, setting)
                yield pa.record_batch(
                    {
                        "id": part.column(0),
                        "row_key": part.column(1),
                        "n_shingles": np.diff(begin),
                        "f1": f1,
                        "f2": f2,
                        "signature": pa.array([m.tobytes() for m in minimum], pa.binary()),
                    }
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(giving_back(run), f"id {kind}, row_key bigint, n_shingles bigint, f1 bigint, f2 bigint, signature binary")


def _classes(signed: DataFrame) -> DataFrame:
    """One row per distinct non-empty set, numbered; written, so that the numbers stay."""
    grouped = (
        signed.where("n_shingles > 0")
        .groupBy("f1", "f2")
        .agg(
            F.min("id").alias("least_id"),
            F.min("row_key").alias("row_key"),
            F.min("n_shingles").alias("n_shingles"),
            F.min("signature").alias("signature"),
        )
    )
    return materialize(grouped.withColumn("node", F.monotonically_increasing_id()), "neardup-classes")


def _buckets(classes: DataFrame, setting: Setting) -> DataFrame:
    """``bucket, band, node`` for buckets with several classes."""
    size = 4 * setting.rows
    band = F.explode(F.sequence(F.lit(0), F.lit(setting.bands - 1)))
    keys = classes.select("node", "signature", band.alias("band")).select(
        F.expr(f"xxhash64(band, substring(signature, band * {size} + 1, {size}))").alias("bucket"), "band", "node"
    )
    shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    return materialize(keys.join(shared, "bucket"), "neardup-buckets")


def _candidate_texts(rows: DataFrame, classes: DataFrame, buckets: DataFrame, setting: Setting) -> DataFrame:
    """``node, signature, text`` of every class that shares a bucket: one text of the class."""
    wanted = classes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "row_key", "f1", "f2", "signature")
    found = rows.select("row_key", "text").join(wanted, "row_key").select("node", "f1", "f2", "signature", "text")

    def same_class(batches):
        for batch in batches:
            for a, b in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                f1, f2 = fingerprints(*shingle_sets(part.column("text"), setting.width))
                right = (f1 == np.asarray(part.column("f1"))) & (f2 == np.asarray(part.column("f2")))
                yield part.select(["node", "signature", "text"]).filter(pa.array(right))

    checked = found.mapInArrow(giving_back(same_class), "node bigint, signature binary, text string")
    one = checked.groupBy("node").agg(F.min("signature").alias("signature"), F.min("text").alias("text"))
    return materialize(one, "neardup-texts")


def _least_agreement(setting: Setting) -> int:
    """Equal minima below which a pair is not looked at: a pair at the threshold has fewer no more often than it shares no bucket."""
    goal, n = setting.similar / 100, setting.hashes
    no_bucket = (1 - goal**setting.rows) ** setting.bands
    fewer, least = 0.0, 0
    while least < n and (fewer := fewer + comb(n, least) * goal**least * (1 - goal) ** (n - least)) <= no_bucket:
        least += 1
    return least


def _measured(pairs: DataFrame, texts: DataFrame, setting: Setting, all_of_them: bool = False) -> DataFrame:
    """``a, b, common, total`` on the full sets: shingles in both, and in either.  Signatures that differ too much save the work, unless all pairs are asked for."""
    least = 0 if all_of_them else _least_agreement(setting)

    def run(batches):
        for batch in batches:
            for lo, hi in text_slices(batch.column("text_b")):
                part = batch.slice(lo, hi - lo)
                if least:
                    sign = [np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint32).reshape(hi - lo, -1) for c in ("sign_a", "sign_b")]
                    part = part.filter(pa.array((sign[0] == sign[1]).sum(axis=1) >= least))
                if not part.num_rows:
                    continue
                left = part.column("text_a").dictionary_encode()  # a centre's text comes with each of its pairs
                sets_a, at_a = shingle_sets(left.dictionary, setting.width)
                which = np.asarray(left.indices)
                sets_b, at_b = shingle_sets(part.column("text_b"), setting.width)
                common, total = np.zeros((2, part.num_rows), dtype=np.int64)
                for i in range(part.num_rows):
                    x, y = sets_a[at_a[which[i]] : at_a[which[i] + 1]], sets_b[at_b[i] : at_b[i + 1]]
                    both = np.sort(np.concatenate([x, y]))
                    common[i] = (both[1:] == both[:-1]).sum()
                    total[i] = len(both) - common[i]
                yield pa.record_batch([part.column("a"), part.column("b"), pa.array(common), pa.array(total)], names=["a", "b", "common", "total"])

    first = pairs.join(texts.select(F.col("node").alias("b"), F.col("signature").alias("sign_b"), F.col("text").alias("text_b")), "b")
    both = first.join(texts.select(F.col("node").alias("a"), F.col("signature").alias("sign_a"), F.col("text").alias("text_a")), "a")
    return both.mapInArrow(giving_back(run), "a bigint, b bigint, common bigint, total bigint")


def _linked(measured: DataFrame, setting: Setting) -> DataFrame:
    """The pairs ``a, b`` that are similar enough."""
    return measured.where(F.col("common") * 100 >= F.col("total") * setting.similar).select("a", "b")


def _ordered(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _pivots(buckets: DataFrame) -> DataFrame:
    """``bucket, pivot``: the member that meets most others, over all its buckets."""
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    met = buckets.join(sizes, "bucket").groupBy("node").agg(F.sum("n").alias("met"))
    order = F.col("met") * 2**20 + F.pmod(F.xxhash64("node"), F.lit(2**20))
    best = buckets.join(met, "node").groupBy("bucket").agg(F.max_by("node", order).alias("pivot"))
    return materialize(best, "neardup-pivots")


def _components(classes: DataFrame, buckets: DataFrame, texts: DataFrame, setting: Setting) -> DataFrame:
    """``node, component`` of the classes that are linked with another one."""
    pivots = _pivots(buckets)
    pairs = buckets.join(pivots, "bucket").where("node <> pivot").select(*_ordered(F.col("pivot"), F.col("node"))).distinct()
    measured = materialize(_measured(pairs, texts, setting, all_of_them=True), "neardup-measured")
    links = _linked(measured, setting).select(F.col("a").alias("u"), F.col("b").alias("v"))
    found = connected_components(links, "neardup-components")
    apart = _apart(buckets, found)
    if apart.isEmpty():
        return found
    pairs = _still_possible(apart, classes, texts, pivots, measured, setting)
    links = materialize(_linked(_measured(pairs, texts, setting), setting), "neardup-links")
    return found if links.isEmpty() else _merged(found, links)


def _apart(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """``bucket, band, node, component`` of the buckets with several components."""
    placed = buckets.select("bucket", "band", "node").join(found, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    several = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return materialize(placed.join(several.select("bucket"), "bucket"), "neardup-apart")


#: Parts that shingles fall into by hash; the smaller counts of each part bound what two sets share.
PARTS = 256


def _part_counts(apart: DataFrame, texts: DataFrame, setting: Setting) -> DataFrame:
    """``node, parts``: how many shingles of the node fall into each part."""

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                grams, begin = shingle_sets(batch.column(1).slice(a, b - a), setting.width)
                row = np.repeat(np.arange(b - a), np.diff(begin))
                counts = np.bincount(row * PARTS + (mix(grams) % np.uint64(PARTS)).astype(np.int64), minlength=(b - a) * PARTS)
                lists = pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * PARTS, pa.array(counts.astype(np.int32)))
                yield pa.record_batch([batch.column(0).slice(a, b - a), lists], names=["node", "parts"])

    told = texts.join(apart.select("node").distinct(), "node", "left_semi").select("node", "text")
    return told.mapInArrow(giving_back(run), "node bigint, parts array<int>")


def _still_possible(
    apart: DataFrame, classes: DataFrame, texts: DataFrame, pivots: DataFrame, measured: DataFrame, setting: Setting
) -> DataFrame:
    """The pairs ``a, b`` of different components in a bucket that nothing known about them rules out, each once."""
    counts = apart.groupBy("bucket", "component").count()
    largest = counts.groupBy("bucket").agg(F.max_by("component", F.struct("count", "component")).alias("largest"))
    rows = apart.join(pivots, "bucket").join(largest, "bucket")
    far = measured.select("a", "b", (1 - F.col("common") / F.col("total")).alias("far"))
    rows = rows.select("*", *_ordered(F.col("pivot"), F.col("node"))).join(far, ["a", "b"], "left").drop("a", "b")
    rows = rows.withColumn("far", F.when(F.col("node") == F.col("pivot"), F.lit(0.0)).otherwise(F.col("far")))
    # The wide columns come last, so that they are moved once.
    sets = classes.select("node", "n_shingles", "signature").join(_part_counts(apart, texts, setting), "node")
    rows = materialize(rows.join(sets, "node"), "neardup-rows")
    size, n = 4 * setting.rows, setting.hashes
    least = _least_agreement(setting)
    bands = ", ".join(str(k) for k in range(setting.bands))
    possible = F.expr(
        f"""x.component <> y.component AND (y.component = y.largest OR x.node < y.node)
        AND 100 * least(x.n_shingles, y.n_shingles) >= {setting.similar} * greatest(x.n_shingles, y.n_shingles)
        AND coalesce(abs(x.far - y.far) <= {1 - setting.similar / 100 + 1e-9}, true)
        AND NOT exists(array({bands}), k -> k < x.band AND
            substring(x.signature, k * {size} + 1, {size}) = substring(y.signature, k * {size} + 1, {size}))
        AND size(filter(sequence(0, {n - 1}), k -> substring(x.signature, k * 4 + 1, 4) = substring(y.signature, k * 4 + 1, 4))) >= {least}
        AND aggregate(zip_with(x.parts, y.parts, (p, q) -> least(p, q)), 0, (n, p) -> n + p) * {100 + setting.similar}
            >= {setting.similar} * (x.n_shingles + y.n_shingles)"""
    )
    odd = rows.where("component <> largest").alias("x")
    met = odd.join(rows.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & possible)
    return met.select(*_ordered(F.col("x.node"), F.col("y.node")))


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links, by components of the components."""
    nodes = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node"))).distinct()
    known = found.unionAll(nodes.join(found, "node", "left_anti").select("node", F.col("node").alias("component")))
    known = materialize(known, "neardup-known")
    of = lambda c: known.select(F.col("node").alias(c), F.col("component").alias({"a": "u", "b": "v"}[c]))
    joined = connected_components(links.join(of("a"), "a").join(of("b"), "b").select("u", "v"), "neardup-components")
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("to"))
    return materialize(
        known.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "neardup-merged"
    )


def near_duplicates(docs: DataFrame, setting: Setting | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, row_key, n_shingles, group, component_id, kept`` for every row.

    ``group`` numbers the components (null for empty sets); ``component_id`` is
    the smallest id of the component, ``kept`` whether the row's id is that one.
    """
    setting = setting or Setting()
    rows = keyed(docs, id_column, text_column)
    signed = materialize(signatures(rows, setting), "neardup-signatures")
    classes = _classes(signed)
    buckets = _buckets(classes, setting)
    texts = _candidate_texts(rows, classes, buckets, setting)
    found = _components(classes, buckets, texts, setting)
    placed = classes.select("f1", "f2", "least_id", "node").join(found, "node", "left")
    placed = placed.withColumn("group", F.coalesce("component", "node"))
    least = placed.groupBy("group").agg(F.min("least_id").alias("component_id"))
    by_class = placed.join(least, "group").select("f1", "f2", "group", "component_id")
    out = signed.select("id", "row_key", "n_shingles", "f1", "f2").join(by_class, ["f1", "f2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        "id",
        "row_key",
        "n_shingles",
        "group",
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )


def one_of_each(docs: DataFrame, setting: Setting | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each component, one of each (id, text) without words; columns unchanged."""
    marked = near_duplicates(docs, setting, id_column, text_column)
    grouped = marked.where("group is not null and kept").groupBy("group").agg(F.min("row_key").alias("row_key")).select("row_key")
    stay = grouped.unionAll(marked.where("group is null").select("row_key").distinct())
    names = [f"d{i}" for i in range(len(docs.columns))]
    of = dict(zip(docs.columns, names, strict=True))
    plain = docs.toDF(*names)
    key = F.xxhash64(F.col(of[id_column]), F.col(of[text_column]).cast("string"))
    kept = plain.withColumn("row_key", key).join(stay, "row_key")
    first = kept.groupBy("row_key").agg(F.first(F.struct(*names)).alias("row"))
    return first.select(*[F.col(f"row.{n}").alias(c) for n, c in zip(names, docs.columns, strict=True)])
