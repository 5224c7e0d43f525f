"""Toxicity by non-negative positive-unlabelled learning.

A linear model over hashed words is trained with numpy from confirmed toxic
texts and unlabelled ones.  With the class prior p, the risk of calling an
unlabelled text toxic is corrected by what toxic texts contribute to it:

    risk = p * loss(toxic as 1) + max(0, mean loss(unlabelled as 0) - p * loss(toxic as 0))

Where the second part of a mini-batch falls below zero, its gradient is turned
round, so that the model cannot gain by memorising the unlabelled texts.

Features come from the text alone.  The training samples are bounded by the
parameters of ``train``; they are the rows with the smallest text hashes, so a
rerun takes the same ones.  Everything else runs over all rows.

Defined results: null and empty texts have no features and get the score of the
intercept; repeated rows get equal scores; without a confirmed toxic text, or
without any text, ``train`` gives a model that scores everything with 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textblocks import LOWER, as_bytes, giving_back, text_slices, word_bounds, word_hashes

#: Characters cut from both ends of a word, so that punctuation does not split a word's evidence.
EDGE_PUNCTUATION = np.frombuffer(b".,;:!?\"'()[]*#$%&-", dtype=np.uint8)

#: Samples that the model is fitted on (rows at most), see ``train``.
MAX_POSITIVE = 3000
MAX_UNLABELLED = 9000


@dataclass(frozen=True)
class Model:
    """Weights over 2**bits hashed words, an intercept, and the calibration of the decision value."""

    bits: int
    weights: np.ndarray
    intercept: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """Score of each text, between 0 and 1."""
        index, value, first = features(column, self.bits)
        parts = np.append(self.weights[index] * value, 0.0)  # a text's own words are added up, whatever stands next to it
        sums = np.where(first[1:] > first[:-1], np.add.reduceat(parts, first[:-1]), 0.0)
        z = sums + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words of each text, once each, with 1 + log(count), and where each text begins."""
    data, offsets = as_bytes(column)
    starts, ends, first = word_bounds(data, offsets)
    low = LOWER[data]
    if len(starts):
        edge = np.isin(low, EDGE_PUNCTUATION)
        for _ in range(3):  # at most three marks on either side
            starts = starts + ((ends - starts > 1) & edge[starts])
            ends = ends - ((ends - starts > 1) & edge[ends - 1])
    slot = (word_hashes(low, starts, ends) >> np.uint64(64 - bits)).astype(np.int64)
    text = np.repeat(np.arange(len(column), dtype=np.int64), np.diff(first))
    keys, counts = np.unique((text << bits) | slot, return_counts=True)
    begin = np.searchsorted(keys >> bits, np.arange(len(column) + 1))
    return keys & ((1 << bits) - 1), 1 + np.log(counts), begin


def _sample_features(texts: DataFrame, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of a bounded number of texts, on the driver."""

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                index, value, first = features(batch.column(0).slice(a, b - a), bits)
                cut = lambda x: pa.array([x[first[i] : first[i + 1]].tobytes() for i in range(b - a)], pa.binary())  # noqa: B023, E731
                yield pa.record_batch({"index": cut(index.astype(np.int32)), "value": cut(value.astype(np.float32))})

    rows = texts.select("text").mapInArrow(giving_back(run), "index binary, value binary").collect()
    pairs = [(np.frombuffer(r["index"], np.int32), np.frombuffer(r["value"], np.float32)) for r in rows]
    return sorted(pairs, key=lambda p: (p[0].tobytes(), p[1].tobytes()))  # the order of a collect is not fixed


def _smallest(texts: DataFrame, n: int) -> DataFrame:
    """At most ``n`` different texts (column: text), those with the smallest hashes.

    A cut on the hash is made first, so no more than about ``n`` rows are ever
    sorted or moved.
    """
    total = texts.count()
    share = min(1.0, n / max(1, total))
    cut = min(2**63 - 1, -(2**63) + int(share * 2**64))
    hashed = texts.select(F.xxhash64("text").alias("h"), "text").where(F.col("h") <= cut)
    return hashed.groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(n).select("text")


def confirmed(
    docs: DataFrame, labels: DataFrame, n: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Texts of at most ``n`` ids of ``labels`` (columns: id, toxic) that are marked toxic, chosen by a hash of the id."""
    ids = labels.where("toxic = 1 and id is not null").select("id").distinct()
    few = ids.orderBy(F.xxhash64("id"), "id").limit(n)
    found = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return found.join(F.broadcast(few), "id").select("text")  # n ids at most


def class_prior(labels: DataFrame) -> float:
    """Share of toxic rows among the labelled ones (column: toxic)."""
    return float(labels.where("toxic in (0, 1)").agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0])


def train(
    positive: DataFrame,
    unlabelled: DataFrame,
    prior: float,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
    bits: int = 18,
    min_texts: int = 8,
    steps: int = 204,
    seed: int = 7,
) -> Model:
    """Fit on at most ``max_positive`` confirmed texts and ``max_unlabelled`` others (columns: text)."""
    p_rows = _sample_features(_smallest(positive, max_positive), bits)
    u_rows = _sample_features(_smallest(unlabelled, max_unlabelled), bits)
    if not p_rows or not u_rows or prior <= 0:
        return Model(bits, np.zeros(1 << bits), -40.0)
    return fit(p_rows, u_rows, prior, bits, min_texts, steps, seed)


def told(p_rows, u_rows, bits, min_texts, seen):
    """Words of enough texts whose share among toxic and unlabelled texts differs by more than chance would make it.

    Rare words of a few long texts would be learned by heart otherwise.  The
    difference is measured in standard errors of two shares.
    """
    toxic = np.zeros(1 << bits, dtype=np.int64)
    for index, _ in p_rows:
        toxic[index] += 1
    n, k = len(p_rows), len(u_rows)
    pooled = seen / (n + k)
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n + 1 / k))
    return (seen >= min_texts) & (np.abs(toxic / n - (seen - toxic) / k) > 4.5 * error)


def _flat(rows, keep):
    index = np.concatenate([i for i, _ in rows]) if rows else np.zeros(0, np.int32)
    value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0, np.float32)
    text = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    known = keep[index] >= 0
    return keep[index[known]], value[known].astype(np.float64), text[known]


def fit(p_rows, u_rows, prior, bits, min_texts=8, steps=204, seed=7, rate=0.01, decay=1e-3) -> Model:
    """Mini-batch descent (Adam) on the non-negative risk with the logistic loss, at least ``steps`` batches."""
    seen = np.zeros(1 << bits, dtype=np.int64)
    for index, _ in p_rows + u_rows:
        seen[index] += 1
    words = np.flatnonzero(told(p_rows, u_rows, bits, min_texts, seen))
    keep = np.full(1 << bits, -1, dtype=np.int64)
    keep[words] = np.arange(len(words))
    d = len(words)
    groups = [(len(r), *_flat(r, keep)) for r in (p_rows, u_rows)]
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(d), float(np.log(prior / (1 - prior)))
    m, v, step = np.zeros(d + 1), np.zeros(d + 1), 0
    batches = max(1, len(u_rows) // 512)
    for _ in range(-(-steps // batches)):
        parts = [rng.integers(0, batches, n) for n, *_ in groups]
        for k in range(batches):
            values, picks = [], []
            for (n, index, value, text), part in zip(groups, parts, strict=True):
                rows = np.flatnonzero(part == k)
                local = np.full(n, -1)
                local[rows] = np.arange(len(rows))
                mine = local[text] >= 0
                i, x, t = index[mine], value[mine], local[text[mine]]
                values.append(bias + np.bincount(t, w[i] * x, len(rows)))
                picks.append((i, x, t))
            if not len(values[0]) or not len(values[1]):
                continue
            zp, zu = values
            up = 1 / (1 + np.exp(-np.clip(zp, -40, 40)))
            uu = 1 / (1 + np.exp(-np.clip(zu, -40, 40)))
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if negative >= 0:
                gp = (prior * (up - 1) - prior * up) / len(zp)
                gu = uu / len(zu)
            else:  # turn the corrected part round
                gp = prior * up / len(zp)
                gu = -uu / len(zu)
            grad = np.zeros(d + 1)
            for (i, x, t), g in zip(picks, (gp, gu), strict=True):
                grad[:d] += np.bincount(i, g[t] * x, d)
                grad[d] += g.sum()
            grad[:d] += decay * w
            step += 1
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad**2
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w -= move[:d]
            bias -= move[d]
    zp, zu = (bias + np.bincount(text, w[index] * value, n) for n, index, value, text in groups)
    scale, shift = calibrate(zp, zu, prior)
    full = np.zeros(1 << bits)
    full[words] = w * scale
    return Model(bits, full, float(bias * scale + shift))


def calibrate(zp: np.ndarray, zu: np.ndarray, prior: float, steps: int = 3000, rate: float = 0.02) -> tuple[float, float]:
    """Scale and shift of the decision value that minimise the same corrected risk.

    The descent is stopped early, so scores come out too small; two numbers
    put them on the scale of a probability without changing their order.
    """
    x = np.array([1.0, 0.0])
    m, v = np.zeros(2), np.zeros(2)
    for t in range(1, steps + 1):
        uu = 1 / (1 + np.exp(-np.clip(x[0] * zu + x[1], -40, 40)))
        # prior * (d loss as 1 - d loss as 0) of a toxic text is -prior, whatever its value
        grad = np.array([np.mean(uu * zu) - prior * np.mean(zp), np.mean(uu) - prior])
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        x[0] = min(max(x[0], 0.1), 6.0)
    return float(x[0]), float(x[1])


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits weights, a fixed size

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                part = batch.slice(a, b - a)
                yield pa.record_batch({"id": part.column(0), "score": shared.value.scores(part.column(1))})

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(giving_back(run), f"id {kind}, score double")


def below(docs: DataFrame, model: Model, limit: float, text_column: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``limit`` or more; columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_column)

    def run(batches):
        for batch in batches:
            texts = batch.column(place).cast(pa.string())
            for a, b in text_slices(texts):
                keep = shared.value.scores(texts.slice(a, b - a)) < limit
                yield batch.slice(a, b - a).filter(pa.array(keep))

    return docs.mapInArrow(giving_back(run), docs.schema)
