"""Exact top-k search by inner product with MaxScore.

A vector of whole numbers is a document whose terms are its components.  Each
shard of the candidates holds the posting list of every component; as nearly
all components are non-zero, a list is a column with a value for each row.
With it go its largest and smallest value and the rows that have them.  For a
query, the terms are ordered by what they can add to a score at most.  The weak
ones that together stay below the k-th best score so far are non-essential: no
row can win by them alone.  The essential lists are traversed; then the other
terms are probed for the rows that are still competitive, strongest first, and
rows are dropped as soon as what is left cannot lift them to the k-th score.
The best of each shard are merged.

Queries and candidates meet in a grid of query blocks and shards, so each task
holds a bounded number of both, whatever their totals.

Defined results: vectors that are null, or hold null or non-finite components,
take no part, nor do rows without an id.  An id stands for one vector (the
smallest, if rows differ); repeated rows count once.  Missing components of
shorter vectors count as 0.  Ties go to the smaller id; fewer than k rows give
all; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

#: Candidates in a shard and queries in a block, on average.
SHARD_ROWS = 16384
BLOCK_QUERIES = 1024
#: Rows with the largest values of a term, whose scores give the first threshold of a query; and terms that give such rows.
SEED_ROWS = 32
SEED_TERMS = 4
#: Terms probed between two prunings.
PROBES = 4


def whole_vectors(table: DataFrame, id_column: str, vector_column: str, scale: int = 256) -> DataFrame:
    """``id, vector``: floor(scale * x) of each component, x as double, for the rows that take part."""
    x = F.col(vector_column)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("bigint"))
    valid = table.where(F.col(id_column).isNotNull() & x.isNotNull() & fine)
    return valid.select(F.col(id_column).alias("id"), whole.alias("vector")).groupBy("id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column as a matrix, short rows filled with 0."""
    lengths = np.asarray(column.value_lengths(), dtype=np.int64)
    values = np.asarray(column.flatten(), dtype=np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    out = np.zeros((len(column), width), dtype=np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = at < width
    out[row[inside], at[inside]] = values[inside]
    return out


class Shard:
    """Posting lists of some candidates, by component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.lists = np.ascontiguousarray(vectors[order].T)
        few = min(SEED_ROWS, len(ids))
        #: By sign of the query's component: the best value of a list, and the rows with the best ones.
        self.best = [self.lists.max(axis=1, initial=0), self.lists.min(axis=1, initial=0)]
        self.leaders = [np.argpartition(way * self.lists, few - 1, axis=1)[:, :few] if few else None for way in (-1, 1)]

    def _top(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows; rows are in the order of ids, so a stable sort settles ties."""
        if len(rows) > 4 * k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            stay = scores >= least
            rows, scores = rows[stay], scores[stay]
        order = np.argsort(-scores, kind="stable")[:k]
        return rows[order], scores[order]

    def search(self, own_id, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than the query's own."""
        n = len(self.ids)
        own = int(np.searchsorted(self.ids, own_id))
        own = own if own < n and self.ids[own] == own_id else -1
        terms = np.flatnonzero(query)
        bound = np.where(query > 0, query * self.best[0], query * self.best[1])[terms]
        order = np.argsort(bound, kind="stable")
        terms, bound = terms[order], bound[order]
        threshold = self._threshold(own, query, terms, k)
        below = np.cumsum(bound)
        weak = 0 if threshold is None else int(np.searchsorted(below, threshold, side="left"))
        total, add = np.zeros(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        for d in terms[weak:]:
            np.multiply(self.lists[d], query[d], out=add)
            total += add
        rest = int(below[weak - 1]) if weak else 0
        rows = np.arange(n) if threshold is None else np.flatnonzero(total + rest >= threshold)
        rows = rows[rows != own]
        total = total[rows]
        for at in range(weak, 0, -PROBES):
            for i in range(at - 1, max(at - PROBES, 0) - 1, -1):
                total += query[terms[i]] * self.lists[terms[i], rows]
                rest -= int(bound[i])
            if threshold is not None:
                stay = total + rest >= threshold
                rows, total = rows[stay], total[stay]
        rows, scores = self._top(rows, total, k)
        return self.ids[rows], scores

    def _threshold(self, own: int, query: np.ndarray, terms: np.ndarray, k: int) -> int | None:
        """The k-th score among the leaders of the strongest terms; None if they are too few."""
        leaders = [self.leaders[int(query[d] < 0)][d] for d in terms[::-1][:SEED_TERMS]]
        rows = np.unique(np.concatenate(leaders)) if leaders else np.zeros(0, dtype=np.int64)
        rows = rows[rows != own]
        if len(rows) < k:
            return None
        return int(np.partition(query @ self.lists[:, rows], len(rows) - k)[len(rows) - k])


def top_k(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """``query_id, rank, id, score`` for the rows of ``vectors`` (id, vector) where ``is_query`` holds, against all others."""
    vectors = materialize(vectors, "maxscore-vectors")
    queries = vectors.where(is_query)
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))

    def spread(table, own, n_own, other, n_other):
        cell = F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int").alias(own)
        return table.select("id", "vector", cell, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    left = spread(queries, "block", blocks, "shard", shards)
    right = spread(vectors, "shard", shards, "block", blocks)
    kind = vectors.schema["id"].dataType.simpleString()

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = ([], [], [])
        if asked.num_rows and held.num_rows:
            asked, held = asked.combine_chunks(), held.combine_chunks()
            vectors_ = matrix(held.column("vector").combine_chunks())
            shard = Shard(np.asarray(held.column("id")), vectors_)
            asks = matrix(asked.column("vector").combine_chunks(), vectors_.shape[1])
            for own, query in zip(np.asarray(asked.column("id")), asks, strict=True):
                ids, scores = shard.search(own, query, k)
                out[0].append(np.full(len(ids), own))
                out[1].append(ids)
                out[2].append(scores)
        made = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in out]
        return pa.table(made, names=["query_id", "id", "score"])

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(
        meet, f"query_id {kind}, id {kind}, score bigint"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
