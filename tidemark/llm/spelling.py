"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word becomes the vector of its letter counts.  A replaced letter moves the
vector by exactly 2 in L1, an inserted or deleted one by exactly 1, so the near
words of a word lie in a small ball round it.  Words are filed by length, and
each length is a k-d tree: its top is cut on a bounded sample and spreads the
words over cells, below that every cell builds its own tree.  A word is a point
in one cell of its length.  It is sent as a query to the cells of its length
whose box is at most 2 away, and to those of the next shorter length at most 1
away; there the tree is searched with the same pruning, and what has the right
distance is verified on the order of the letters.

The sample only places the cuts.  What the cells really hold is counted, and a
cell with more points or queries than ``Setting.cell`` is split by hash into
blocks that meet pair by pair, so the result does not depend on the sample and
no task grows with the vocabulary.  A cell returns the number of near words and
the best one for each of its words, not the pairs.

Defined results: null and empty texts have no words, a null document id counts
as an empty text in ``<id>:<run>``, repeated rows count again, ties between near words of the
same count go to the smallest in code-point order.  An empty table gives an
empty result.  Columns other than the named ones are ignored.  Texts are read
whole, and words may be of any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textblocks import text_slices
from tidemark.session import materialize

#: The letters of a word, as the contract of the query names them; fixed values.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: A run of a document loses a letter when its hash is divisible by this.
SPOILED = 199
#: Distances in L1 of a replaced letter, and of one more or less.
REPLACED, INSERTED = 2, 1
#: Place of a letter in the vector of counts.
LETTERS = 26 + 64
PLACE = np.zeros(256, dtype=np.int64)
PLACE[97:123] = np.arange(26)
PLACE[192:256] = np.arange(26, LETTERS)


@dataclass(frozen=True)
class Setting:
    """Least length and count of a word, how much commoner a form must be, and the sizes that bound a task."""

    letters: int = 6
    occurrences: int = 5
    ratio: int = 5
    cell: int = 20_000
    sample: int = 50_000
    leaf: int = 32


# --- words ----------------------------------------------------------------------


def _counted(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in text_slices(batch.column("text"), 4 << 20):
                part = batch.slice(low, high - low)
                counts: Counter[str] = Counter()
                for number, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    start = zlib.crc32(f"{number or ''}:".encode())
                    for word, n in Counter(RUN.findall((text or "").encode().lower().decode())).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % SPOILED == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        counts[word] += n
                rows = [(w, n) for w, n in counts.items() if len(w) >= least]
                yield pa.record_batch([pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], names=["word", "n"])

    return run


def vocabulary(docs: DataFrame, setting: Setting, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n`` of all words that are long and frequent enough."""
    source = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text"))
    partial = source.mapInArrow(_counted(setting.letters), "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= setting.occurrences)


# --- vectors and trees ----------------------------------------------------------


def code_points(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1)


def vectors(points: np.ndarray) -> np.ndarray:
    """Letter counts of words given as code points."""
    n, length = points.shape
    cell = PLACE[points] + (np.arange(n) * LETTERS)[:, None]
    counts = np.bincount(cell.ravel(), minlength=n * LETTERS).reshape(n, LETTERS)
    return counts.astype(np.uint8 if length < 255 else np.int32)


class Tree:
    """A k-d tree over rows of counts.

    A node is ``(lo, hi, dim, cut, left, right)``: rows with ``row[dim] <= cut`` are
    on the left.  A leaf has the number of the leaf as ``left`` and no ``dim``.
    The boxes are those of the rows, or with ``open_boxes`` those of the cuts
    alone, for rows that are not known yet.
    """

    def __init__(self, rows: np.ndarray, leaf: int, open_boxes: bool = False):
        self.nodes: list[tuple] = []
        self.leaves: list[np.ndarray] = []
        top = np.iinfo(rows.dtype).max
        box = np.zeros(rows.shape[1], rows.dtype), np.full(rows.shape[1], top, rows.dtype)
        pending = [(np.arange(len(rows)), *box, None)]
        while pending:
            which, lo, hi, parent = pending.pop()
            here = rows[which]
            tight = (here.min(0), here.max(0)) if len(which) else (lo, hi)
            me = len(self.nodes)
            if parent is not None:
                self.nodes[parent[0]][parent[1]] = me
            own = (lo, hi) if open_boxes else tight
            cut = _cut(here, *tight) if len(which) > leaf else None
            if cut is None:
                self.nodes.append([*own, None, 0, len(self.leaves), 0])
                self.leaves.append(which)
                continue
            dim, at = cut
            self.nodes.append([*own, dim, at, 0, 0])
            low_hi, high_lo = hi.copy(), lo.copy()
            low_hi[dim], high_lo[dim] = at, at + 1
            left = here[:, dim] <= at
            pending.append((which[~left], high_lo, hi, (me, 5)))
            pending.append((which[left], lo, low_hi, (me, 4)))

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf in which each row lies."""
        out = np.zeros(len(rows), dtype=np.int32)
        pending = [(0, np.arange(len(rows)))]
        while pending:
            node, which = pending.pop()
            _, _, dim, at, left, right = self.nodes[node]
            if dim is None:
                out[which] = left
                continue
            low = rows[which, dim] <= at
            pending += [(k, w) for k, w in ((left, which[low]), (right, which[~low])) if len(w)]
        return out

    def reached(self, rows: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Every leaf with the rows that are at most ``radius`` away from its box."""
        pending = [(0, np.arange(len(rows)))]
        while pending:
            node, which = pending.pop()
            lo, hi, dim, _, left, right = self.nodes[node]
            here = rows[which]
            away = (np.maximum(lo, here) - here).sum(1, dtype=np.int64) + (here - np.minimum(hi, here)).sum(1, dtype=np.int64)
            which = which[away <= radius]
            if not len(which):
                continue
            if dim is None:
                yield left, which
            else:
                pending += [(right, which), (left, which)]


def _cut(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[int, int] | None:
    """The dimension and value that halve the rows best, of the three that vary most; None if all are equal."""
    spread = np.flatnonzero(hi > lo)
    if not len(spread):
        return None
    tried = spread[np.argsort(-rows[:, spread].var(0), kind="stable")[:3]]
    best = None
    for dim in tried.tolist():
        below = np.cumsum(np.bincount(rows[:, dim]))[:-1]
        below[: lo[dim]] = -len(rows)  # nothing would be on the left
        at = int(np.argmin(np.abs(2 * below - len(rows))))
        off = abs(2 * int(below[at]) - len(rows))
        if best is None or off < best[0]:
            best = off, dim, at
    return best[1], best[2]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words of equal length (code points, row by row) differ in exactly one place."""
    return (a != b).sum(1) == 1


def one_inserted(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Whether the shorter word is the longer one without one code point."""
    length = shorter.shape[1]
    front = np.cumprod(longer[:, :length] == shorter, axis=1, dtype=np.int64).sum(1)
    back = np.cumprod((longer[:, 1:] == shorter)[:, ::-1], axis=1, dtype=np.int64).sum(1)
    return front + back >= length


def near_in_cell(points: list[str], queries: list[str], leaf: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (number of a query, number of a point) of words one edit apart, in blocks.

    All points are of one length; the queries are of the same length or one longer.
    """
    p = code_points(points)
    rows = vectors(p)
    tree = Tree(rows, leaf)
    longer = np.fromiter((len(q) > p.shape[1] for q in queries), dtype=bool, count=len(queries))
    for group, distance, verified in ((~longer, REPLACED, one_replaced), (longer, INSERTED, one_inserted)):
        numbers = np.flatnonzero(group)
        if not len(numbers):
            continue
        q = code_points([queries[i] for i in numbers.tolist()])
        asked = vectors(q).astype(rows.dtype)
        step = max(1, (1 << 22) // (leaf * LETTERS))
        for number, which in tree.reached(asked, distance):
            members = tree.leaves[number]
            for at in range(0, len(which), step):
                some = which[at : at + step]
                for m in range(0, len(members), leaf):
                    there = members[m : m + leaf]
                    a, b = asked[some][:, None, :], rows[there][None]
                    away = (np.maximum(a, b) - np.minimum(a, b)).sum(2, dtype=np.int32)
                    i, j = np.nonzero(away == distance)
                    i, j = some[i], there[j]
                    pairs = max(1, (1 << 22) // q.shape[1])
                    for k in range(0, len(i), pairs):
                        x, y = i[k : k + pairs], j[k : k + pairs]
                        ok = verified(q[x], p[y])
                        if ok.any():
                            yield numbers[x[ok]], y[ok]


# --- cells ----------------------------------------------------------------------


def top_trees(words: DataFrame, setting: Setting) -> dict[int, Tree]:
    """For each length with more words than a cell holds, the tree whose leaves are the cells.

    Read from at most about ``setting.sample`` words, chosen by hash; the
    lengths are as many as cells at most.
    """
    sizes = {r["length"]: r["count"] for r in words.groupBy("length").count().where(F.col("count") > setting.cell).collect()}
    if not sizes:
        return {}
    total = sum(sizes.values())
    share = min(1.0, setting.sample / total)
    hashed = F.pmod(F.xxhash64("word", F.lit("cells")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    large = words.where(F.col("length").isin(*sizes)).where(hashed).select("word", "length")
    drawn: dict[int, list[str]] = {}
    for r in large.toLocalIterator():
        drawn.setdefault(r["length"], []).append(r["word"])
    return {length: Tree(vectors(code_points(some)), max(1, round(len(some) * setting.cell / sizes[length])), open_boxes=True) for length, some in drawn.items()}


def _routed(trees: dict[int, Tree]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            by_length: dict[int, list[int]] = {}
            for i, w in enumerate(words):
                by_length.setdefault(len(w), []).append(i)
            for length, numbers in by_length.items():
                numbers = np.array(numbers)
                rows = vectors(code_points([words[i] for i in numbers.tolist()]))
                out = []
                for tree_of, radius in ((length, REPLACED), (length - 1, INSERTED)):
                    tree = trees.get(tree_of)
                    if tree is None:
                        out.append((tree_of, 0, numbers, False))
                        if tree_of == length:
                            out.append((tree_of, 0, numbers, True))
                        continue
                    kind = tree.nodes[0][0].dtype
                    out += [(tree_of, leaf, numbers[which], False) for leaf, which in tree.reached(rows.astype(kind), radius)]
                    if tree_of == length:
                        leaves = tree.leaf_of(rows)
                        out += [(tree_of, leaf, numbers[leaves == leaf], True) for leaf in np.unique(leaves).tolist()]
                for tree_of, leaf, which, is_point in out:
                    n = len(which)
                    yield pa.record_batch(
                        [
                            pa.array(np.full(n, tree_of, np.int32)),
                            pa.array(np.full(n, leaf, np.int32)),
                            pa.array([is_point] * n, pa.bool_()),
                            pa.array([words[i] for i in which.tolist()], pa.string()),
                            pa.array(counts[which], pa.int64()),
                        ],
                        names=["length", "leaf", "is_point", "word", "n"],
                    )

    return run


def _best(order: list[tuple[int, str]]) -> np.ndarray:
    """Rank of each word by count, then code points: the smaller the better."""
    rank = np.empty(len(order), dtype=np.int64)
    rank[sorted(range(len(order)), key=order.__getitem__)] = np.arange(len(order))
    return rank


def _search(leaf: int) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        is_point = np.asarray(group.column("is_point").combine_chunks().cast(pa.uint8())).astype(bool)
        words, counts = np.array(group.column("word").to_pylist(), dtype=object), group.column("n").to_numpy()
        sides = [(words[m].tolist(), counts[m]) for m in (is_point, ~is_point)]
        (points, point_n), (queries, query_n) = sides
        found: dict[str, list] = {"word": [], "n_near": [], "best_n": [], "best": []}
        if points and queries:
            ranks = [_best([(-int(c), w) for w, c in zip(ws, cs, strict=True)]) for ws, cs in sides]
            near = [np.zeros(len(ws), np.int64) for ws, _ in sides]
            best = [np.full(len(ws), np.iinfo(np.int64).max) for ws, _ in sides]
            longer = np.fromiter((len(q) > len(points[0]) for q in queries), dtype=bool, count=len(queries))
            for q, p in near_in_cell(points, queries, leaf):
                near[1] += np.bincount(q, minlength=len(queries))
                np.minimum.at(best[1], q, ranks[0][p])
                # Words of one length meet twice, each once as the query; others only here.
                q, p = q[longer[q]], p[longer[q]]
                near[0] += np.bincount(p, minlength=len(points))
                np.minimum.at(best[0], p, ranks[1][q])
            for mine, other in ((0, 1), (1, 0)):
                by_rank = np.argsort(ranks[other])
                some = np.flatnonzero(near[mine])
                who = by_rank[best[mine][some]]
                found["word"] += [sides[mine][0][i] for i in some.tolist()]
                found["n_near"] += near[mine][some].tolist()
                found["best_n"] += sides[other][1][who].tolist()
                found["best"] += [sides[other][0][i] for i in who.tolist()]
        kinds = {"word": pa.string(), "n_near": pa.int64(), "best_n": pa.int64(), "best": pa.string()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in found.items()})

    return run


def near_words(words: DataFrame, setting: Setting) -> DataFrame:
    """``word, n_near, best, best_n`` of every word of ``words`` (``word, n, length``) that has a near one."""
    trees = top_trees(words, setting)
    routed = words.select("word", "n").mapInArrow(_routed(trees), "length int, leaf int, is_point boolean, word string, n bigint")
    routed = materialize(routed, "spelling-cells")
    held = routed.groupBy("length", "leaf").agg(F.count_if("is_point").alias("points"), F.count_if(~F.col("is_point")).alias("queries"))
    blocks = lambda c: F.ceil(F.col(c) / setting.cell).cast("int")
    held = held.where("points > 0 and queries > 0").select("length", "leaf", blocks("points").alias("points"), blocks("queries").alias("queries"))
    own = F.when(F.col("is_point"), F.col("points")).otherwise(F.col("queries"))
    met = F.when(F.col("is_point"), F.col("queries")).otherwise(F.col("points"))
    block = F.pmod(F.xxhash64("word"), own).cast("int")
    pairs = (
        routed.join(held, ["length", "leaf"])
        .select("length", "leaf", "is_point", "word", "n", block.alias("own"), F.explode(F.sequence(F.lit(0), met - 1)).alias("met"))
        .select(
            "length", "leaf", "is_point", "word", "n",
            F.when(F.col("is_point"), F.col("own")).otherwise(F.col("met")).alias("point_block"),
            F.when(F.col("is_point"), F.col("met")).otherwise(F.col("own")).alias("query_block"),
        )
    )
    found = pairs.groupBy("length", "leaf", "point_block", "query_block").applyInArrow(
        _search(setting.leaf), "word string, n_near bigint, best_n bigint, best string"
    )
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top"))
    return merged.select("word", "n_near", F.col("top.word").alias("best"), (-F.col("top.n")).alias("best_n"))


def with_roots(variants: DataFrame) -> DataFrame:
    """Adds ``root``, the end of the forms from a word on, by doubling the steps.

    A form is at least ``ratio`` times as frequent, so a way is short and the
    rounds are few.
    """
    ways = materialize(variants.where("form is not null").select("word", F.col("form").alias("root")), "spelling-ways")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        if ways.join(onward, "root", "left_semi").isEmpty():
            break
        ways = materialize(ways.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "spelling-ways")
    return variants.join(ways, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, setting: Setting | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts.

    The form of a word is its most frequent near word, if that is ``ratio``
    times as frequent; the root is where the forms lead.
    """
    setting = setting or Setting()
    words = vocabulary(docs, setting, id_column, text_column).withColumn("length", F.char_length("word"))
    words = materialize(words, "spelling-words")
    chosen = F.col("best_n") >= F.col("n") * setting.ratio
    found = words.join(near_words(words, setting), "word", "left").select(
        "word",
        F.when(chosen, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(chosen, F.col("best_n")).alias("form_n"),
    )
    return with_roots(materialize(found, "spelling-forms")).select("word", "form", "root", "n", "n_near", "form_n")
