"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target number of words.  Each of its documents should be
taken ``target / source size`` times on average: a whole part, which is taken
for certain, and a fraction, which is rounded dependently.  Two documents with
fractions meet, and words of probability mass are moved from one to the other,
in a random direction that leaves both expectations alone, until one of them
is wholly in or out.  The other one goes on to meet the next.  Blocks of
documents are worked off in parallel; what each block has left over meets in
the blocks of the next level, a reduction tree of fan-in ``BLOCK``.  Mass is
counted in words and never lost, so the words taken of a source miss its target
by less than the one document that is left at the end.  For that to be a small
one, up to ``RESERVE`` small documents of each source meet the root of its tree
last, from large to small, and there mass moves to the nearer end.  All of it
is DataFrame expressions.

Random choices are hashes of the two documents that meet and a seed, so a rerun
decides alike.

Defined results: a null text has size 0, and so do empty ones; they are taken
for the whole part only.  A null source is a source of its own, ordered last.
Identical rows (id, source, size) are split one by one: a whole number of them
is taken once more, and at most one is rounded.  A source without words has
target 0.  An empty table gives an empty table.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Documents that meet in one block.
BLOCK = 256

#: Small documents of a source that wait for the root of its tree, at most (and at most half of them).
RESERVE = 128

UNIT = ["source", "source_size", "target", "base", "id", "size", "copies_of_row", "sure"]


def word_count(text) -> F.Column:
    """Number of maximal runs of characters other than space and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 3) -> DataFrame:
    """``source, source_size, n_units, target`` of a table ``source, source_size, n_units`` (one row per source).

    Capped sources give their excess to the others by weight.  The end state
    has one level for all: a source gets ``weight * level`` or its cap, if that
    is less.  Ordered by cap per weight, the level is the largest of what
    remains after the caps before a source, per weight from it on.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))  # one row per source
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.select("*", weight.alias("weight"), (F.col("source_size") * cap).alias("most"))
    by_cap = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    every = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))
    shares = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = F.max("level").over(every)
    wanted = F.col("weight") * F.col("top")
    return (
        ranked.withColumn("level", left.cast("double") / shares)
        .withColumn("top", level)
        .select("source", "source_size", "n_units", F.least(F.col("most").cast("double"), wanted).alias("target"))
    )


def _units(sized: DataFrame, cap: int) -> tuple[DataFrame, int]:
    """One row per distinct (id, source, size) with what is certain and the mass left to round; and the largest count of a source."""
    units = materialize(
        sized.groupBy("source", "id", "size").agg(F.count(F.lit(1)).alias("copies_of_row")), "mixing-units"
    )
    sizes = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies_of_row")).alias("source_size"), F.count(F.lit(1)).alias("n_units")
    )
    per_source = materialize(targets(sizes, cap=cap), "mixing-targets")
    largest = per_source.agg(F.max("n_units")).first()[0] or 0
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at_cap = F.col("target") >= F.col("source_size") * cap
    base = F.when((F.col("source_size") > 0) & at_cap, F.lit(cap)).otherwise(F.least(F.floor(rate), F.lit(cap)))
    part = F.when(at_cap, F.lit(0.0)).otherwise(rate - F.floor(rate)) * F.col("copies_of_row")
    joined = units.join(per_source.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "inner")
    out = (
        joined.withColumn("base", base.cast("bigint"))
        .withColumn("part", part)
        .withColumn("sure", F.floor("part").cast("bigint"))
        .withColumn("mass", F.when(F.col("size") > 0, (F.col("part") - F.floor("part")) * F.col("size")).otherwise(F.lit(0.0)))
    )
    return out.select(*UNIT, "mass", "n_units"), largest


def chance(*columns) -> F.Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(2**53)) / F.lit(float(2**53))


def _meet(state, unit, seed: int | None):
    """The pivotal step: ``state.current`` meets ``unit``; one is decided and the other goes on.

    Without a seed mass moves to the nearer end of ``state.current``.
    """
    a, b = state["current"], unit
    up = F.least(a["size"] - a["mass"], b["mass"])  # a gains, b loses
    down = F.least(a["mass"], b["size"] - b["mass"])
    if seed is None:
        gains = a["mass"] * 2 >= a["size"]
    else:
        gains = chance(a["id"], a["size"], b["id"], b["size"], F.lit(seed)) * (up + down) < down
    a_full = a["size"] - a["mass"] <= b["mass"]
    a_empty = a["mass"] <= b["size"] - b["mass"]

    def decided(x, taken):
        return F.concat(state["decided"], F.array(F.struct(x.alias("unit"), F.lit(taken).alias("extra"))))

    def going(x, mass):
        return x.withField("mass", F.greatest(mass, F.lit(0.0)))

    def step(current, rest):
        return F.struct(current.alias("current"), rest.alias("decided"))

    return (
        F.when(gains & a_full, step(going(b, b["mass"] - up), decided(a, 1)))
        .when(gains, step(going(a, a["mass"] + up), decided(b, 0)))
        .when(a_empty, step(going(b, b["mass"] + down), decided(a, 0)))
        .otherwise(step(going(a, a["mass"] - down), decided(b, 1)))
    )


FIELDS = [*UNIT, "mass", "n_units"]


def _reduced(units: DataFrame, keys: list[str], order, seed: int | None) -> DataFrame:
    """The units of each group met in ``order``: ``unit, extra``, with ``extra`` null for the one left over."""
    unit = F.struct(*[F.col(c) for c in FIELDS])
    grouped = units.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order.alias("order"), unit.alias("unit")))).alias("members"))
    none = F.expr("slice(array(struct(members[0].unit as unit, 0 as extra)), 1, 0)")
    start = F.struct(F.col("members")[0]["unit"].alias("current"), none.alias("decided"))
    run = F.aggregate(F.expr("slice(members, 2, size(members))"), start, lambda s, m: _meet(s, m["unit"], seed))
    left = F.array(F.struct(F.col("run.current").alias("unit"), F.lit(None).cast("int").alias("extra")))
    done = grouped.select(run.alias("run")).select(F.explode(F.concat("run.decided", left)).alias("x"))
    return done.select("x.unit", "x.extra")


def _decided(done: DataFrame) -> DataFrame:
    return done.where("extra is not null").select("unit.*", (F.col("unit.sure") + F.col("extra")).alias("extra"))


def _reserve(units: DataFrame, seed: int) -> DataFrame:
    """Small documents of each source: the smallest of each of up to ``RESERVE`` parts, dealt by hash."""
    part = F.pmod(F.xxhash64("id", "size", F.lit(seed)), F.greatest(F.least(F.lit(RESERVE), F.floor(F.col("n_units") / 2)), F.lit(1)))
    unit = F.struct(F.col("size").alias("by"), F.xxhash64("id", F.lit(seed)).alias("h"), F.struct(*FIELDS).alias("unit"))
    return units.groupBy("source", part.alias("part")).agg(F.min(unit).alias("least")).select("least.unit.*")


def mix(docs: DataFrame, seed: int = 11, block: int = BLOCK, cap: int = 3) -> DataFrame:
    """Copies of each unit of ``docs`` (columns: id, source, size).

    Returns one row per distinct (id, source, size): ``source, source_size,
    target, base, id, size, copies_of_row, extra``.  Each of the
    ``copies_of_row`` identical rows is taken ``base`` times, and the first
    ``extra`` of them once more.
    """
    units, largest = _units(docs, cap)
    settled = units.where("mass <= 0").withColumn("extra", F.col("sure"))
    parts = [settled]
    rounding = units.where("mass > 0")
    reserve = materialize(_reserve(rounding, seed + 1), "mixing-reserve")
    held = reserve.select(F.col("source").alias("s"), F.col("id").alias("i"), F.col("size").alias("z"))
    same = F.col("source").eqNullSafe(F.col("s")) & F.col("id").eqNullSafe(F.col("i")) & (F.col("size") == F.col("z"))
    todo = rounding.join(held, same, "left_anti")
    level, count = 0, largest
    while count > 1:
        level += 1
        blocks = F.greatest(F.ceil(F.col("n_units") / F.lit(float(block**level))), F.lit(1))
        dealt = todo.withColumn("block", F.pmod(F.xxhash64("id", "size", F.lit(seed + 10 * level)), blocks))
        order = F.xxhash64("id", "size", F.lit(seed + 10 * level + 1))
        done = materialize(_reduced(dealt, ["source", "block"], order, seed + 10 * level + 2), f"mixing-level{level}")
        parts.append(_decided(done))
        todo = done.where("extra is null").select("unit.*")
        count = math.ceil(count / block)
    # The root of each tree first, then the reserve from large to small.
    last = todo.withColumn("turn", F.lit(0)).unionByName(reserve.withColumn("turn", F.lit(1)))
    order = F.struct("turn", (-F.col("size")).alias("by"), F.xxhash64("id", F.lit(seed)).alias("h"))
    done = materialize(_reduced(last, ["source"], order, None), "mixing-last")
    parts.append(_decided(done))
    nearer = F.col("unit.sure") + (F.col("unit.mass") * 2 >= F.col("unit.size")).cast("int")
    parts.append(done.where("extra is null").select("unit.*", nearer.alias("extra")))
    return reduce(DataFrame.unionByName, [p.select(*UNIT[:-1], F.col("extra").cast("bigint").alias("extra")) for p in parts])


def taken_per_row(mixed: DataFrame) -> DataFrame:
    """One row per input row: how many words of it the mix takes."""
    step = 4096  # a row repeated very often is unfolded in two goes, so no array is long
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies_of_row") - 1, F.lit(step).cast("bigint")))
    rows = F.explode(F.sequence(F.col("from") + 1, F.least(F.col("from") + step, F.col("copies_of_row"))))
    return mixed.withColumn("from", starts).withColumn("row", rows).select(
        "id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("base") + (F.col("row") <= F.col("extra")).cast("bigint"))).alias("taken"),
    )


def repeat_rows(docs: DataFrame, mixed: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (not at all for 0), columns unchanged."""
    names = [f"d{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    of = dict(zip(docs.columns, names, strict=True))
    key = [of[id_column], of[source_column]]
    sized = plain.withColumn("words", word_count(F.col(of[text_column])))
    same = F.col(key[0]).eqNullSafe(F.col("id")) & F.col(key[1]).eqNullSafe(F.col("source")) & (F.col("words") == F.col("size"))
    joined = sized.join(mixed, same, "inner")
    nth = F.row_number().over(Window.partitionBy("id", "source", "size").orderBy(of[text_column]))
    copies = F.col("base") + F.when((F.col("copies_of_row") == F.col("extra")) | (F.col("extra") == 0), F.least("extra", F.lit(1))).otherwise(
        (F.col("nth") <= F.col("extra")).cast("bigint")
    )
    return (
        joined.withColumn("nth", nth)
        .withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
        .select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
    )
