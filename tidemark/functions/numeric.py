"""Scalar expressions with the engine's NULL rules (division by zero is NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scale factors between the units the indicators come in.
SCALES = {
    "none": 1.0,
    "pct_to_bps": 100.0,
    "mn_to_bn": 1 / 1_000.0,
    "mn_to_tn": 1 / 1_000_000.0,
    "bn_to_tn": 1 / 1_000.0,
}


def ratio(x: Column, y: Column) -> Column:
    return F.try_divide(x, y)


def pct_change(x: Column, base: Column) -> Column:
    return F.try_divide(x - base, base) * F.lit(100.0)


def clip(x: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a value; NULL stays NULL (``greatest``/``least`` alone would skip it)."""
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(x.isNotNull(), out)


def light(v: Column, rule: Column, threshold: Column) -> Column:
    """Traffic light of a value: ``g``, ``r`` or empty.

    Rules: ``high`` red at or above the threshold, ``low`` red below it, ``sign``
    red below zero, ``flip`` red above zero, ``floor`` red at or above an amount
    that ordinary small use never reaches; no rule gives no light.
    """

    def pick(red: Column) -> Column:
        return F.when(red, F.lit("r")).otherwise(F.lit("g"))

    return (
        F.when(v.isNull() | rule.isNull(), F.lit(""))
        .when(rule.isin("high", "floor"), pick(v >= threshold))
        .when(rule == "low", pick(v < threshold))
        .when(rule == "sign", pick(v < 0))
        .when(rule == "flip", pick(v > 0))
        .when(rule == "none", F.lit(""))
        .otherwise(F.raise_error(F.concat(F.lit("unknown light rule "), rule)))
    )


def threshold_split(v: Column, threshold: float, lo: float | None = None, hi: float | None = None) -> tuple[Column, Column]:
    """Parts of a value below and at-or-above a threshold, zero elsewhere.

    The value is rounded to 2 digits first and the test is on the clipped,
    rounded value, so a point on screen and its colour always agree.
    """
    shown = clip(F.round(v, 2), lo, hi)
    below = F.when(shown < threshold, shown).otherwise(F.lit(0.0))
    above = F.when(shown >= threshold, shown).otherwise(F.lit(0.0))
    return below, above


def signed_split(v: Column) -> tuple[Column, Column]:
    """Positive and negative part of a value rounded to 2 digits."""
    shown = F.round(v, 2)
    return clip(shown, lo=0.0), clip(shown, hi=0.0)


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, by the series of its integral (absolute error about 1e-15)."""
    start = F.struct(z.alias("term"), z.alias("total"))

    def add(a, k):
        term = a["term"] * z * z / (2 * k + 1)
        return F.struct(term.alias("term"), (a["total"] + term).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1), F.lit(120)), start, add, lambda a: a["total"])
    inner = 0.5 + total * F.exp(-z * z / 2) / F.sqrt(2 * F.pi())
    return F.when(z < -7, F.lit(0.0)).when(z > 7, F.lit(1.0)).when(z.isNotNull(), F.greatest(inner, F.lit(0.0)))
