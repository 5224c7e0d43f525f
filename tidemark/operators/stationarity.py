"""Unit-root screen of many series in aggregates: the augmented Dickey-Fuller regression by its Gram matrix.

The regression of a difference on the level before it, a constant and lagged
differences needs only sums of products.  Differences lagged by i and j have
the same products as those lagged by i - 1 and j - 1 but for the ends of the
sample, so a series with p lags needs 2 p + 5 sums and its first and last p
differences, not p * p sums: one combinable aggregation for all series.  The
matrix is then factorised (Cholesky) in array expressions.  Written with the
target last, the factor holds the residual sums of *all* nested lag orders, so
the order by information criterion costs no further pass.

No Python, and nothing per series but one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import normal_cdf
from tidemark.operators.calendar import resample_last
from tidemark.operators.windows import by_date, months_back

# Published response-surface polynomials for the p-value of a
# one-series test with constant (MacKinnon 1994), lowest power first.
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)

#: Verdict text by section (A picks the window of a level, B confirms a change) when stationary and when not.
ADVICE = {"A": ("expanding", "rolling(252d)"), "B": ("OK as FM factor", "!! re-examine form")}
#: Least number of values by section.
FLOORS = {"A": 60, "B": 48}


def schwert_lags(n: Column) -> Column:
    """Highest lag order tried for ``n`` values."""
    return F.greatest(F.least(F.ceil(12.0 * F.pow(n / 100.0, 0.25)), F.floor(n / 2) - 2), F.lit(0)).cast("int")


def _prepared(panel: DataFrame, lags: DataFrame, most: int) -> DataFrame:
    """One row per difference: ``series_id, n, p, t, d0 .. d<most>`` and the level before it, about its mean.

    ``lags`` has ``series_id, p``; ``t`` counts the differences from 0.
    """
    whole = Window.partitionBy("series_id")
    valued = panel.where(F.col("value").isNotNull()).join(lags.select("series_id", "p"), "series_id")
    steps = valued.select(
        "series_id",
        "p",
        "date",
        F.count("*").over(whole).alias("n"),
        (F.row_number().over(by_date()) - 2).alias("t"),
        (F.lag("value").over(by_date()) - F.avg("value").over(whole)).alias("y"),
        (F.col("value") - F.lag("value").over(by_date())).alias("d0"),
    )
    lagged = [F.lag("d0", j).over(by_date()).alias(f"d{j}") for j in range(1, most + 1)]
    return steps.select("series_id", "n", "p", "t", "y", "d0", *lagged).where("t >= 0")


def gram_matrices(panel: DataFrame, lags: DataFrame, most: int) -> DataFrame:
    """``series_id, n, p, obs, dd, dy, d, yy, y``: all inner products of the regression with ``p`` lags.

    ``dd`` is the matrix over the differences lagged by 0 to p, ``dy`` and ``d``
    their products with the level and the constant.
    """
    rows = _prepared(panel, lags, most)
    used = F.col("t") >= F.col("p")
    inside = lambda x: F.sum(F.when(used, x))
    ends = F.when((F.col("t") < F.col("p")) | (F.col("t") >= F.col("n") - 1 - F.col("p")), F.struct("t", F.col("d0").alias("d")))
    sums = rows.groupBy("series_id", "n", "p").agg(
        F.count_if(used).alias("obs"),
        F.array(*[inside(F.col("d0") * F.col(f"d{k}")) for k in range(most + 1)]).alias("first"),
        F.array(*[inside(F.col("y") * F.col(f"d{k}")) for k in range(most + 1)]).alias("dy"),
        inside(F.col("d0")).alias("sum_d"),
        inside(F.col("y") * F.col("y")).alias("yy"),
        inside(F.col("y")).alias("y"),
        F.map_from_entries(F.collect_list(ends)).alias("at"),
    )
    p, at, last = F.col("p"), F.col("at"), F.col("n") - 2

    def edge(i, j):
        """What the products lagged by i + 1 and j + 1 have more than those lagged by i and j."""
        return at[(p - 1 - i).cast("int")] * at[(p - 1 - j).cast("int")] - at[(last - i).cast("int")] * at[(last - j).cast("int")]

    def product(i, j):
        low, apart = F.least(i, j), F.abs(i - j)
        start = F.col("first")[apart.cast("int")]
        moved = F.aggregate(F.sequence(F.lit(0), low - 1), start, lambda total, m: total + edge(m, m + apart))
        return F.when(low > 0, moved).otherwise(start)

    def total(i):
        moved = F.aggregate(
            F.sequence(F.lit(0), i - 1), F.col("sum_d"), lambda s, m: s + at[(p - 1 - m).cast("int")] - at[(last - m).cast("int")]
        )
        return F.when(i > 0, moved).otherwise(F.col("sum_d"))

    index = F.sequence(F.lit(0), p)
    return sums.where("obs > p + 2").select(
        "series_id",
        "n",
        "p",
        "obs",
        F.transform(index, lambda i: F.transform(index, lambda j: product(i, j))).alias("dd"),
        "dy",
        F.transform(index, total).alias("d"),
        "yy",
        "y",
    )


def cholesky(matrix: Column) -> Column:
    """Lower factor, row by row, of a symmetric matrix given as an array of arrays; NaN where it is not positive."""
    none, empty = F.array().cast("array<array<double>>"), F.array().cast("array<double>")

    def dot(a, b, n):
        return F.aggregate(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def row(done, i):
        def entry(so_far, j):
            other = F.when(j < i, F.get(done, j)).otherwise(so_far)
            rest = F.get(F.get(matrix, i), j) - dot(so_far, other, j)
            value = F.when(j < i, F.try_divide(rest, F.get(other, j))).otherwise(F.sqrt(rest))
            return F.concat(so_far, F.array(F.coalesce(value, F.lit(float("nan")))))

        return F.aggregate(F.sequence(F.lit(0), i), empty, entry)

    return F.aggregate(F.sequence(F.lit(0), F.size(matrix) - 1), none, lambda done, i: F.concat(done, F.array(row(done, i))))


def _bordered(level_last: bool) -> Column:
    """Matrix over (constant, level, lagged differences, target), or with the level just before the target."""
    p = F.col("p")
    lagged = F.sequence(F.lit(1), F.greatest(p, F.lit(1)))
    lagged = F.when(p > 0, lagged).otherwise(F.array().cast("array<int>"))
    constant, level, target = F.lit(-1), F.lit(-2), F.lit(0)
    parts = [F.array(constant), lagged, F.array(level)] if level_last else [F.array(constant, level), lagged]
    order = F.concat(*parts, F.array(target))

    def value(a, b):
        i, j = F.least(a, b), F.greatest(a, b)  # constant -1, level -2, difference lagged by k: k
        return (
            F.when((i == -2) & (j == -2), F.col("yy"))
            .when((i == -2) & (j == -1), F.col("y"))
            .when(i == -2, F.get(F.col("dy"), j))
            .when((i == -1) & (j == -1), F.col("obs").cast("double"))
            .when(i == -1, F.get(F.col("d"), j))
            .otherwise(F.get(F.get(F.col("dd"), i), j))
        )

    return F.transform(order, lambda a: F.transform(order, lambda b: value(a, b)))


def choose_lags(panel: DataFrame, most: int | None = None) -> DataFrame:
    """``series_id, p``: the lag order of least AIC, every order judged on the sample the longest one allows.

    ``most`` bounds the orders tried; by default it follows from the longest series.
    """
    sizes = panel.where(F.col("value").isNotNull()).groupBy("series_id").agg(F.count("*").alias("n"))
    tried = sizes.select("series_id", schwert_lags(F.col("n")).alias("p"))
    if most is None:
        most = tried.agg(F.coalesce(F.max("p"), F.lit(0))).first()[0]
    tried = tried.select("series_id", F.least("p", F.lit(most)).alias("p"))
    factor = gram_matrices(panel, tried, most).select("series_id", "p", "obs", F.element_at(cholesky(_bordered(False)), -1).alias("c"))
    own = F.element_at("c", -1)
    rest = lambda q: own * own + F.aggregate(  # noqa: E731  residual sum with q lags: what the later columns explain comes on top
        F.slice("c", q + 3, F.greatest(F.col("p") - q, F.lit(0))), F.lit(0.0), lambda s, x: s + x * x
    )
    criterion = lambda q: F.col("obs") * F.ln(rest(q) / F.col("obs")) + 2 * (q + 2)
    scored = F.transform(F.sequence(F.lit(0), F.col("p")), lambda q: F.struct(criterion(q).alias("aic"), q.alias("q")))
    return factor.select("series_id", F.coalesce(F.array_min(scored)["q"], F.lit(0)).alias("p"))


def adf_fixed_lag(panel: DataFrame, lags: int | DataFrame, most: int | None = None) -> DataFrame:
    """``series_id, n, used_lag, obs, adf_stat, p_value``: the test with constant and a given number of lagged differences.

    ``lags`` is a number, or a table ``series_id, p`` with ``most`` as its largest
    entry.  Series too short for the regression are left out; one without
    variation has neither statistic nor p-value.
    """
    if isinstance(lags, int):
        most = lags
        lags = panel.select("series_id").distinct().withColumn("p", F.lit(lags))
    elif most is None:
        most = lags.agg(F.coalesce(F.max("p"), F.lit(0))).first()[0]
    last = F.element_at(cholesky(_bordered(True)), -1)
    fit = gram_matrices(panel, lags, most).select("series_id", "n", "p", "obs", last.alias("c"))
    # The level stands last, so its coefficient over its error is its entry over the residual deviation.
    own, level = F.element_at("c", -1), F.element_at("c", -2)
    stat = F.try_divide(level, own / F.sqrt(F.col("obs") - F.col("p") - 2))
    fit = fit.withColumn("adf_stat", F.when(F.isnan(stat), None).otherwise(stat))
    return fit.select("series_id", "n", F.col("p").alias("used_lag"), "obs", "adf_stat", p_value(F.col("adf_stat")).alias("p_value"))


def p_value(stat: Column) -> Column:
    """Probability of a statistic at least as negative under a unit root."""

    def poly(coefficients):
        out = F.lit(0.0)
        for c in reversed(coefficients):
            out = out * stat + F.lit(c)
        return out

    score = F.when(stat <= TAU_STAR, poly(SMALL_P)).otherwise(poly(LARGE_P))
    return F.when(stat > TAU_MAX, F.lit(1.0)).when(stat < TAU_MIN, F.lit(0.0)).when(stat.isNotNull(), normal_cdf(score))


# --- the screen -------------------------------------------------------------------


def screen_inputs(panel: DataFrame, items: DataFrame) -> DataFrame:
    """``section, label, transform, date, value`` of every item ``section, label, transform, series_id``.

    Composites are series of the panel like others.  Transforms: ``level``;
    ``diff``, to the row before; ``month_diff``, month ends against the calendar
    month before (none across an empty month); ``month_pct``, month ends
    against the last month with a value, in percent.
    """
    keyed = items.select(F.concat_ws("|", "section", "label").alias("key"), "section", "label", "transform", F.col("series_id").alias("of"))
    rows = panel.where(F.col("value").isNotNull()).join(keyed, F.col("series_id") == F.col("of"))
    rows = rows.select(F.col("key").alias("series_id"), "section", "label", "transform", "date", "value")
    monthly = resample_last(rows.where(F.col("transform").startswith("month_")).select("series_id", "date", "value"), "ME")
    before, row_before = months_back("value", 1), F.lag("value").over(by_date())
    ends = monthly.select("series_id", "date", (F.col("value") - before).alias("diff"), (F.try_divide(F.col("value"), row_before) - 1).alias("ratio"))
    ends = ends.join(keyed.select(F.col("key").alias("series_id"), "section", "label", "transform"), "series_id")
    change = F.when(F.col("transform") == "month_diff", F.col("diff")).otherwise(F.col("ratio") * 100.0)
    native = rows.where(~F.col("transform").startswith("month_")).withColumn("before", F.lag("value").over(by_date()))
    plain = F.when(F.col("transform") == "level", F.col("value")).otherwise(F.col("value") - F.col("before"))
    columns = ["section", "label", "transform", "date"]
    out = native.select(*columns, plain.alias("value")).unionByName(ends.select(*columns, change.alias("value")))
    return out.where(F.col("value").isNotNull())


def screen(inputs: DataFrame, items: DataFrame, lags: int | None = None) -> DataFrame:
    """One report row per item: ``section, series, transform, n, start, end, adf_stat, p_value, verdict, recommendation``.

    ``inputs`` as of ``screen_inputs``.  ``lags`` fixes the lag order; without
    it each series takes the one of least AIC.  Items with fewer values than
    their section asks for, or none, are reported as skipped.
    """
    floor = F.create_map(*[F.lit(x) for pair in FLOORS.items() for x in pair])
    key = F.concat_ws("|", "section", "label").alias("series_id")
    panel = inputs.select(key, "section", "date", "value")
    sizes = panel.groupBy("series_id", "section").agg(F.count("*").alias("n"), F.min("date").alias("start"), F.max("date").alias("end"))
    enough = sizes.where(F.col("n") >= floor[F.col("section")]).select("series_id")
    judged = panel.join(enough, "series_id", "left_semi").select("series_id", "date", "value")
    found = adf_fixed_lag(judged, choose_lags(judged) if lags is None else lags).select("series_id", "used_lag", "adf_stat", "p_value")
    rows = items.select("section", F.col("label").alias("series"), "transform", F.concat_ws("|", "section", "label").alias("series_id"))
    rows = rows.join(sizes.drop("section"), "series_id", "left").join(found, "series_id", "left")
    n, least = F.coalesce("n", F.lit(0)).cast("bigint"), floor[F.col("section")]
    stationary = F.col("p_value") < 0.05
    verdict = (
        F.when(n == 0, F.lit("SKIP: no data"))
        .when(n < least, F.concat(F.lit("SKIP: n<"), least.cast("string")))
        .when(stationary.isNull(), F.lit("SKIP: no variation"))
        .when(stationary, F.lit("stationary"))
        .otherwise(F.lit("non-stationary"))
    )
    advice = F.lit("")
    for section, (good, bad) in ADVICE.items():
        advice = F.when((F.col("section") == section) & stationary, good).when((F.col("section") == section) & ~stationary, bad).otherwise(advice)
    shown = n >= least
    return rows.select(
        "section",
        "series",
        "transform",
        n.alias("n"),
        F.when(shown, F.col("start")).alias("start"),
        F.when(shown, F.col("end")).alias("end"),
        "used_lag",
        "adf_stat",
        "p_value",
        verdict.alias("verdict"),
        F.coalesce(advice, F.lit("")).alias("recommendation"),
    )
