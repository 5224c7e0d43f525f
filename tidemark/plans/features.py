"""Registry-driven transforms over all series at once.

The plan does not grow with the registry: one pass over the panel's own rows,
and one pass over native-frequency rows in which every series brings its own
frequency and window lengths along as columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.dates import PERIODS_PER_YEAR
from tidemark.functions.names import SUFFIX
from tidemark.functions.numeric import pct_change
from tidemark.operators import runs as R
from tidemark.operators.asof import calendar_side, series_tasks, spread_on_days, validity
from tidemark.operators.calendar import to_native
from tidemark.operators.transforms import frequency_check, rolling_zscore, window_rows
from tidemark.operators.windows import by_date, expanding_moments

MODES = {"mon": "mon_transforms", "fm": "fm_transforms"}
ROLLING_YEARS = {"zscore_rolling_1y": 1, "zscore_rolling_3y": 3, "zscore_rolling_5y": 5}
NATIVE = ("diff", "yoy", "zscore_expanding")
ROW_COUNTED = ("pct_change_1m", "diff_bps")


@dataclass(frozen=True)
class OwnTransform:
    """A transform defined by the caller, used in the registry by its name.

    ``build`` gets the value column and the window of a series in date order and
    returns a column; it must read rows up to the current one only.  ``counts``
    says what a row is: ``native``, a period of the series' own frequency, or
    ``rows``, a day of the panel with the last value carried forward.
    """

    suffix: str
    build: Callable[[Column, WindowSpec], Column]
    counts: str = "native"

    def __post_init__(self):
        if self.counts not in ("native", "rows"):
            raise ValueError(f"a transform counts 'native' periods or 'rows', got {self.counts!r}")


def _own_of(own: Mapping[str, OwnTransform], counts: str) -> dict[str, OwnTransform]:
    return {name: t for name, t in own.items() if t.counts == counts}


def _wants(*names: str) -> Column:
    return F.arrays_overlap("transforms", F.array(*[F.lit(n) for n in names]))


def _has(name: str) -> Column:
    return F.array_contains("transforms", name)


def _checked(transforms: str, own: Mapping[str, OwnTransform]) -> Column:
    """The transform list, failing the job on a name nobody implements."""
    unknown = F.array_except(F.col(transforms), F.array(*[F.lit(n) for n in (*SUFFIX, *own)]))
    message = F.concat(F.lit("unknown transform for "), F.col("series_id"), F.lit(": "), F.array_join(unknown, ","))
    return F.when(F.size(unknown) > 0, F.raise_error(message).cast("array<string>")).otherwise(F.col(transforms))


def _collect_long(df: DataFrame, named: dict[str, tuple[Column, Column]], *keep: str) -> DataFrame:
    """One output row per wanted transform: ``{suffix: (is wanted, value)}``."""
    items = [F.struct(F.when(wanted, F.lit(suffix)).alias("transform"), value.alias("value")) for suffix, (wanted, value) in named.items()]
    return df.select("series_id", "date", *keep, F.inline(F.array(*items))).where(F.col("transform").isNotNull())


def _with_id(rows: DataFrame) -> DataFrame:
    """Rows with an id, as a column that cannot be missing: only then Spark takes all parts of a union as lying by series
    alike, also those that share a shuffle.  Registered series have one."""
    return rows.where(F.col("series_id").isNotNull()).withColumn("series_id", F.coalesce("series_id", F.lit("")))


def _native_transforms(
    panel: DataFrame | None, spec: DataFrame, lag: int, end: Column, month_rule: str, own: Mapping[str, OwnTransform], runs: DataFrame | None
) -> DataFrame:
    """Transforms of native-frequency rows, labelled with the days they are the latest for.

    Series without a rolling window take running statistics and offsets only.
    Of the others each row is handed to one task per rolling window its series
    asks for before anything is sorted, so all passes share the order by
    (series, task); the first task brings the other transforms along.
    """
    own = _own_of(own, "native")
    plain_names = (*NATIVE, *own)
    rolling = F.coalesce(_wants(*ROLLING_YEARS), F.lit(False))

    def native(wanted: DataFrame) -> DataFrame:
        return to_native(panel, wanted, ["transforms"], month_rule) if runs is None else R.to_native(runs, wanted, ["transforms"], month_rule)

    def with_plain(periods: DataFrame, key: list[str]) -> DataFrame:
        value, freq = F.col("value"), F.col("frequency")
        base, need = F.lit(None).cast("double"), F.lit(None).cast("int")
        for f, n in PERIODS_PER_YEAR.items():
            base = F.when(freq == f, F.lag("value", n).over(by_date(key))).otherwise(base)
            need = F.when(freq == f, F.lit(n)).otherwise(need)
        previous = F.lag("value", 1).over(by_date(key))
        z = F.when(F.col("exp_n") >= need, F.try_divide(value - F.col("exp_mean"), F.col("exp_std")))
        return (
            expanding_moments(validity(periods, "date", end=end, key=key), lag, by=key)
            .withColumns({"__diff": value - previous, "__yoy": pct_change(value, base), "__exp_z": z})
            .withColumns({f"__own{i}": t.build(value, by_date(key)) for i, t in enumerate(own.values())})
            .drop("exp_n", "exp_mean", "exp_std")
        )

    def named(shown: Column) -> dict[str, tuple[Column, Column]]:
        out = {
            SUFFIX["diff"]: (shown & _has("diff"), F.col("__diff")),
            SUFFIX["yoy"]: (shown & _has("yoy"), F.col("__yoy")),
            SUFFIX["zscore_expanding"]: (shown & _has("zscore_expanding"), F.col("__exp_z")),
        }
        return out | {t.suffix: (shown & _has(name), F.col(f"__own{i}")) for i, (name, t) in enumerate(own.items())}

    plain = _collect_long(with_plain(native(spec.where(_wants(*plain_names) & ~rolling)), ["series_id"]), named(F.lit(True)), "valid_to")

    tasks = F.array_compact(F.array(*[F.when(_has(name), F.lit(years)) for name, years in ROLLING_YEARS.items()]))
    periods = native(spec.where(rolling)).select("*", F.posexplode(tasks).alias("__place", "task"))
    sized = with_plain(periods, ["series_id", "task"]).withColumn("__rows", window_rows(F.col("frequency"), F.col("task")))
    widths = [round(n * years) for n in PERIODS_PER_YEAR.values() for years in ROLLING_YEARS.values()]
    done = rolling_zscore(sized, "__rows", lag=lag, by=["series_id", "task"], widths=widths)
    windows = {SUFFIX[name]: (F.col("task") == years, F.col("z")) for name, years in ROLLING_YEARS.items()}
    return plain.unionByName(_collect_long(done, named(F.col("__place") == 0) | windows, "valid_to"))


def _row_transforms(
    panel: DataFrame | None, spec: DataFrame, grid: DataFrame, end: Column, own: Mapping[str, OwnTransform], runs: DataFrame | None
) -> DataFrame:
    """Transforms counting the rows of the panel's date index.

    The index is that of all series together: a day another series was observed
    on is a row here too, holding nothing new.
    """
    own = _own_of(own, "rows")
    wanted = spec.where(_wants(*ROW_COUNTED, *own)).select("series_id", "transforms").hint("shuffle_hash")
    if runs is None:
        valued = panel.where(F.col("value").isNotNull()).join(wanted, "series_id")
        held, seen = validity(valued, "date", end=end), F.col("day") == F.col("date")
    else:
        # The days of a run are rows of the panel; those up to the next run are filled.
        valued = R.with_weekdays(runs.where(F.col("value").isNotNull())).join(wanted, "series_id").withColumnRenamed("__lo", "date")
        held, seen = validity(valued, "date", end=end), F.col("day") <= F.col("__hi")
    rows = (
        spread_on_days(held, "date", "day")
        .join(calendar_side(grid, name="day"), "day", "left_semi")
        .withColumn("observed", F.when(seen, F.col("value")))
        .select("series_id", "transforms", F.col("day").alias("date"), F.col("value").alias("filled"), "observed")
    )
    pct = pct_change(F.col("filled"), F.lag("filled", 21).over(by_date()))
    bps = (F.col("observed") - F.lag("observed", 1).over(by_date())) * 100.0
    rows = rows.withColumns({"__pct": pct, "__bps": bps} | {f"__own{i}": t.build(F.col("filled"), by_date()) for i, t in enumerate(own.values())})
    named = {SUFFIX["pct_change_1m"]: (_has("pct_change_1m"), F.col("__pct")), SUFFIX["diff_bps"]: (_has("diff_bps"), F.col("__bps"))}
    return _collect_long(rows, named | {t.suffix: (_has(name), F.col(f"__own{i}")) for i, (name, t) in enumerate(own.items())})


def _frequency_kept(panel: DataFrame, spec: DataFrame, tasks: int) -> DataFrame:
    """``spec``, failing the job on a rolling window asked for a series whose dates contradict its declared frequency.

    The dates are those of the data: ``obs_date`` where the panel is already
    held over a grid, else ``date``.
    """
    observed = "obs_date" if "obs_date" in panel.columns else "date"
    dates = panel.where(F.col("value").isNotNull()).select("series_id", F.col(observed).alias("date"), "value")
    dates = dates.repartition(tasks, "series_id").groupBy("series_id", "date").agg(F.first("value").alias("value"))
    found = frequency_check(dates, spec).select("series_id", "median_gap", "expected_gap", "ok")
    message = F.concat_ws(
        "", F.lit("series "), "series_id", F.lit(" is declared "), "frequency", F.lit(" but its dates are "),
        F.col("median_gap").cast("string"), F.lit(" days apart (median)"),
    )
    wrong = _wants(*ROLLING_YEARS) & ~F.coalesce("ok", F.lit(True))
    kept = F.when(wrong, F.raise_error(message).cast("array<string>")).otherwise(F.col("transforms"))
    return spec.join(found, "series_id", "left").select("series_id", "frequency", kept.alias("transforms"))


def with_checked_frequency(registry: DataFrame, dates: DataFrame, transforms: str) -> DataFrame:
    """``registry`` whose list ``transforms`` fails the job that reads it, if a rolling window there contradicts the data.

    ``dates`` is a panel of data dates; several rows of one date count once.
    The check runs as part of the pass that uses the list.
    """
    spec = registry.select("series_id", "frequency", F.col(transforms).alias("transforms"))
    kept = _frequency_kept(dates, spec, series_tasks(registry))
    columns = [F.col("__kept").alias(c) if c == transforms else F.col(c) for c in registry.columns]
    return registry.join(kept.select("series_id", F.col("transforms").alias("__kept")), "series_id").select(*columns)


def apply_transforms(
    panel: DataFrame,
    registry: DataFrame,
    mode: str,
    lag: int = 0,
    month_rule: str = "ME",
    check_frequency: bool = True,
    own: Mapping[str, OwnTransform] | None = None,
    runs: DataFrame | None = None,
) -> DataFrame:
    """All configured transforms of all registered series, long: ``series_id, transform, date, value``.

    ``mode`` picks the list: ``mon`` (monitoring) or ``fm`` (features).  ``lag``
    moves the windows of z-scores back and nothing else.  Every registered series
    also yields its level.  Values computed at native frequency are held over the
    panel's dates from the end of their period on, so none shows early.  The
    panel is read several times: pass a stored one, not a long computation.

    A rolling window asked for a series whose dates contradict its declared
    frequency fails the job; ``check_frequency=False`` is for irregular series
    that are meant to be resampled.  ``own`` adds transforms by name; they take
    part in the same passes.  Names and suffixes of the given ones are refused.

    ``runs`` are the runs whose days the panel holds (``pit_runs``): periods are
    then counted on them, and the days of a held value are not shuffled.

    Every pass works on so many series a task, whatever their number.
    """
    own = dict(own or {})
    taken = set(own) & set(SUFFIX) | {t.suffix for t in own.values()} & set(SUFFIX.values())
    if taken or len({t.suffix for t in own.values()}) < len(own):
        raise ValueError(f"names and suffixes of own transforms must be new and distinct: {sorted(taken)}")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {sorted(MODES)}, got {mode!r}")
    if mode == "fm" and month_rule != "ME":
        raise ValueError(f"month rule {month_rule!r} shows a month before it is over; features need 'ME'")
    spec = registry.select("series_id", "frequency", _checked(MODES[mode], own).alias("transforms"))
    tasks = series_tasks(registry)
    if check_frequency:
        spec = _frequency_kept(panel, spec, tasks)
    listed = registry.select("series_id").repartition(tasks, "series_id").distinct().hint("shuffle_hash")
    if runs is not None:
        alive = R.with_weekdays(runs)
        grid, end = R.grid(alive), alive.agg(F.max("__hi")).scalar()
        runs, placed = _with_id(alive).select(*R.RUN).repartition(tasks, "series_id"), None
        levels = R.spread(runs.join(listed, "series_id"))
    else:
        grid, end = panel.select("date"), panel.agg(F.max("date")).scalar()
        placed = _with_id(panel).select("series_id", "date", "value").repartition(tasks, "series_id")
        levels = placed.join(listed, "series_id")
    labelled = _native_transforms(placed, spec, lag, end, month_rule, own, runs)
    held = (
        spread_on_days(labelled, "date", "day")
        .join(calendar_side(grid, name="day"), "day", "left_semi")
        .select("series_id", "transform", F.col("day").alias("date"), "value")
    )
    counted = _row_transforms(placed, spec, grid, end, own, runs).select("series_id", "transform", "date", "value")
    levels = levels.select("series_id", F.lit("level").alias("transform"), "date", "value")
    return levels.unionByName(counted).unionByName(held)
