"""Statistics over many series: publication lags, revisions, stationarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.calendar import resample_last
from tidemark.operators.transforms import diff, pct_change_rows
from tidemark.operators.windows import by_date


ADF_SCHEMA = (
    "series_id string, n int, start_date date, end_date date, used_lag int, adf_stat double, p_value double, verdict string"
)


def _first_and_last(vintages: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """First and latest release per data date in one combinable aggregation; ``ties`` orders releases of one day."""
    order = F.struct("realtime_start", *ties) if ties else F.col("realtime_start")
    return vintages.groupBy("series_id", "date").agg(
        F.min("realtime_start").alias("effective_date"),
        F.min_by("value", order).alias("first_value"),
        F.max_by("value", order).alias("latest_value"),
    )


def _revised(first: str = "first_value", latest: str = "latest_value"):
    """1 when both are present and differ at 4 digits, 0 when equal, NULL when one is missing."""
    return (F.round(first, 4) != F.round(latest, 4)).cast("double")


def revision_rate(vintages: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Share of data dates whose first and latest release differ."""
    return (
        _first_and_last(vintages, ties)
        .withColumn("revised", _revised())
        .groupBy("series_id")
        .agg(F.count("revised").alias("n_both"), F.avg("revised").alias("revised_share"))
    )


def lag_sweep(vintages: DataFrame, registry: DataFrame, since: str | None = None, default_lag: int = 1, ties: Sequence[str] = ()) -> DataFrame:
    """Measured against configured publication lag for every registered series.

    Measures data dates from ``since`` on: count, median and 90th percentile of
    days to first release (truncated to whole days), share revised.  A series
    without a configured lag is compared with ``default_lag``.
    """
    ends = _first_and_last(vintages, ties)
    recent = F.lit(True) if since is None else F.col("date") >= F.to_date(F.lit(since))
    lag_days = F.when(recent, F.datediff("effective_date", "date"))
    measured = (
        ends.withColumns({"lag_days": lag_days, "revised": F.when(recent, _revised())})
        .groupBy("series_id")
        .agg(
            F.count("lag_days").alias("n"),
            F.median("lag_days").cast("int").alias("median_lag"),
            # Interpolation may land a hair below a whole day; that is not a day less.
            F.round(F.percentile("lag_days", 0.9), 6).cast("int").alias("p90_lag"),
            F.round(F.avg("revised") * 100.0, 1).alias("revised_pct"),
        )
    )
    rows = registry.join(measured, "series_id", "left")
    status = (
        F.when(F.col("n").isNull(), F.lit("NO-VINTAGE"))
        .when(F.col("n") == 0, F.lit("NO-RECENT-PERIOD"))
        .otherwise(F.lit("OK"))
    )
    return rows.select(
        "series_id",
        F.col("frequency").alias("freq"),
        status.alias("status"),
        F.coalesce("n", F.lit(0)).alias("n"),
        "median_lag",
        "p90_lag",
        F.col("lag").alias("config_lag"),
        (F.col("median_lag") - F.coalesce("lag", F.lit(default_lag))).alias("gap_vs_config"),
        "revised_pct",
        "is_vintage",
    )


def df_tstat(panel: DataFrame) -> DataFrame:
    """Dickey-Fuller t-statistic with constant and no lagged differences, all in aggregates."""
    pairs = panel.where(F.col("value").isNotNull()).select(
        "series_id", F.col("value"), F.lag("value").over(by_date()).alias("x")
    )
    sums = (
        pairs.withColumn("dy", F.col("value") - F.col("x"))
        .groupBy("series_id")
        .agg(
            F.regr_count("dy", "x").alias("n"),
            F.regr_slope("dy", "x").alias("slope"),
            F.regr_sxx("dy", "x").alias("sxx"),
            F.regr_sxy("dy", "x").alias("sxy"),
            F.regr_syy("dy", "x").alias("syy"),
        )
    )
    resid_var = F.try_divide(F.col("syy") - F.col("slope") * F.col("sxy"), F.col("n") - 2)
    t = F.try_divide(F.col("slope"), F.sqrt(F.try_divide(resid_var, F.col("sxx"))))
    return sums.select("series_id", F.col("n").cast("bigint").alias("n"), "slope", t.alias("t_stat"))


def adf_screen(panel: DataFrame, min_n: int = 60) -> DataFrame:
    """Augmented Dickey-Fuller test with constant for every series, lag chosen by AIC.

    Series are independent and in panel form at most one row per calendar day,
    so each is one small least-squares task; Spark spreads the series.  Shorter
    series than ``min_n`` are reported as skipped.
    """

    def test_one(key, rows):
        import math

        import numpy as np
        import pandas as pd

        # Published response-surface polynomials for the p-value of
        # a one-series test with constant (MacKinnon 1994).
        tau_max, tau_min, tau_star = 2.74, -18.83, -1.61
        small_p = [2.1659, 1.4412, 0.038269]
        large_p = [1.7339, 0.93202, -0.12745, -0.010368]

        rows = rows.sort_values("date")
        y = rows["value"].to_numpy(dtype=float)
        n = len(y)
        out = {
            "series_id": key[0], "n": n, "start_date": None, "end_date": None,
            "used_lag": None, "adf_stat": None, "p_value": None, "verdict": f"SKIP: n<{min_n}",
        }
        if n >= min_n:
            out["start_date"], out["end_date"] = rows["date"].iloc[0], rows["date"].iloc[-1]
            dy = np.diff(y)
            max_lag = min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2)

            def design(p, skip):
                """Regressors (level, constant, p lagged differences) after ``skip`` differences."""
                at = np.arange(skip, len(dy))
                lagged = [dy[at - j] for j in range(1, p + 1)]
                return np.column_stack([y[at], np.ones(len(at)), *lagged]), dy[at]

            def rss(x, target):
                beta, *_ = np.linalg.lstsq(x, target, rcond=None)
                return float(np.sum((target - x @ beta) ** 2)), beta

            # Every candidate is judged on the sample the longest one allows.
            wide, target = design(max_lag, max_lag)
            obs = len(target)
            best, best_aic = 0, math.inf
            for p in range(max_lag + 1):
                err, _ = rss(wide[:, : p + 2], target)
                aic = obs * math.log(err / obs) + 2 * (p + 2) if err > 0 else -math.inf
                if aic < best_aic:
                    best, best_aic = p, aic
            x, target = design(best, best)
            err, beta = rss(x, target)
            spread = err / (len(target) - x.shape[1]) * np.linalg.pinv(x.T @ x)[0, 0]
            if spread > 0:
                stat = float(beta[0] / math.sqrt(spread))
                if stat > tau_max:
                    p_value = 1.0
                elif stat < tau_min:
                    p_value = 0.0
                else:
                    coef = small_p if stat <= tau_star else large_p
                    score = sum(c * stat**i for i, c in enumerate(coef))
                    p_value = 0.5 * math.erfc(-score / math.sqrt(2.0))
                out.update(
                    used_lag=best, adf_stat=stat, p_value=p_value,
                    verdict="stationary" if p_value < 0.05 else "non-stationary",
                )
            else:
                out["verdict"] = "SKIP: no variation"
        return pd.DataFrame([out])

    valued = panel.where(F.col("value").isNotNull()).select("series_id", "date", "value")
    return valued.groupBy("series_id").applyInPandas(test_one, ADF_SCHEMA)


def recommend_window(screen: DataFrame) -> DataFrame:
    """Window form a level series should be normalised with."""
    choice = F.when(F.col("verdict") == "stationary", F.lit("expanding")).when(
        F.col("verdict") == "non-stationary", F.lit("rolling(252d)")
    )
    return screen.withColumn("recommendation", F.coalesce(choice, F.lit("")))


def monthly_change(panel: DataFrame) -> DataFrame:
    """Month-end values with their difference and change in percent to the previous month row."""
    monthly = resample_last(panel, "ME")
    return pct_change_rows(diff(monthly), 1, "pct")
