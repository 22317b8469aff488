"""Daily revenue forecasting: features, baselines with intervals, boosted trees, backtests.

Every function works for one series or, with `series` key columns, for many at once:
windows are partitioned by the key and one boosted model serves all series and horizons.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import cyclic, series_calendar
from ..functions.rounding import round_half_up
from ..session import materialize, packed

LAGS = (1, 2, 3, 7, 14, 28)
WINDOWS = (3, 7, 14, 30)
SEASON = 7


def _ordered(series: Sequence[str]):
    return Window.partitionBy(*series).orderBy("date")


def _history_columns(
    target: str, series: Sequence[str], lags: Sequence[int], windows: Sequence[int], shift: int
) -> dict[str, Column]:
    """Lags, trailing statistics and momentum; shift=1 looks back from the day itself,
    shift=0 from the day after (the forecast origin)."""
    w = _ordered(series)
    y = F.col(target)
    back = lambda n: F.lag(y, n - 1 + shift).over(w) if n - 1 + shift else y
    columns = {f"lag_{n}": back(n) for n in lags}
    for n in windows:
        frame = w.rowsBetween(1 - n - shift, -shift)
        full = F.count(y).over(frame) == n
        for name, aggregate in (
            ("mean", F.avg), ("std", F.stddev_samp), ("max", F.max), ("min", F.min),
        ):
            columns[f"roll_{name}_{n}"] = F.when(full, aggregate(y).over(frame))
    for n in (7, 30):
        columns[f"mom_{n}"] = F.try_divide(back(1), F.nullif(back(n + 1), F.lit(0.0))) - 1.0
    return columns


def _calendar_columns(date: Column) -> dict[str, Column]:
    days = series_calendar(date)
    return {**days, **cyclic(days["month"], days["day_of_week"])}


def ts_features(
    daily: DataFrame,
    target: str = "total_revenue",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    series: Sequence[str] = (),
) -> DataFrame:
    """Calendar, cyclic, lag, trailing and momentum features of each day.

    Trailing statistics end the day before and are NULL until their window is full.
    """
    return daily.withColumns(
        {
            **_calendar_columns(F.col("date")),
            **_history_columns(target, series, lags, windows, shift=1),
        }
    )


HISTORY = (
    [f"lag_{n}" for n in LAGS]
    + [f"roll_{s}_{n}" for n in WINDOWS for s in ("mean", "std", "max", "min")]
    + ["mom_7", "mom_30"]
)
CALENDAR = [
    "day_of_week", "day_of_month", "week_of_year", "month", "quarter", "year", "is_weekend",
    "is_month_start", "is_month_end", "month_sin", "month_cos", "dow_sin", "dow_cos",
]


def _boosted(inputs: Sequence[str], trees: int, depth: int, rate: float, subsample: float, seed: int):
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(inputs), outputCol="features"),
            GBTRegressor(
                labelCol="label", maxIter=trees, maxDepth=depth, stepSize=rate,
                subsamplingRate=subsample, seed=seed, predictionCol="_predicted",
            ),
        ]
    )


def _errors(pairs: DataFrame, actual: Column, predicted: Column, by: Sequence[str] = ()) -> DataFrame:
    error = F.abs(actual - predicted)
    return pairs.groupBy(*by).agg(
        F.avg(error).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(error / F.greatest(actual, F.lit(1.0))) * 100.0).alias("mape"),
    )


def boosted_metrics(
    daily: DataFrame,
    trees: int = 300,
    depth: int = 5,
    rate: float = 0.05,
    subsample: float = 0.8,
    holdout: int = 30,
    seed: int = 42,
) -> tuple[object, DataFrame]:
    """One-step boosted model; trained on the earlier rows, judged on the hold-out.

    The hold-out is the last 30 rows, or the last fifth of a short series. Inputs are
    calendar and lags only (nothing that is unknown on the forecast day).
    """
    inputs = [*CALENDAR, *HISTORY]
    rows = materialize(ts_features(daily), "boosted-features").dropna(subset=HISTORY)
    rows = rows.withColumns(
        {
            "_row": F.row_number().over(Window.orderBy("date")),
            "_n": F.count(F.lit(1)).over(Window.partitionBy()),
            "label": F.col("total_revenue"),
        }
    )
    split = F.greatest(F.col("_n") - holdout, F.floor(F.col("_n") * 0.8))
    rows = materialize(rows.withColumn("_train", F.col("_row") <= split), "boosted-rows")
    known = packed(rows.where("_train")).persist()
    model = _boosted(inputs, trees, depth, rate, subsample, seed).fit(known)
    known.unpersist()
    judged = model.transform(rows.where("NOT _train"))
    metrics = _errors(judged, F.col("label"), F.greatest("_predicted", F.lit(0.0)))
    return model, metrics.select(*[F.round(c, 2).alias(c) for c in ("mae", "rmse", "mape")])


def boosted_forecast(
    daily: DataFrame,
    horizon: int = 30,
    series: Sequence[str] = (),
    trees: int = 300,
    depth: int = 5,
    rate: float = 0.05,
    subsample: float = 0.8,
    seed: int = 42,
) -> DataFrame:
    """Direct multi-step forecast: the horizon is a feature, so one fit and one
    transform give all steps of all series (no loop that feeds predictions back)."""
    w = _ordered(series)
    y = F.col("total_revenue")
    ahead = F.array(
        *[
            F.struct(F.lit(h).alias("step"), F.lead(y, h).over(w).alias("label"))
            for h in range(1, horizon + 1)
        ]
    )
    history = daily.withColumns(
        {
            **_history_columns("total_revenue", series, LAGS, WINDOWS, shift=0),
            "_ahead": ahead,
            "_last": F.row_number().over(
                Window.partitionBy(*series).orderBy(F.desc("date"))
            ) == 1,
        }
    )
    # Written before it is filtered: planning the long feature expressions through the
    # filters takes longer than computing them. The window of a single series is one
    # task, so its rows are spread before they are multiplied.
    history = (
        materialize(history, "forecast-history")
        .dropna(subset=HISTORY)
        .repartition(daily.sparkSession.sparkContext.defaultParallelism)
    )
    rows = (
        history.select(*series, "date", "_last", *HISTORY, F.explode("_ahead").alias("_a"))
        .select("*", "_a.*")
        .withColumn("date", F.date_add("date", F.col("step")))
        .drop("_a")
        .withColumns(_calendar_columns(F.col("date")))
    )
    rows = materialize(rows, "forecast-rows")
    inputs = ["step", *CALENDAR, *HISTORY]
    known = packed(rows.where(F.col("label").isNotNull())).persist()
    model = _boosted(inputs, trees, depth, rate, subsample, seed).fit(known)
    known.unpersist()
    return model.transform(rows.where("_last")).select(
        *series, "step", "date", F.greatest("_predicted", F.lit(0.0)).alias("forecast")
    )


def naive_forecast(
    daily: DataFrame, horizon: int = 30, series: Sequence[str] = (), width: float = 1.28
) -> DataFrame:
    """The last level for every step; the band is the deviation of the last 30 rows."""
    newest = Window.partitionBy(*series).orderBy(F.desc("date"))
    y = F.col("total_revenue")
    placed = daily.withColumn("_age", F.row_number().over(newest))
    recent = F.when(F.col("_age") <= 30, y)
    ends = placed.groupBy(*series).agg(
        F.max("date").alias("_end"),
        F.max_by(y, "date").alias("forecast"),
        F.when(F.count(F.lit(1)) > 30, F.stddev_pop(recent)).otherwise(0.0).alias("_sd"),
    )
    return _steps(ends, horizon, series).select(
        *series,
        "step",
        F.date_add("_end", F.col("step")).alias("date"),
        "forecast",
        F.greatest(F.col("forecast") - width * F.col("_sd"), F.lit(0.0)).alias("lower"),
        (F.col("forecast") + width * F.col("_sd")).alias("upper"),
    )


def _steps(ends: DataFrame, horizon: int, series: Sequence[str]) -> DataFrame:
    return ends.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))


def seasonal_forecast(
    daily: DataFrame, horizon: int = 30, series: Sequence[str] = (), width: float = 1.28
) -> DataFrame:
    """Value one season ago plus the mean seasonal change; the band grows with the
    number of seasons ahead."""
    w = _ordered(series)
    y = F.col("total_revenue")
    placed = daily.withColumns(
        {
            "_change": y - F.lag(y, SEASON).over(w),
            "_age": F.row_number().over(Window.partitionBy(*series).orderBy(F.desc("date"))),
        }
    )
    last_season = [
        F.max(F.when(F.col("_age") == SEASON - i, y)).alias(f"_s{i}") for i in range(SEASON)
    ]
    ends = placed.groupBy(*series).agg(
        F.max("date").alias("_end"),
        F.max_by(y, "date").alias("_level"),
        F.coalesce(F.avg("_change"), F.lit(0.0)).alias("_drift"),
        F.coalesce(F.stddev_samp("_change"), F.lit(0.0)).alias("_sd"),
        *last_season,
    )
    ahead = F.ceil(F.col("step") / SEASON)
    # a series shorter than one season falls back to its last value
    base = F.coalesce(
        F.element_at(
            F.array(*[F.col(f"_s{i}") for i in range(SEASON)]),
            (F.col("step") - 1) % SEASON + 1,
        ),
        F.col("_level"),
    )
    point = F.greatest(base + ahead * F.col("_drift"), F.lit(0.0))
    band = width * F.col("_sd") * F.sqrt(ahead)
    return (
        _steps(ends, horizon, series)
        .withColumn("forecast", point)
        .select(
            *series,
            "step",
            F.date_add("_end", F.col("step")).alias("date"),
            "forecast",
            F.greatest(F.col("forecast") - band, F.lit(0.0)).alias("lower"),
            (F.col("forecast") + band).alias("upper"),
        )
    )


def ensemble(
    seasonal: DataFrame,
    boosted: DataFrame,
    series: Sequence[str] = (),
    weights: tuple[float, float] = (0.4, 0.6),
) -> DataFrame:
    """Weighted mean of both forecasts; the seasonal band is scaled to it."""
    both = seasonal.withColumnRenamed("forecast", "seasonal_forecast").join(
        boosted.select(*series, "step", F.col("forecast").alias("boosted_forecast")),
        [*series, "step"],
    )
    mixed = weights[0] * F.col("seasonal_forecast") + weights[1] * F.col("boosted_forecast")
    scale = F.col("ensemble_forecast") / F.greatest("seasonal_forecast", F.lit(1.0))
    return both.withColumn("ensemble_forecast", mixed).select(
        *series,
        "step",
        "date",
        "seasonal_forecast",
        "boosted_forecast",
        "ensemble_forecast",
        F.greatest(F.col("lower") * scale, F.lit(0.0)).alias("lower_80"),
        (F.col("upper") * scale).alias("upper_80"),
    )


def split_last(daily: DataFrame, test_rows: int = 30, series: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(train, test): the last rows of each series become the test, numbered by `step`."""
    newest = Window.partitionBy(*series).orderBy(F.desc("date"))
    placed = daily.withColumn("_age", F.row_number().over(newest))
    train = placed.where(F.col("_age") > test_rows).drop("_age")
    test = placed.where(F.col("_age") <= test_rows)
    order = Window.partitionBy(*series).orderBy("date")
    return train, test.withColumn("step", F.row_number().over(order)).drop("_age")


def backtest(
    test: DataFrame, forecasts: dict[str, DataFrame], series: Sequence[str] = ()
) -> DataFrame:
    """Actual against each forecast, one row per test day."""
    out = test.select(*series, "date", "step", "total_revenue")
    for name, forecast in forecasts.items():
        out = out.join(
            forecast.select(*series, "step", F.col("forecast").alias(name)), [*series, "step"]
        )
    return out


def backtest_metrics(compared: DataFrame, models: Sequence[str]) -> DataFrame:
    stacked = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(m).alias("predicted")) for m in models]
    )
    pairs = compared.select("total_revenue", F.explode(stacked).alias("_m")).select(
        "total_revenue", "_m.*"
    )
    return _errors(pairs, F.col("total_revenue"), F.col("predicted"), ["model"])


def forecast_summary(
    forecast: DataFrame, metrics: DataFrame | None = None, column: str = "forecast"
) -> DataFrame:
    """Sum of the next 7 and 30 steps, and 100 - MAPE when metrics (one row) are given."""
    total = lambda n: F.sum(F.when(F.col("step") <= n, F.col(column)))
    sums = forecast.agg(total(7).alias("next_7_days"), total(30).alias("next_30_days"))
    if metrics is None:
        return sums
    from .kpis import one_row

    accuracy = metrics.select((100.0 - F.col("mape")).alias("accuracy_pct"))
    return one_row([sums, accuracy])


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: round_half_up(F.col(c), digits) for c in columns})
