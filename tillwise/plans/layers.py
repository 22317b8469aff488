"""The batch run: every layer as a function of the commerce tables and an output folder.

A layer builds lazy DataFrames and acts only at its sinks. Results a later layer needs
(daily series, scored customers) are read back from what was written.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import anomaly, churn, cohort, facts, forecast, rfm, sentiment
from ..sources.files import write_csv, write_parquet
from ..sources.tables import Tables

log = logging.getLogger(__name__)
#: Partition column of results by month that have no column of that kind.
PART = "part_month"


@dataclass
class Output:
    """Named results below a folder, as parquet (or CSV for small report tables)."""

    folder: str
    store: Tables | None = None  # where results are named as tables, if anywhere

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(
        self, name: str, df: DataFrame, partition_by: tuple[str, ...] = (), only_partitions: bool = False
    ) -> DataFrame:
        """With only_partitions, partitions that df has no rows of stay as they are."""
        write_parquet(df, self.path(name), partition_by, only_partitions)
        log.info("wrote %s", name)
        if self.store is not None:
            self.store.attach(name, self.path(name))
        return self.load(df.sparkSession, name)

    def export(self, name: str, df: DataFrame) -> None:
        write_csv(df, self.path(f"{name}_csv"))

    def load(self, spark, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))


def ingest(tables, out: Output, months: list[tuple[int, int]] | None = None) -> None:
    """Master dataset, category revenue and daily series, all by month.

    With months, only the orders of these (year, month) are read and only their partitions are replaced: what a
    rerun after a correction needs.
    """
    part = tables if months is None else tables.of_months(months)
    only = months is not None
    out.save("master_dataset", facts.master_dataset(part), ("year", "month"), only)
    out.save("category_revenue", facts.category_month_revenue(part).withColumn(PART, F.date_format("month_year", "yyyy-MM")), (PART,), only)
    daily = facts.daily_series(part).withColumn(PART, F.date_format("date", "yyyy-MM"))
    out.save("daily_revenue", daily, (PART,), only)


def customers(tables, out: Output, k: int | None = None) -> None:
    """RFM scores, segments and clusters."""
    scored = out.save("rfm_segments", rfm.with_actions(rfm.cluster(rfm.rfm_segments(tables), k)))
    out.export("segment_summary", rfm.segment_summary(scored))


def anomalies(tables, out: Output, contamination: float | None = 0.05) -> None:
    """Flagged days, root causes of all of them, alerts."""
    daily = out.load(tables.spark, "daily_revenue").drop(PART)
    detected = out.save("anomaly_detection", anomaly.detect(daily, contamination=contamination))
    flagged = detected.where("is_anomaly").select("date")
    causes = out.save("root_cause", anomaly.root_cause(anomaly.dimension_days(tables, flagged), flagged))
    out.export("anomaly_alerts", anomaly.anomaly_alerts(detected, causes))


def forecasts(tables, out: Output, horizon: int = 30, **boosting) -> None:
    """Seasonal, boosted and combined forecasts, and their backtest."""
    daily = out.load(tables.spark, "daily_revenue").drop(PART)

    def combined(history: DataFrame) -> DataFrame:
        return forecast.ensemble(
            forecast.seasonal_forecast(history, horizon),
            forecast.boosted_forecast(history, horizon, **boosting),
        )

    out.save("revenue_forecast", combined(daily))
    train, test = forecast.split_last(daily, horizon)
    tried = combined(train)
    columns = ["seasonal_forecast", "boosted_forecast", "ensemble_forecast"]
    compared = out.save(
        "forecast_backtest",
        forecast.backtest(test, {c: tried.withColumn("forecast", F.col(c)) for c in columns}),
    )
    out.export("backtest_metrics", forecast.backtest_metrics(compared, columns))


def cohorts(tables, out: Output, folds: int = 5, **boosting) -> None:
    """Retention, lifetime value, churn features, model metrics and scores."""
    activity = cohort.cohort_activity(tables)
    long = out.save("cohort_retention", cohort.cohort_retention(activity))
    out.save("cohort_ltv", cohort.cohort_ltv(activity))
    out.export("cohort_summary", cohort.summary(long))
    features = out.save("churn_features", churn.churn_features(tables))
    model, metrics = churn.churn_model(features, folds=folds, **boosting)
    out.export("churn_metrics", metrics)
    out.save("churn_predictions", churn.churn_scores(model, features))
    out.save("churn_attribution", churn.churn_attribution(features))


def reviews(tables, out: Output) -> None:
    """Sentiment of every review, trend and summary."""
    source = getattr(tables, "review_texts", None)
    analyzed = sentiment.analyze_reviews(tables.reviews if source is None else source)
    scored = out.save("sentiment_analysis", analyzed)
    out.export("sentiment_trend", sentiment.sentiment_trend(scored))


LAYERS: dict[str, Callable] = {
    "ingest": ingest,
    "rfm": customers,
    "anomaly": anomalies,
    "forecast": forecasts,
    "cohort": cohorts,
    "sentiment": reviews,
}


def run_all(
    tables, folder: str, layers: list[str] | None = None, months: list[tuple[int, int]] | None = None
) -> Output:
    """All or some layers; the results are named in the catalogue. With months the ingest layer redoes only these."""
    out = Output(folder, Tables(tables.spark, f"{folder}/tables"))
    for name in layers or LAYERS:
        if name == "ingest":
            ingest(tables, out, months)
        else:
            LAYERS[name](tables, out)
    return out
