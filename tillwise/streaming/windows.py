"""Windowed KPIs on event streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.trailing import _folded, _kpis


def stream_window_kpis(
    events: DataFrame,
    window_seconds: int = 300,
    slide_seconds: int = 60,
    delay: str = "10 minutes",
    ts: str = "ts",
) -> DataFrame:
    """Sliding-window KPIs. In append mode a window is emitted once the watermark has passed its end;
    in update mode also before, each time it changes (`merged.MergedTable` then keeps its last state)."""
    spans = F.window(ts, f"{window_seconds} seconds", f"{slide_seconds} seconds")
    return (
        events.withWatermark(ts, delay)
        .groupBy(spans.alias("_w"))
        .agg(*_folded(F.col("revenue")))
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *[c.alias(k) for k, c in _kpis(window_seconds).items()],
        )
    )


def stream_key_counts(
    events: DataFrame,
    key: str,
    window_seconds: int = 300,
    slide_seconds: int = 60,
    delay: str = "10 minutes",
    ts: str = "ts",
) -> DataFrame:
    """(window, key, count) rows: closed ones in append mode, changed ones in update mode.
    `rank_windows` picks the top keys."""
    spans = F.window(ts, f"{window_seconds} seconds", f"{slide_seconds} seconds")
    return (
        events.withWatermark(ts, delay)
        .groupBy(spans.alias("_w"), F.col(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("_w.start").alias("window_start"), "key", "count")
    )


def _best_of_window(n: int, window_ms: int):
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class BestOfWindow(StatefulProcessor):
        """Keeps the n best keys of a window, whatever the number of its keys, until the window is closed."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.best = handle.getValueState("best", "counts array<bigint>, keys array<string>")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            best = list(zip(*self.best.get(), strict=True)) if self.best.exists() else []
            if not best:
                self.handle.registerTimer(int(key[0].timestamp() * 1000) + window_ms)
            for frame in rows:
                best += zip(frame["count"].tolist(), frame["key"].tolist(), strict=True)
                # greater counts first, then smaller keys; a null key comes first
                best = sorted(best, key=lambda e: (-e[0], e[1] is not None, e[1] or ""))[:n]
            self.best.update(([c for c, _ in best], [k for _, k in best]))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            if self.best.exists():
                counts, keys = self.best.get()
                self.best.clear()
                yield pd.DataFrame({"window_start": key[0], "key": list(keys), "count": list(counts), "rank": range(1, len(keys) + 1)})

        def close(self) -> None:
            pass

    return BestOfWindow()


def stream_top(
    events: DataFrame,
    key: str,
    n: int = 3,
    window_seconds: int = 300,
    slide_seconds: int = 60,
    delay: str = "10 minutes",
    ts: str = "ts",
) -> DataFrame:
    """The n most frequent keys of every closed window, in append mode: a count per window and key, and then a list of
    at most n keys per window. A window comes out once, when the watermark has passed its end."""
    spans = F.window(ts, f"{window_seconds} seconds", f"{slide_seconds} seconds")
    counts = (
        events.withWatermark(ts, delay)
        .groupBy(spans.alias("_w"), F.col(key).cast("string").alias("key"))
        .agg(F.count(F.lit(1)).alias("count"))
        # the window's own time goes on to the second aggregation, which closes windows by it
        .select(F.col("_w.start").alias("window_start"), F.window_time("_w").alias("_time"), "key", "count")
    )
    return counts.groupBy("window_start").transformWithStateInPandas(
        _best_of_window(n, window_seconds * 1000),
        outputStructType="window_start timestamp, key string, count bigint, rank bigint",
        outputMode="append",
        timeMode="EventTime",
    )


def stream_daily_kpis(events: DataFrame, delay: str = "1 day", ts: str = "ts") -> DataFrame:
    """Orders and revenue per day, kept current in update mode (today, month to date)."""
    return (
        events.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("_w"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("revenue").alias("revenue"))
        .select(
            F.to_date("_w.start").alias("day"), "orders", F.col("revenue").cast("double").alias("revenue")
        )
    )


def kpis_as_of(days: DataFrame, as_of) -> DataFrame:
    """Today and month to date from the daily table."""
    today = F.lit(as_of).cast("date")
    month = F.trunc("day", "MM") == F.trunc(today, "MM")
    is_today = F.col("day") == today
    money = F.col("revenue").cast("decimal(23,2)")  # days add up exactly
    kept = days.where(month & (F.col("day") <= today))
    return kept.agg(
        F.coalesce(F.sum(F.when(is_today, F.col("orders"))), F.lit(0)).alias("orders_today"),
        F.sum(F.when(is_today, money)).cast("double").alias("revenue_today"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders_mtd"),
        F.sum(money).cast("double").alias("revenue_mtd"),
    )
