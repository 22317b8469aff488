"""Event windows in batch form: sliding panes, exact trailing windows, event scores.

No function sends the events of one period or one key to a single task: events are
folded to panes, slices or distinct instants first, or cut into chunks of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import severity
from ..functions.rounding import ratio, round_half_up
from .ordering import framed_over_rows, global_row_index

MICROS = 1_000_000


def _folded(revenue: Column) -> list[Column]:
    """Count, sum, sum of squares, minimum, maximum: everything the KPIs need."""
    return [
        F.count(revenue).alias("n"),
        F.sum(revenue).alias("s"),
        F.sum(revenue * revenue).alias("q"),
        F.min(revenue).alias("lo"),
        F.max(revenue).alias("hi"),
    ]


def _merged() -> list[Column]:
    return [
        F.sum("n").alias("n"),
        F.sum("s").alias("s"),
        F.sum("q").alias("q"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    ]


def _spread(n: Column, s: Column, q: Column) -> Column:
    """Population deviation; the decimal difference is exact, so nothing cancels."""
    return F.sqrt((n * q - s * s).cast("double")) / n.cast("double")


def _kpis(window_seconds: int) -> dict[str, Column]:
    """KPI columns from the folded measures; the deviation is that of the population."""
    n, s = F.col("n").cast("double"), F.col("s").cast("double")
    return {
        "event_count": F.col("n").cast("bigint"),
        "total_revenue": F.col("s").cast("double"),
        "avg_revenue": round_half_up(s / n, 2),
        "max_revenue": F.col("hi").cast("double"),
        "min_revenue": F.col("lo").cast("double"),
        "std_revenue": round_half_up(_spread(F.col("n"), F.col("s"), F.col("q")), 2),
        "events_per_min": round_half_up(n / F.lit(window_seconds / 60.0), 2),
    }


def window_kpis(
    events: DataFrame, window_seconds: int = 300, slide_seconds: int = 60, ts: str = "ts"
) -> DataFrame:
    """KPIs of sliding windows.

    Events are folded to panes of one slide each before the panes are copied to the
    windows they belong to, so the copies do not multiply the events.
    """
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    panes = events.groupBy(
        F.window(ts, f"{slide_seconds} seconds")["start"].alias("_pane")
    ).agg(*_folded(F.col("revenue")))
    steps = F.array(*[F.lit(i * slide_seconds) for i in range(window_seconds // slide_seconds)])
    starts = F.timestamp_seconds(F.unix_seconds("_pane") - F.col("_back"))
    return (
        panes.withColumn("_back", F.explode(steps))
        .groupBy(starts.alias("window_start"))
        .agg(*_merged())
        .select(
            "window_start",
            F.timestamp_seconds(F.unix_seconds("window_start") + window_seconds).alias("window_end"),
            *[c.alias(k) for k, c in _kpis(window_seconds).items()],
        )
    )


def window_top(
    events: DataFrame, key: str, n: int = 3, window_seconds: int = 300, slide_seconds: int = 60,
    ts: str = "ts",
) -> DataFrame:
    """The n most frequent keys of each sliding window, as an ordered array.

    Counts are folded per pane and key first. Spark keeps only n rows per window on the
    map side (window group limit), so the array never holds more than n entries.
    """
    panes = events.groupBy(
        F.window(ts, f"{slide_seconds} seconds")["start"].alias("_pane"), F.col(key).alias("key")
    ).agg(F.count(F.lit(1)).alias("n"))
    steps = F.array(*[F.lit(i * slide_seconds) for i in range(window_seconds // slide_seconds)])
    counted = (
        panes.withColumn("_back", F.explode(steps))
        .groupBy(
            F.timestamp_seconds(F.unix_seconds("_pane") - F.col("_back")).alias("window_start"),
            "key",
        )
        .agg(F.sum("n").alias("count"))
    )
    best = Window.partitionBy("window_start").orderBy(F.desc("count"), "key")
    return counted.withColumn("rank", F.row_number().over(best).cast("bigint")).where(
        F.col("rank") <= n
    )


def top_as_array(ranked: DataFrame) -> DataFrame:
    """One row per window with its (at most n) ranked keys."""
    return ranked.groupBy("window_start").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "key", "count"))),
            lambda e: F.struct(e["key"].alias("key"), e["count"].alias("count")),
        ).alias("top")
    )


def trailing_per_event(
    events: DataFrame, window_seconds: int = 300, slice_seconds: int = 1, ts: str = "ts"
) -> DataFrame:
    """KPIs over the last `window_seconds` up to and including each event's instant.

    The window is cut at slice borders: the rest of the oldest slice + whole slices +
    the own slice so far. Rows are distinct instants (equal instants are folded), so a
    group holds at most two slices of microseconds and a hot minute is spread over its
    slices. Whole slices are met in blocks of bounded length. Events without revenue add
    nothing, and have the KPIs of their instant like any other; events without a time have none.
    """
    wide = window_seconds // slice_seconds
    if window_seconds % slice_seconds or wide < 2:
        raise ValueError("the window must be at least two whole slices")
    slice_us = slice_seconds * MICROS
    instants = (
        events.groupBy(F.unix_micros(ts).alias("t"))
        .agg(*_folded(F.col("revenue")))
        .withColumn("slice", F.floor(F.col("t") / F.lit(slice_us)).cast("bigint"))
    )
    measures = ["n", "s", "q", "lo", "hi"]

    # own slice up to t, and the instants of the oldest slice that are still inside
    both = instants.withColumn("_carry", F.explode(F.array(F.lit(0), F.lit(1))))
    placed = both.select(
        (F.col("slice") + F.col("_carry") * wide).alias("slice"),
        (F.col("t") + F.col("_carry") * F.lit(window_seconds * MICROS)).alias("x"),
        F.col("_carry").alias("carried"),
        *measures,
    )
    group = Window.partitionBy("slice")
    forward = group.orderBy("x", "carried").rowsBetween(Window.unboundedPreceding, 0)
    backward = group.orderBy(F.desc("x"), "carried").rowsBetween(Window.unboundedPreceding, 0)
    fold = {"n": F.sum, "s": F.sum, "q": F.sum, "lo": F.min, "hi": F.max}
    own, old = F.col("carried") == 0, F.col("carried") == 1
    edges = placed.withColumns(
        {
            **{f"a_{m}": fold[m](F.when(own, F.col(m))).over(forward) for m in measures},
            **{f"b_{m}": fold[m](F.when(old, F.col(m))).over(backward) for m in measures},
        }
    ).where(own)

    # whole slices between, in blocks that also receive the slices just before them
    block = max(3600, wide)
    number = F.floor(F.col("slice") / block).cast("bigint")
    late = F.pmod(F.col("slice"), F.lit(block)) >= block - (wide - 1)
    slices = (
        instants.groupBy("slice")
        .agg(*_merged())
        .withColumn("_home", number)
        .withColumn(
            "_block",
            F.explode(F.when(late, F.array(number, number + 1)).otherwise(F.array(number))),
        )
    )
    before = Window.partitionBy("_block").orderBy("slice").rangeBetween(-(wide - 1), -1)
    middle = (
        slices.withColumns({f"c_{m}": fold[m](F.col(m)).over(before) for m in measures})
        .where(F.col("_block") == F.col("_home"))
        .select("slice", *[f"c_{m}" for m in measures])
    )

    whole = edges.join(middle, "slice")
    zero = F.lit(0)
    total = {
        m: F.coalesce(F.col(f"a_{m}"), zero)
        + F.coalesce(F.col(f"b_{m}"), zero)
        + F.coalesce(F.col(f"c_{m}"), zero)
        for m in ("n", "s", "q")
    }
    total["lo"] = F.least("a_lo", "b_lo", "c_lo")
    total["hi"] = F.greatest("a_hi", "b_hi", "c_hi")
    per_instant = whole.select(F.col("x").alias("t"), *[c.alias(m) for m, c in total.items()])
    kpis = per_instant.select("t", *[c.alias(k) for k, c in _kpis(window_seconds).items()])
    return events.withColumn("t", F.unix_micros(ts)).join(kpis, "t", "left").drop("t")


def _z_columns(count: Column, mean: Column, spread: Column, value: Column, threshold: float):
    """Score against a history; an event without history is compared with itself."""
    sigma = F.when(count > 1, spread).otherwise(F.lit(1.0))
    z = F.when(count > 0, (value - mean) / F.greatest(sigma, F.lit(0.01))).otherwise(F.lit(0.0))
    return {
        "z_score": round_half_up(z, 3),
        "is_spike": z > threshold,
        "is_drop": z < -threshold,
        "is_anomaly": (z > threshold) | (z < -threshold),
        "anomaly_severity": severity(z),
    }


def event_zscore(
    events: DataFrame, key: str = "customer_id", history: int = 50, threshold: float = 2.5,
    ts: str = "ts", chunk_rows: int = 500_000,
) -> DataFrame:
    """Score of each event against the last `history` events of its key.

    Chunks of the (key, time) order bound the work per task, so a key may hold any
    share of the events.
    """
    ordered = global_row_index(events, [key, ts, "event_id"])
    value = F.col("revenue").cast("double")

    def aggregates(frame) -> dict[str, Column]:
        return {
            "history_count": F.count("revenue").over(frame),
            "_s": F.sum("revenue").over(frame),
            "_q": F.sum(F.col("revenue") * F.col("revenue")).over(frame),
        }

    framed = framed_over_rows(
        ordered, history, aggregates, [key], include_current=False, chunk_rows=chunk_rows
    )
    n = F.col("history_count")
    spread = _spread(n, F.col("_s"), F.col("_q"))
    columns = _z_columns(n, ratio(F.col("_s"), n), spread, value, threshold)
    return framed.withColumns(columns).drop("_s", "_q", "row_index")


def running_event_totals(
    scored: DataFrame, last: int = 25, ts: str = "ts", chunk_rows: int = 500_000
) -> DataFrame:
    """Spikes among the last events, and running totals of events, revenue, anomalies.

    Chunk totals (a few numbers per chunk) carry the running sums across chunks.
    """
    ordered = global_row_index(scored, [ts, "event_id"])
    chunk = F.floor(F.col("row_index") / F.lit(chunk_rows)).cast("bigint")
    flag = F.col("is_anomaly").cast("bigint")

    framed = framed_over_rows(
        ordered,
        last - 1,
        lambda frame: {"spikes_last": F.sum(F.col("is_spike").cast("bigint")).over(frame)},
        chunk_rows=chunk_rows,
    ).withColumn("_chunk", chunk)
    totals = ordered.groupBy(chunk.alias("_chunk")).agg(
        F.sum("revenue").alias("_rev"), F.sum(flag).alias("_flags")
    )
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # one row per chunk of half a million events
    offsets = totals.select(
        "_chunk",
        F.coalesce(F.sum("_rev").over(earlier), F.lit(0)).alias("_rev_before"),
        F.coalesce(F.sum("_flags").over(earlier), F.lit(0)).alias("_flags_before"),
    )
    inside = Window.partitionBy("_chunk").orderBy("row_index").rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        framed.join(offsets, "_chunk")
        .withColumns(
            {
                "running_events": F.col("row_index") + 1,
                "running_revenue": (
                    F.col("_rev_before") + F.sum("revenue").over(inside)
                ).cast("double"),
                "running_anomalies": F.col("_flags_before") + F.sum(flag).over(inside),
            }
        )
        .drop("_chunk", "_rev_before", "_flags_before", "row_index")
    )


def event_history(tables) -> DataFrame:
    """Replayable order events: item revenue, payment type, state, first category.

    Orders without items are dropped; several payments give several events.
    """
    items = tables.order_items.select("order_id", "order_item_id", "product_id", "price").join(
        tables.products.select("product_id", "product_category_name"), "product_id", "left"
    )
    per_order = items.groupBy("order_id").agg(
        F.sum("price").alias("revenue"),
        F.min_by(
            "product_category_name", F.struct("order_item_id", "product_id")
        ).alias("category"),
    )
    return (
        tables.orders.select("order_id", "customer_id", "order_status")
        .join(per_order, "order_id")
        .where(F.col("revenue").isNotNull())
        .join(tables.payments.select("order_id", "payment_type"), "order_id", "left")
        .join(tables.customers.select("customer_id", "customer_state"), "customer_id", "left")
    )
