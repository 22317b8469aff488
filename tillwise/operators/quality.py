"""Data quality: row counts, null shares, key uniqueness, missing parents, value ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import ratio


def _row(table: str, check: str, value: Column, failed: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        value.cast("double").alias("value"),
        failed.alias("failed"),
    ]


def table_profile(df: DataFrame, name: str, warn_share: float = 0.5) -> DataFrame:
    """Row count (empty fails) and the largest null share of any column, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(df.columns)],
    )
    nulls = [F.col(f"_null_{i}") for i in range(len(df.columns))]
    worst = F.greatest(*nulls) if len(nulls) > 1 else nulls[0]
    share = F.coalesce(ratio(worst, F.col("_n")), F.lit(0.0))
    checks = F.array(
        F.struct(*_row(name, "row_count", F.col("_n"), F.col("_n") == 0)),
        F.struct(*_row(name, "max_null_share", share, share > warn_share)),
    )
    return counts.select(F.explode(checks).alias("_c")).select("_c.*")


def duplicate_keys(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    n = F.count(F.lit(1))
    return repeated.agg(n.alias("_v")).select(
        *_row(name, f"duplicate_key:{','.join(keys)}", F.col("_v"), F.col("_v") > 0)
    )


def missing_parents(child: DataFrame, name: str, key: str, parent: DataFrame, parent_name: str) -> DataFrame:
    """Rows whose key has no parent. Keys are counted before the anti join, so a hot key
    travels once."""
    counted = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    orphans = counted.join(parent.select(key), key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_v")).select(
        *_row(name, f"missing_parent:{key}->{parent_name}", F.col("_v"), F.col("_v") > 0)
    )


def out_of_range(df: DataFrame, name: str, column: str, low, high) -> DataFrame:
    outside = F.count_if((F.col(column) < low) | (F.col(column) > high))
    return df.agg(outside.alias("_v")).select(
        *_row(name, f"range:{column}", F.col("_v"), F.col("_v") > 0)
    )


def quality_report(
    tables: Mapping[str, DataFrame],
    primary_keys: Mapping[str, Sequence[str]],
    foreign_keys: Sequence[tuple[str, str, str]],
    ranges: Sequence[tuple[str, str, int, int]] = (("reviews", "review_score", 1, 5),),
) -> DataFrame:
    """All checks of all tables as (table_name, check_name, value, failed) rows."""
    checks = [table_profile(df, name) for name, df in tables.items()]
    checks += [duplicate_keys(tables[t], t, k) for t, k in primary_keys.items() if t in tables]
    checks += [
        missing_parents(tables[child], child, key, tables[parent], parent)
        for child, key, parent in foreign_keys
        if child in tables and parent in tables
    ]
    checks += [out_of_range(tables[t], t, c, lo, hi) for t, c, lo, hi in ranges if t in tables]
    return reduce(DataFrame.unionByName, checks)
