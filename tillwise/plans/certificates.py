"""Checks of fitted models that hold whatever was learnt, with rows that SQL can state from the tables alone.

Each function recomputes what a model put out by another way (joins and expressions instead of the scorer) and counts the
rows that differ; the other columns are facts of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import churn, forecast, isolation_forest, rfm
from ..session import materialize


def clusters(segments: DataFrame, k: int | None = None) -> DataFrame:
    """(customers, unlabelled, far_from_own, misnamed): every customer is nearest to its own cluster's centre, and the names
    fall with the mean monetary value."""
    model, scaled = rfm.fit_clusters(segments, k)
    named = rfm.named_clusters(model, scaled)
    logs = [F.log1p(F.col(c).cast("double")) for c in ("recency", "frequency", "monetary")]
    stats = named.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(logs)], *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(logs)]
    ).first()
    spread = [stats[f"s{i}"] or 1.0 for i in range(3)]
    z = [(c - F.lit(stats[f"m{i}"])) / F.lit(spread[i]) for i, c in enumerate(logs)]
    distances = F.array(
        *[sum(((z[i] - F.lit(float(x))) * (z[i] - F.lit(float(x))) for i, x in enumerate(centre)), F.lit(0.0)) for centre in model.clusterCenters()]
    )
    far = F.get(distances, F.col("cluster")) > F.array_min(distances) + 1e-9
    means = named.groupBy("cluster_label").agg(F.avg(F.col("monetary").cast("double")).alias("mean"))
    place = F.split("cluster_label", "_")[1].cast("int")
    falling = means.withColumn("next", F.lead("mean").over(Window.orderBy(place)))  # k rows
    judged = named.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("cluster_label").isNull()).alias("unlabelled"),
        F.count_if(far).alias("far_from_own"),
    )
    return judged.crossJoin(falling.agg(F.count_if(F.col("next") > F.col("mean")).alias("misnamed")))


def churn_training(features: DataFrame, folds: int = 5) -> DataFrame:
    """(label, customers, folds, uneven): how many customers of each label are learnt from, in how many folds they lie, and how
    many folds hold a share of them that hashing makes less likely than one in ten thousand."""
    training = churn._stratified(churn._training(features, churn.FEATURES), folds, 42)
    per_fold = training.groupBy(F.col("label").cast("bigint").alias("label"), "_part").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("label")  # a row a fold
    expected = F.sum("n").over(whole) / folds
    uneven = F.abs(F.col("n") - expected) > 4 * F.sqrt(expected * (1 - 1 / folds)) + 1
    return per_fold.withColumn("_uneven", uneven).groupBy("label").agg(
        F.sum("n").alias("customers"), F.count(F.lit(1)).alias("folds"), F.count_if("_uneven").alias("uneven")
    )


def churn_bands(scores: DataFrame) -> DataFrame:
    """(customers, outside, misplaced): probabilities lie in [0, 1], and in the band they are given, but for rounding."""
    p = F.col("churn_probability")
    edges = {"Low": (0.0, 0.3), "Medium": (0.3, 0.6), "High": (0.6, 0.8), "Critical": (0.8, 1.0)}
    fits: Column = F.lit(False)
    for name, (low, high) in edges.items():
        fits = fits | ((F.col("churn_risk") == name) & p.between(low - 0.0005, high + 0.0005))
    return scores.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(~p.between(0.0, 1.0)).alias("outside"),
        F.count_if(~F.coalesce(fits, F.lit(False))).alias("misplaced"),
    )


def attribution(attributed: DataFrame) -> DataFrame:
    """(customers, unexplained, disordered): the contributions add up to the log odds less one constant, and the largest come first."""
    p = F.col("churn_probability")
    total = F.aggregate("contributions", F.lit(0.0), lambda a, c: a + c["contribution"])
    rows = materialize(attributed.withColumn("_rest", F.log(p / (1 - p)) - total), "certificate-attribution")
    base = rows.agg(F.min_by("_rest", F.abs(p - 0.5))).first()[0]
    # the probability is rounded to four digits
    off = F.abs(F.col("_rest") - F.lit(base or 0.0)) > 0.0003 + 0.0001 / (p * (1 - p))
    sizes = F.transform("contributions", lambda c: F.abs(c["contribution"]))
    return rows.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(p.between(0.001, 0.999) & off).alias("unexplained"),
        F.count_if(F.reverse(F.array_sort(sizes)) != sizes).alias("disordered"),
    )


def forest_paths(df: DataFrame, columns: Sequence[str], contamination: float = 0.05, key: Sequence[str] = ("date",), **options) -> DataFrame:
    """(days, trees, differing): scores recomputed by walking the exported nodes, one join a level, and their cut by percentile."""
    scored = isolation_forest.isolation_forest(df, columns, contamination, key, **options)
    points, nodes, size = isolation_forest.grown(df, columns, key, **options)
    trees = [r["tree"] for r in nodes.select("tree").distinct().collect()]
    at = points.select(*key, "_x", F.explode(F.array(*map(F.lit, sorted(trees)))).alias("tree")).withColumn("node", F.lit(0))
    levels = nodes.select("tree", "node", "feature", "threshold", "left", "right", "path")
    for _ in range(isolation_forest.deepest(size) + 1):
        here = at.join(F.broadcast(levels), ["tree", "node"])  # trees x 2 x sample rows at most
        down = F.when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = here.select(*key, "_x", "tree", F.when(F.col("feature") < 0, F.col("node")).otherwise(down).alias("node"))
    paths = at.join(F.broadcast(levels), ["tree", "node"]).groupBy(*key).agg(F.avg("path").alias("_path"), F.max("feature").alias("_inner"))
    raw = F.pow(F.lit(2.0), -F.col("_path") / F.lit(isolation_forest.normal_path(size)))
    walked = materialize(paths.withColumn("_raw", raw), "certificate-paths")
    cut = walked.agg(F.percentile("_raw", 1.0 - contamination)).first()[0]
    differs = (F.abs(F.col("score") - (F.col("_raw") - F.lit(cut))) > 1e-9) | (F.col("_inner") >= 0)
    return scored.join(walked, list(key), "left").agg(
        F.count(F.lit(1)).alias("days"),
        F.lit(len(trees)).cast("bigint").alias("trees"),
        F.count_if(F.coalesce(differs, F.lit(True))).alias("differing"),
    )


def mixture(combined: DataFrame, weights: tuple[float, float] = (0.4, 0.6)) -> DataFrame:
    """The seasonal part of a combined forecast, and whether the mix and its band follow from the parts."""
    mixed = weights[0] * F.col("seasonal_forecast") + weights[1] * F.col("boosted_forecast")
    return combined.select(
        "step",
        "date",
        "seasonal_forecast",
        (F.abs(F.col("ensemble_forecast") - mixed) < 1e-6).alias("is_mix"),
        ((F.col("lower_80") >= 0) & (F.col("lower_80") <= F.col("ensemble_forecast") + 1e-6) & (F.col("ensemble_forecast") <= F.col("upper_80") + 1e-6)).alias("in_band"),
        (F.col("boosted_forecast") >= 0).alias("not_negative"),
    )


def backtest_errors(compared: DataFrame, models: Sequence[str]) -> DataFrame:
    """(model, days, actual, matches): the days and their revenue, and whether the reported errors are those of the rows."""
    rows = materialize(compared, "certificate-backtest")
    reported = {r["model"]: r for r in forecast.backtest_metrics(rows, models).collect()}  # a row a model
    parts = []
    for model in models:
        y, f, r = F.col("total_revenue"), F.col(model), reported[model]
        error = F.when(y > f, y - f).otherwise(f - y)
        again = {
            "mae": F.sum(error) / F.count(F.lit(1)),
            "rmse": F.pow(F.sum(error * error) / F.count(F.lit(1)), 0.5),
            "mape": 100 * F.sum(F.when(y > 1, error / y).otherwise(error)) / F.count(F.lit(1)),
        }
        matches = F.lit(True)
        for name, value in again.items():
            matches = matches & (F.abs(value - F.lit(r[name])) < 1e-6 * (1 + abs(r[name])))
        parts.append(rows.agg(F.lit(model).alias("model"), F.count(F.lit(1)).alias("days"), F.sum(y).alias("actual"), matches.alias("matches")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
