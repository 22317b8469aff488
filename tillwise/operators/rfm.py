"""Recency, frequency, monetary: base table, quintile scores, segments, clusters."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import instant, whole_days
from ..functions.labels import next_best_action, rfm_segment, segment_action
from ..functions.rounding import ratio, round_half_up, share_pct
from ..session import materialize, packed
from .facts import item_value_per_order, order_facts, order_value
from .ordering import exact_quantiles, score_by_edges, with_tiles

FIFTHS = [0.2, 0.4, 0.6, 0.8]


def rfm_base(tables, reference=None, grain: str = "order") -> DataFrame:
    """Last purchase, distinct orders and order value of customers with delivered orders.

    grain="order" counts the value of an order once; grain="rows" counts it once per
    payment x review row of the master dataset.
    """
    if reference is None:
        reference = tables.orders.agg(F.max("order_purchase_timestamp")).first()[0]
    if grain == "rows":
        facts = order_facts(tables).where(F.col("order_status") == "delivered")
        value = F.col("total_order_value") * F.col("row_multiplicity")
    else:
        facts = (
            tables.orders_in("delivered")
            .select("order_id", "customer_id", "order_purchase_timestamp")
            .join(item_value_per_order(tables.order_items), "order_id", "left")
        )
        value = order_value()
    return (
        facts.groupBy("customer_id")
        .agg(
            F.max("order_purchase_timestamp").alias("last_purchase"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum(value).alias("monetary"),
        )
        .withColumn(
            "recency", whole_days(instant(reference), F.col("last_purchase"))
        )
    )


def with_scores(base: DataFrame) -> DataFrame:
    """Quintile scores by interpolated edges; F and M are clipped at their 99 % quantile.

    The edges come from one distributed sort; scoring is a projection.
    """
    edges = exact_quantiles(
        base,
        {"recency": FIFTHS, "frequency": FIFTHS, "monetary": FIFTHS},
        clip_upper={"frequency": 0.99, "monetary": 0.99},
    )
    # a value above the clip lies above every edge either way
    r = F.lit(6) - score_by_edges(F.col("recency"), edges["recency"])
    f = score_by_edges(F.col("frequency"), edges["frequency"])
    m = score_by_edges(F.col("monetary"), edges["monetary"])
    return base.withColumns({"R_score": r.cast("bigint"), "F_score": f, "M_score": m})


def with_segments(scored: DataFrame) -> DataFrame:
    r, f, m = F.col("R_score"), F.col("F_score"), F.col("M_score")
    return scored.withColumns(
        {
            "RFM_score": r * 100 + f * 10 + m,
            "RFM_avg": (r + f + m).cast("double") / 3.0,
            "segment": rfm_segment(r, f),
        }
    )


def rfm_segments(tables, reference=None, grain: str = "order") -> DataFrame:
    base = materialize(rfm_base(tables, reference, grain), "rfm")
    return with_segments(with_scores(base))


def rank_quintiles(base: DataFrame) -> DataFrame:
    """Quintiles of the rank (ties by customer), so every fifth has the same size."""
    return with_tiles(
        base,
        5,
        "customer_id",
        {
            "r_quintile": F.col("recency"),
            "f_quintile": F.col("frequency"),
            "m_quintile": F.col("monetary"),
        },
    )


def segment_summary(rfm: DataFrame) -> DataFrame:
    sums = rfm.groupBy("segment").agg(
        F.count("customer_id").alias("customer_count"),
        F.sum("recency").alias("_r"),
        F.sum("frequency").alias("_f"),
        F.sum("monetary").alias("_m"),
        F.sum(F.col("R_score") + F.col("F_score") + F.col("M_score")).alias("_s"),
    )
    n, everything = F.col("customer_count"), Window.partitionBy()  # at most 11 segments
    return sums.select(
        "segment",
        "customer_count",
        round_half_up(ratio(F.col("_r"), n), 2).alias("avg_recency"),
        round_half_up(ratio(F.col("_f"), n), 2).alias("avg_frequency"),
        round_half_up(ratio(F.col("_m"), n), 2).alias("avg_monetary"),
        F.col("_m").cast("double").alias("total_revenue"),
        round_half_up(ratio(F.col("_s"), n * 3), 2).alias("avg_rfm"),
        round_half_up(share_pct(F.col("_m"), F.sum("_m").over(everything)), 1).alias(
            "revenue_share"
        ),
    )


def in_segment(rfm: DataFrame, segment: str | None) -> DataFrame:
    """Rows of one segment; "all" or None does not filter."""
    return rfm if segment in (None, "all") else rfm.where(F.col("segment") == segment)


def with_actions(rfm: DataFrame) -> DataFrame:
    return rfm.withColumns(
        {
            "recommended_action": segment_action(F.col("segment")),
            "next_best_action": next_best_action(
                F.col("segment"), F.col("recency"), F.col("frequency"), F.col("monetary")
            ),
        }
    )


def fit_clusters(
    rfm: DataFrame, k: int | None = None, k_range=range(2, 9), seed: int = 42
) -> tuple[KMeansModel, DataFrame]:
    """K-Means on standardised log1p features, and the rows with their features; without k the best silhouette decides."""
    logs = [f"_log_{c}" for c in ("recency", "frequency", "monetary")]
    prepared = rfm.withColumns(
        {name: F.log1p(F.col(name.removeprefix("_log_")).cast("double")) for name in logs}
    )
    vectors = VectorAssembler(inputCols=logs, outputCol="_raw").transform(prepared)
    scaler = StandardScaler(inputCol="_raw", outputCol="_x", withMean=True, withStd=True)
    scaled = scaler.fit(vectors).transform(vectors).drop("_raw", *logs)
    scaled = materialize(scaled, "rfm-scaled")
    points = packed(scaled.select("_x")).persist()  # read by every pass of every fit
    judge = ClusteringEvaluator(featuresCol="_x", predictionCol="cluster")

    def fitted(n: int) -> KMeansModel:
        return KMeans(k=n, seed=seed, featuresCol="_x", predictionCol="cluster").fit(points)

    def tried(n: int) -> tuple[float, KMeansModel]:
        model = fitted(n)
        return judge.evaluate(model.transform(points)), model

    try:
        if k is not None:
            return fitted(k), scaled
        with ThreadPoolExecutor(4) as threads:  # small jobs, which leave cores idle one by one
            return max(threads.map(tried, k_range), key=lambda found: found[0])[1], scaled
    finally:
        points.unpersist()


def named_clusters(model: KMeansModel, scaled: DataFrame) -> DataFrame:
    """Clusters, named by falling mean monetary value."""
    clustered = model.transform(scaled)
    order = Window.orderBy(F.desc("_mean"), "cluster")  # k rows
    rank = F.row_number().over(order)
    level = F.when(rank == 1, "High").when(rank == 2, "Mid").otherwise("Low")
    names = (
        clustered.groupBy("cluster")
        .agg(F.avg(F.col("monetary").cast("double")).alias("_mean"))
        .select(
            "cluster",
            F.concat(F.lit("Cluster_"), rank.cast("string"), F.lit("_"), level).alias(
                "cluster_label"
            ),
        )
    )
    return clustered.join(F.broadcast(names), "cluster").drop("_x")


def cluster(rfm: DataFrame, k: int | None = None, k_range=range(2, 9), seed: int = 42) -> DataFrame:
    """The rows with their cluster and its name."""
    return named_clusters(*fit_clusters(rfm, k, k_range, seed))
