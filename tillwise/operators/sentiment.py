"""Review sentiment: per review, over time, keywords, summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import week_ending_sunday
from ..functions.labels import sentiment_band
from ..functions.rounding import ratio, round_half_up
from ..functions.text import STOPWORDS, Lexicon, keyword_tokens, text_sentiment


def score_sentiment(score: Column) -> Column:
    """Review score 1..5 mapped to -1..1."""
    return (score.cast("double") - 3.0) / 2.0


def text_columns(df: DataFrame) -> list[str]:
    marks = ("comment", "message", "title")
    return [c for c in df.columns if any(m in c.lower() for m in marks)]


def analyze_reviews(
    reviews: DataFrame,
    text_cols: Sequence[str] | None = None,
    score_col: str = "review_score",
    lexicon: Lexicon = Lexicon(),
) -> DataFrame:
    """Score, text and combined sentiment (70 % score, 30 % text) with a band."""
    text_cols = text_columns(reviews) if text_cols is None else list(text_cols)
    score = score_sentiment(F.col(score_col)) if score_col in reviews.columns else F.lit(0.0)
    scored = reviews.withColumn("score_sentiment", score)
    if text_cols:
        text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols])
        scored = scored.withColumn("text_sentiment", text_sentiment(text, lexicon))
        combined = 0.7 * F.col("score_sentiment") + 0.3 * F.col("text_sentiment")
    else:
        scored = scored.withColumn("text_sentiment", F.lit(0.0))
        combined = F.col("score_sentiment")
    return scored.withColumn("combined_sentiment", combined).withColumn(
        "sentiment_category",
        # an unscored review counts as the lowest band, as any comparison with NaN fails
        F.coalesce(sentiment_band(F.col("combined_sentiment")), F.lit("Very Negative")),
    )


def bucket_date(date: Column, freq: str) -> Column:
    """D: the day, W: the Sunday that ends the week, M: the last day of the month."""
    if freq == "D":
        return F.to_date(date)
    if freq == "W":
        return week_ending_sunday(date)
    if freq == "M":
        return F.last_day(F.to_date(date))
    raise ValueError(f"unknown frequency {freq!r}")


def sentiment_trend(
    analyzed: DataFrame, freq: str = "W", date_col: str = "review_creation_date"
) -> DataFrame:
    """Mean sentiments and review count per period; unusable dates and empty periods drop."""
    day = F.expr(f"try_cast({date_col} AS DATE)")
    return (
        analyzed.withColumn("_day", day)
        .where(F.col("_day").isNotNull())
        .groupBy(bucket_date(F.col("_day"), freq).alias("period"))
        .agg(
            F.avg("combined_sentiment").alias("avg_sentiment"),
            F.avg("score_sentiment").alias("avg_score_sentiment"),
            F.avg("text_sentiment").alias("avg_text_sentiment"),
            F.count(F.lit(1)).alias("review_count"),
        )
        .dropna(subset=["avg_sentiment", "avg_score_sentiment", "avg_text_sentiment"])
    )


def _keyword_counts(
    analyzed: DataFrame, side: Column, text_cols: Sequence[str] | None, lexicon: Lexicon
) -> DataFrame:
    """Word counts per side; words are counted map-side first, so frequent words do not
    travel row by row."""
    text_cols = text_columns(analyzed) if text_cols is None else list(text_cols)
    text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols])
    ignored = sorted({*STOPWORDS, *lexicon.positive, *lexicon.negative})
    return (
        analyzed.select(side.alias("kind"), text.alias("_text"))
        .where(F.col("kind").isNotNull())
        .select("kind", F.explode(keyword_tokens(F.col("_text"))).alias("keyword"))
        .where(~F.col("keyword").isin(*ignored))
        .groupBy("kind", "keyword")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def _side() -> Column:
    c = F.col("combined_sentiment")
    return F.when(c > 0.3, "positive").when(c < -0.3, "negative")


def top_keywords(
    analyzed: DataFrame,
    kind: str = "positive",
    n: int = 20,
    text_cols: Sequence[str] | None = None,
    lexicon: Lexicon = Lexicon(),
) -> DataFrame:
    """Most frequent words of clearly positive or clearly negative reviews."""
    side = F.when(_side() == kind, F.lit(kind))
    counts = _keyword_counts(analyzed, side, text_cols, lexicon)
    return counts.drop("kind").orderBy(F.desc("count"), "keyword").limit(n)


def top_keywords_by_side(
    analyzed: DataFrame,
    n: int = 20,
    text_cols: Sequence[str] | None = None,
    lexicon: Lexicon = Lexicon(),
) -> DataFrame:
    """Both lists with one pass over the texts."""
    best = Window.partitionBy("kind").orderBy(F.desc("count"), "keyword")
    return (
        _keyword_counts(analyzed, _side(), text_cols, lexicon)
        .withColumn("_rank", F.row_number().over(best))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )


def keyword_map(keywords: DataFrame) -> DataFrame:
    """The keyword rows as one map column, most frequent first."""
    entries = F.array_sort(
        F.collect_list(F.struct((-F.col("count")).alias("_rank"), "keyword", "count"))
    )
    return keywords.agg(
        F.map_from_entries(
            F.transform(entries, lambda e: F.struct(e["keyword"], e["count"]))
        ).alias("keywords")
    )


def sentiment_summary(analyzed: DataFrame) -> DataFrame:
    """Counts, mean, deviation, shares by sign, gauge value and reviews per band."""
    c = F.col("combined_sentiment")
    bands = analyzed.groupBy("sentiment_category").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(c).alias("_k"),
        F.sum(c).alias("_s"),
        F.sum(c * c).alias("_q"),
        F.count_if(c > 0.2).alias("_pos"),
        F.count_if(c < -0.2).alias("_neg"),
        F.count_if((c >= -0.2) & (c <= 0.2)).alias("_mid"),
        F.sum("score_sentiment").alias("_score"),
        F.count("score_sentiment").alias("_scores"),
    )
    n = F.sum("_n")
    pct = lambda col: round_half_up(ratio(F.sum(col), n) * 100.0, 1)
    k, s, q = F.sum("_k"), F.sum("_s"), F.sum("_q")
    variance = F.try_divide(q - s * s / k, (k - 1).cast("double"))
    return bands.agg(
        n.alias("total_reviews"),
        round_half_up(ratio(s, k), 4).alias("avg_sentiment"),
        round_half_up(F.sqrt(F.greatest(variance, F.lit(0.0))), 4).alias("std_sentiment"),
        pct("_pos").alias("positive_pct"),
        pct("_neg").alias("negative_pct"),
        pct("_mid").alias("neutral_pct"),
        round_half_up(ratio(F.sum("_score"), F.sum("_scores")), 4).alias("gauge"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("sentiment_category", "_n")))).alias(
            "category_distribution"
        ),
    )
