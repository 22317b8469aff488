import math
import re

import pytest
from pyspark.sql import functions as F

from tillwise.functions import labels, text
from tillwise.operators import sentiment

SAMPLES = {
    "very good": 1.5 / math.sqrt(2),
    "not good": -0.5 / math.sqrt(2),
    "not very bad": 0.75 / math.sqrt(3),
    "very not good": -0.75 / math.sqrt(3),
    "very plain good": 1.0 / math.sqrt(3),
    "extremely really good": 1.5 / math.sqrt(3),
    "não recomendo, péssimo": -0.5 / math.sqrt(3),
    "Ótimo!": 1.0,
    "good good good good good": 1.0,
    "never": 0.0,
    "demais": 0.0,
    "": 0.0,
    "   ": 0.0,
    "?!": 0.0,
}


def test_text_sentiment(spark):
    df = spark.createDataFrame([(k,) for k in [*SAMPLES, None]], "t string")
    got = {r["t"]: r["s"] for r in df.select("t", text.text_sentiment(F.col("t")).alias("s")).collect()}
    for sample, want in {**SAMPLES, None: 0.0}.items():
        assert got[sample] == pytest.approx(max(-1, min(1, want))), sample


def test_tokens_keep_accents(spark):
    sample = "Não é Über_cool x2, d'água"
    got = spark.range(1).select(text.tokens(F.lit(sample))).first()[0]
    assert got == re.findall(r"\b\w+\b", sample.lower())
    words = spark.range(1).select(text.keyword_tokens(F.lit("Casa água abc_defg hello9 plain"))).first()[0]
    assert words == ["casa", "plain"]


def test_reviews_trend_keywords_summary(spark):
    reviews = spark.createDataFrame(
        [
            (5, "great phone phone", "2024-01-01"),
            (5, None, "2024-01-07"),
            (1, "terrible battery", "2024-01-08"),
            (3, "plain", "not a date"),
        ],
        "review_score int, review_comment_message string, review_creation_date string",
    )
    done = sentiment.analyze_reviews(reviews)
    first = done.where("review_comment_message LIKE 'great%'").first()
    assert first["combined_sentiment"] == pytest.approx(0.7 + 0.3 / math.sqrt(3))
    assert first["sentiment_category"] == "Very Positive"
    trend = {str(r["period"]): r["review_count"] for r in sentiment.sentiment_trend(done).collect()}
    assert trend == {"2024-01-07": 2, "2024-01-14": 1}
    assert sentiment.sentiment_trend(done, "M").first()["review_count"] == 3
    assert sentiment.sentiment_trend(done, "D").count() == 3
    top = sentiment.top_keywords(done, "positive")
    assert [(r[0], r[1]) for r in top.collect()] == [("phone", 2)]
    assert [r[0] for r in sentiment.top_keywords(done, "negative").collect()] == ["battery"]
    assert sentiment.keyword_map(top).first()[0] == {"phone": 2}
    both = sentiment.top_keywords_by_side(done).collect()
    assert {(r["kind"], r["keyword"]) for r in both} == {("positive", "phone"), ("negative", "battery")}
    s = sentiment.sentiment_summary(done).first()
    assert (s["total_reviews"], s["positive_pct"], s["neutral_pct"]) == (4, 50.0, 25.0)
    assert sum(s["category_distribution"].values()) == 4
    with pytest.raises(ValueError):
        sentiment.sentiment_trend(done, "Q")


def test_labels_and_sql_functions_agree(spark):
    labels.register_sql_functions(spark)
    df = spark.range(0, 101).select((F.col("id") / 100).alias("p"))
    both = df.select(labels.churn_risk(F.col("p")).alias("a"), F.expr("churn_risk(p)").alias("b"))
    assert both.where("NOT a <=> b").count() == 0
    edges = {0.0: "Low", 0.3: "Low", 0.31: "Medium", 0.6: "Medium", 0.8: "High", 1.0: "Critical"}
    for p, want in edges.items():
        assert spark.sql(f"SELECT churn_risk({p}D)").first()[0] == want
    grid = spark.sql("SELECT r.id r, f.id f FROM range(1, 6) r JOIN range(1, 6) f")
    same = grid.select(
        labels.rfm_segment(F.col("r"), F.col("f")).alias("a"),
        F.expr("rfm_segment(CAST(r AS INT), CAST(f AS INT))").alias("b"),
    )
    assert same.where("a <> b").count() == 0 and same.select("a").distinct().count() == 11
    z = [(0.0, "none"), (2.0, "low"), (-2.5, "medium"), (3.5, "high"), (-5.0, "critical")]
    for value, want in z:
        assert spark.sql(f"SELECT severity({value}D)").first()[0] == want
    for value, want in [(0.5, "Very Positive"), (-0.2, "Neutral"), (-0.51, "Very Negative")]:
        assert spark.sql(f"SELECT sentiment_band({value}D)").first()[0] == want


def test_next_best_action_falls_through(spark):
    df = spark.createDataFrame(
        [("Lost", 5, 1, 1.0), ("Cannot Lose", 5, 1, 1.0), ("Cannot Lose", 50, 1, 2000.0), (None, 50, 9, 1.0)],
        "segment string, recency int, frequency int, monetary double",
    )
    got = df.select(labels.next_best_action(*[F.col(c) for c in df.columns])).collect()
    assert [r[0] for r in got] == [
        "Survey for feedback", "Second purchase incentive", "VIP treatment", "General newsletter",
    ]
