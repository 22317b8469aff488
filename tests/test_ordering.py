import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwise.operators import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value."""
    rng = np.random.default_rng(7)
    value = np.where(np.arange(3000) % 3 == 0, 5.0, rng.normal(5, 3, 3000).round(2))
    frame = pd.DataFrame({"id": rng.permutation(3000), "value": value})
    return spark.createDataFrame(frame).repartition(6), frame


def test_row_index_is_a_total_order(skewed):
    df, frame = skewed
    got = ordering.global_row_index(df, ["value", "id"]).toPandas().sort_values("row_index")
    want = frame.sort_values(["value", "id"])
    assert got["row_index"].tolist() == list(range(len(frame)))
    assert got["id"].tolist() == want["id"].tolist()


def test_quantiles_match_numpy(skewed):
    df, frame = skewed
    levels = [0.0, 0.01, 0.2, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = ordering.exact_quantiles(df, {"value": levels, "id": [0.5]})
    assert got["value"] == pytest.approx(np.quantile(frame["value"], levels))
    assert got["id"] == pytest.approx([np.quantile(frame["id"], 0.5)])


def test_quantiles_of_clipped_column(spark):
    values = [1.0, 2.0, 1000.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    top = np.quantile(values, 0.99)
    want = np.quantile(np.minimum(values, top), [0.6, 0.8])
    assert ordering.exact_quantiles(df, {"v": [0.6, 0.8]}, {"v": 0.99})["v"] == pytest.approx(want)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert ordering.exact_quantiles(df, {"v": [0.5]}) == {"v": [None]}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=40))
def test_quantiles_of_any_values(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = ordering.exact_quantiles(df, {"v": [0.2, 0.5, 0.9]})["v"]
    assert got == pytest.approx(np.quantile(values, [0.2, 0.5, 0.9]))


@pytest.mark.parametrize("rows", [3, 7, 3000])
def test_tiles_match_ntile(spark, skewed, rows):
    df = skewed[0].where(F.col("id") < rows)
    n = df.count()
    got = ordering.with_tiles(df, 5, "id", {"up": F.col("value"), "down": -F.col("value")})
    got.createOrReplaceTempView("tiled")
    wrong = spark.sql(
        "SELECT count(*) FROM (SELECT *, ntile(5) OVER (ORDER BY value, id) a, "
        "ntile(5) OVER (ORDER BY value DESC, id) b FROM tiled) WHERE a <> up OR b <> down"
    ).first()[0]
    assert wrong == 0 and got.count() == n


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_tiles_break_ties_by_any_id(spark, kind):
    """All rows share three values, so that the borders lie among equal values; ids need more than a double holds."""
    rng = np.random.default_rng(2)
    ids = rng.choice(np.arange(-(2**62), 2**62, 2**50 + 7), 400, replace=False)
    rows = [(float(rng.integers(3)), f"id-{abs(i)}é{'x' * (i % 3)}" if kind == "string" else int(i)) for i in ids]
    df = spark.createDataFrame(rows + [(None, rows[0][1])], f"v double, id {kind}")
    got = ordering.with_tiles(df, 7, "id", {"t": F.col("v"), "r": -F.col("v")}).where("v IS NOT NULL")
    got.createOrReplaceTempView("tied")
    wrong = spark.sql("SELECT * FROM (SELECT *, ntile(7) OVER (ORDER BY v, id) a, ntile(7) OVER (ORDER BY -v, id) b FROM tied) WHERE a <> t OR b <> r")
    assert wrong.count() == 0 and got.count() == 400


def test_selection_of_wild_values(spark):
    values = [float("-inf"), -1e308, -1e300, -5e-324, 0.0, 5e-324, 1e-9, 3.0, 3.0, 3.0, 1e300, 1.7e308, float("inf"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(3)
    n, found = ordering._select(df, {"v": F.col("v")}, lambda _, n: range(n))["v"]
    assert n == len(values) and [found[i][0] for i in range(n)] == values
    assert [found[i][1] for i in range(n)] == [values.index(v) for v in values]
    odd = spark.createDataFrame([(float("nan"),), (1.0,), (float("nan"),)], "v double")
    n, found = ordering._select(odd, {"v": F.col("v")}, lambda _, n: range(n))["v"]
    assert found[0][0] == 1.0 and np.isnan(found[1][0]) and np.isnan(found[2][0])


def test_nothing_is_sorted_for_borders(spark, skewed, monkeypatch):
    def no_sort(*_):
        raise AssertionError("sorted")

    monkeypatch.setattr(ordering, "_slots", no_sort)
    plans = []
    frame_type = type(skewed[0])
    collect = frame_type.collect
    monkeypatch.setattr(frame_type, "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df))
    df = skewed[0]
    ordering.with_tiles(df, 5, "id", {"up": F.col("value")})
    ordering.exact_quantiles(df, {"value": [0.2, 0.4]})
    assert plans and not any("Sort" in p or "rangepartitioning" in p for p in plans)


def test_score_collapses_tied_edges(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "v double")
    scores = df.select(ordering.score_by_edges(F.col("v"), [1.0, 1.0, 2.0, 2.0])).collect()
    assert [r[0] for r in scores] == [1, 3, 5]


def test_ranks_among(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (1.0,), (9.0,), (None,)], "v double")
    got = ordering.ranks_among(df, {"v": [3.0, 9.0]})["v"]
    assert got[0] == {"greater": 1, "smaller": 1, "nulls": 1, "all": 5}
    assert got[1] == {"greater": 0, "smaller": 3, "nulls": 1, "all": 5}


def test_row_frames_cross_chunk_borders(skewed):
    df, frame = skewed
    indexed = ordering.global_row_index(df.withColumn("k", F.col("id") % 2), ["k", "value", "id"])
    got = ordering.framed_over_rows(
        indexed,
        9,
        lambda w: {"s": F.sum("value").over(w), "n": F.count("value").over(w)},
        ["k"],
        include_current=False,
        chunk_rows=50,
    ).toPandas()
    assert len(got) == len(frame)
    want = frame.assign(k=frame["id"] % 2).sort_values(["k", "value", "id"])
    past = want.groupby("k")["value"].transform(lambda s: s.shift(1).rolling(9, min_periods=1).sum())
    merged = got.set_index("id")["s"].reindex(want["id"])
    assert merged.to_numpy() == pytest.approx(past.to_numpy(), nan_ok=True)
    assert got["n"].max() == 9 and (got["n"] == 0).sum() == 2
