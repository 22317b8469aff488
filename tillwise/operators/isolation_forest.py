"""Isolation forest (Liu, Ting, Zhou 2008) as a Spark job.

Each tree grows from its own hash-drawn sample of fixed size, one group per tree; the
node table (trees x 2 x sample rows at most) is broadcast and rows are scored in Arrow
batches. Neither side grows with the data.
"""

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ordering import exact_quantiles

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, path double"
)


def _average_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _tree_samples(
    points: DataFrame, key: Sequence[str], trees: int, size: int, seed: int
) -> DataFrame:
    """`size` rows per tree (all rows, if there are fewer), drawn by hash.

    Rows are thinned to about three samples per tree before they are multiplied, so the
    exchanged data does not grow with the number of rows. Only the smallest draws, which thinning keeps, can be
    among a tree's `size` rows; that fewer than a third of the expected rows are left does not happen in practice
    (18 deviations at the usual 256 rows).
    """
    keep = min(1.0, 3.0 * size / max(points.count(), 1))
    modulus = 1_000_000_007
    draw = lambda t: F.pmod(
        F.xxhash64(F.lit(seed), t, *[F.col(k) for k in key]), F.lit(modulus)
    )
    drawn = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(trees - 1)),
            lambda t: F.struct(t.alias("tree"), draw(t).alias("draw")),
        ),
        lambda e: e["draw"] <= F.lit(int(keep * modulus)),
    )
    first = Window.partitionBy("tree").orderBy("draw", *key)
    return (
        points.withColumn("_d", F.explode(drawn))
        .select("_x", F.col("_d.tree").alias("tree"), F.col("_d.draw").alias("draw"), *key)
        .withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= size)
        .select("tree", "_x")
    )


def _grower(seed: int, size: int):
    extra_depth = [_average_path(n) for n in range(size + 1)]
    limit = deepest(size)

    def grow(pdf):
        import numpy as np

        tree = int(pdf["tree"].iloc[0])
        data = np.array(pdf["_x"].tolist())
        data = data[np.lexsort(data.T)]  # arrival order must not matter
        rng = np.random.default_rng(seed * 1_000_003 + tree)
        nodes = [None]
        todo = [(np.arange(len(data)), 0, 0)]
        while todo:
            rows, depth, at = todo.pop()
            part = data[rows]
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(rows) <= 1 or len(usable) == 0:
                nodes[at] = (tree, at, -1, 0.0, -1, -1, depth + extra_depth[len(rows)])
                continue
            feature = int(rng.choice(usable))
            cut = float(rng.uniform(low[feature], high[feature]))
            goes_left = part[:, feature] <= cut
            left, right = len(nodes), len(nodes) + 1
            nodes += [None, None]
            nodes[at] = (tree, at, feature, cut, left, right, 0.0)
            todo.append((rows[goes_left], depth + 1, left))
            todo.append((rows[~goes_left], depth + 1, right))
        return pd.DataFrame(
            nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "path"]
        )

    return grow


def _scorer(forest, normal: float):
    def score(values: pd.Series) -> pd.Series:
        import numpy as np

        x = np.array(values.tolist(), dtype=float).reshape(len(values), -1)
        depth = np.zeros(len(x))
        for feature, threshold, left, right, path in forest.value:
            node = np.zeros(len(x), dtype=int)
            inner = feature[node] >= 0
            while inner.any():
                at = node[inner]
                goes_left = x[inner, feature[at]] <= threshold[at]
                node[inner] = np.where(goes_left, left[at], right[at])
                inner = feature[node] >= 0
            depth += path[node]
        return pd.Series(2.0 ** (-(depth / len(forest.value)) / normal))

    return score


def deepest(size: int) -> int:
    """The greatest depth of a tree over a sample of this size."""
    return math.ceil(math.log2(max(size, 2)))


def normal_path(size: int) -> float:
    """The path length that a score of one half stands for."""
    return _average_path(size) or 1.0


def grown(
    df: DataFrame,
    columns: Sequence[str],
    key: Sequence[str] = ("date",),
    trees: int = 200,
    sample: int = 256,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, int]:
    """The rows with their standardised inputs `_x`, the nodes of all trees, and the size of a sample.

    Missing inputs take the column mean.
    """
    stats = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    scaled = []
    for i, c in enumerate(columns):
        mean, spread = stats[f"m{i}"] or 0.0, stats[f"s{i}"] or 1.0
        scaled.append((F.coalesce(F.col(c).cast("double"), F.lit(mean)) - mean) / F.lit(spread))
    points = materialize(df.withColumn("_x", F.array(*scaled)), "forest-input")
    samples = _tree_samples(points.select("_x", *key), key, trees, sample, seed)
    nodes = samples.groupBy("tree").applyInPandas(_grower(seed, sample), NODE_SCHEMA)
    return points, materialize(nodes, "forest-nodes"), min(sample, points.count())


def isolation_forest(
    df: DataFrame,
    columns: Sequence[str],
    contamination: float = 0.05,
    key: Sequence[str] = ("date",),
    trees: int = 200,
    sample: int = 256,
    seed: int = 42,
) -> DataFrame:
    """Adds `score` (higher = more unusual, 0 at the cut) and `is_outlier`.

    Inputs are standardised. The cut is the
    (1 - contamination) quantile of the raw scores.
    """
    points, nodes, size = grown(df, columns, key, trees, sample, seed)
    table = nodes.orderBy("tree", "node").toPandas()  # at most trees x 2 x sample rows
    forest = [
        (
            part["feature"].to_numpy(),
            part["threshold"].to_numpy(),
            part["left"].to_numpy(),
            part["right"].to_numpy(),
            part["path"].to_numpy(),
        )
        for _, part in table.groupby("tree")
    ]
    scorer = F.pandas_udf(
        _scorer(df.sparkSession.sparkContext.broadcast(forest), normal_path(size)), "double"
    )
    scored = materialize(points.withColumn("_raw", scorer("_x")), "forest-scores")
    cut = exact_quantiles(scored, {"_raw": [1.0 - contamination]})["_raw"][0]
    return (
        scored.withColumn("score", F.col("_raw") - F.lit(cut))
        .withColumn("is_outlier", F.col("score") > 0)
        .drop("_raw", "_x")
    )
