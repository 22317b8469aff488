import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import exact_topk as topk


def brute(vectors, queries, k):
    whole = lambda e: e and all(x is not None and math.isfinite(x) for x in e)
    ints = lambda rows: [(i, [math.floor(256 * x) for x in e]) for i, e in rows if i is not None and whole(e)]
    candidates, out = ints(vectors), []
    for q, x in ints(queries):
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in candidates if i != q and len(x) == len(y))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(256, 2048), (3, 7)])
def test_matches_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_ROWS", blocks[0])
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", blocks[1])
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 0.2, 6).tolist()) for i in range(220)]
    rows += [(i, rows[3][1]) for i in range(300, 340)]  # many ties
    rows += [(400, None), (401, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, [0.0] * 6),
             (450, [5.0, 1.0]), (500, [2.0, -3.0]), (7, rows[7][1]), (150, [0.5] * 6), (600, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("block", "dim", "score")})
    queries = [r for r in rows if r[0] is not None and r[0] % 50 == 0]
    got = topk.exact_topk(vectors, vectors.where("vec_id % 50 = 0"), 5).collect()
    assert sorted(map(tuple, got)) == brute(rows, queries, 5)


def test_large_components_and_few_candidates(spark):
    rows = [(0, [1e9, 1.0]), (1, [-2e9, 3.0]), (2, [1e9, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.exact_topk(vectors, vectors.where("vec_id = 0"), 5).collect()
    clipped = [(q, r, i, max(-topk.CUT, min(topk.CUT, s))) for q, r, i, s in brute(rows, rows[:1], 5)]
    assert sorted(map(tuple, got)) == clipped
    assert topk.exact_topk(vectors.limit(0), vectors.limit(0), 5).count() == 0
