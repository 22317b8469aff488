import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import hard_negatives as hn


def brute(rows, positives=5, negatives=3, low=50, high=95):
    whole = lambda e: e and all(x is not None and math.isfinite(x) for x in e)
    ints = [(i, y, [math.floor(256 * x) for x in e]) for i, e, y in rows if i is not None and y is not None and whole(e)]
    out = []
    for q, label, x in ints:
        if q % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, e, strict=True)), i, y) for i, y, e in ints if i != q and len(e) == len(x))
        for p, pid, _ in [s for s in scored if s[2] == label][:positives]:
            hard = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p]
            out += [(q, pid, r, i, -p, -s) for r, (s, i, _) in enumerate(hard[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    vectors = vectors.withColumns({c: F.lit(1) for c in ("block", "rank", "score", "clabel", "ids")})
    return sorted(map(tuple, hn.mine(vectors, vectors.where("vec_id % 50 = 0"), **options).collect()))


def clustered(n=260, classes=4, dims=6):
    rng = np.random.default_rng(13)
    centres = rng.normal(0, 0.4, (classes, dims)) + 0.3
    return [(i, (centres[i % classes] + rng.normal(0, 0.15, dims)).tolist(), int(rng.integers(classes)) if i % 9 == 0 else i % classes) for i in range(n)]


@pytest.mark.parametrize("blocks", [(256, 2048), (3, 7)])
def test_matches_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(hn, "ANCHOR_ROWS", blocks[0])
    monkeypatch.setattr(hn, "CANDIDATE_ROWS", blocks[1])
    rows = clustered()
    rows += [(i, rows[50][1], i % 3) for i in range(300, 340)]  # many ties
    rows += [(400, None, 1), (401, [1.0, None, 2.0, 0.0, 0.0, 0.0], 1), (402, [float("nan")] * 6, 2), (403, [float("inf")] * 6, 0)]
    rows += [(None, [0.5] * 6, 1), (450, [5.0, 1.0], 0), (500, [2.0, -3.0], 0), (501, [1.0, 0.5], 2), (550, [0.5] * 6, None), (600, [], 1)]
    rows += [rows[7], rows[100], (150, [0.5] * 6, 2), (650, [0.0] * 6, 1), (700, [-0.9] * 6, 3)]
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 30
    assert mined(spark, rows, positives=2, negatives=9, low=-50, high=99) == brute(rows, 2, 9, -50, 99)


def test_hot_label_few_rows_and_large_components(spark):
    rows = [(i, [0.1 * (i % 7), 0.3], 0 if i else 1) for i in range(120)]  # all rows but one have one label
    assert mined(spark, rows) == brute(rows)
    rows = [(0, [1e6, 1.0], 1), (50, [1e6, 2.0], 1), (2, [9e5, 0.5], 2), (3, [6e5, -1e6], 2)]  # bounds in doubles do not hold
    assert mined(spark, rows) == brute(rows) and brute(rows)
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, []) == []


def block(rows):
    data = np.array([r[1] for r in rows], np.int64)
    return np.array([r[0] for r in rows], np.int64).tobytes(), data.tobytes(), int(abs(data).max())


def test_tree_bounds_hold_and_rule_out():
    rng = np.random.default_rng(5)
    anchors = [(i, rng.integers(90, 110, 8)) for i in range(40)]
    candidates = [(1000 + i, rng.integers(-100, 120, 8)) for i in range(3000)]
    order, parent, edge = hn.spanning_tree(np.array([a[1] for a in anchors]))
    assert sorted(order) == list(range(40)) and (parent < 0).sum() == 1
    for i in order[1:]:
        assert edge[i] >= math.dist(anchors[i][1], anchors[parent[i]][1])
    (ids, data, top), (cids, cdata, ctop) = block(anchors), block(candidates)
    pair = hn.Pair({"ids": ids, "data": data, "top": top, "dim": 8, "cids": cids, "cdata": cdata, "ctop": ctop})
    scores = np.array([a[1] for a in anchors]) @ np.array([c[1] for c in candidates]).T

    def wanted(anchor, at, low, high):
        assert (low <= scores[anchor, at]).all() and (scores[anchor, at] <= high).all()
        return high >= 70_000

    for anchor, at, found in pair.walk(wanted):
        assert (found == scores[anchor, at]).all()
        assert set(np.flatnonzero(scores[anchor] >= 70_000)) <= set(at)
    assert pair.scored < 0.6 * scores.size


def test_noisy_labels(spark):
    rows = [(7, 9), (14, 3), (3, 4), (21, None), (None, 2)]
    frame = spark.createDataFrame(rows, "vec_id long, label int")
    got = {r["vec_id"]: r["label"] for r in hn.noisy_labels(frame).collect()}
    assert got == {7: 0, 14: 4, 3: 4, 21: None, None: 2}
