import zlib

import numpy as np
from pyspark.sql import functions as F

from tillwise.llm import toxicity


def corpus(n=1500):
    rng = np.random.default_rng(6)
    plain = [f"plain{i}" for i in range(60)]
    rows = []
    for i in range(n):
        text = list(rng.choice(plain, 30))
        toxic = int(i % 8 == 0)
        if toxic:
            for _ in range(3):
                bad = rng.choice(["Rotten!", "vile", "grubby,", f"scrot{rng.integers(10**6)}"])
                text[rng.integers(30)] = str(bad)
        rows.append((i, " ".join(text), toxic))
    return rows


def test_planted_words_and_prefixes(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(9001, None), (9002, ""), (None, "you vile rotten scrotx"), (9003, "VILE")], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("hits", "score", "votes", "toxic")})
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2 == 0] + [(None, 1), (3, None), (0, 1)], "doc_id long, toxic int")
    got = toxicity.score(docs, labels).collect()
    assert len(got) == len(rows) + 4
    by_id = {r["doc_id"]: r for r in got}
    for i, _, y in rows:
        assert by_id[i]["predicted"] == y and 0 <= by_id[i]["score"] <= 1
        assert by_id[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert [by_id[i]["predicted"] for i in (9001, 9002, None, 9003)] == [0, 0, 1, 1]
    kept = toxicity.keep(docs, labels)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in by_id.items() if not r["predicted"]}
    assert kept.columns == docs.columns


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a vile text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [tuple(r) for r in toxicity.score(docs, none).collect()] == [(1, False, 0.0, 0)]
    assert toxicity.score(docs.limit(0), none).count() == 0


def test_label_model_finds_rates():
    rng = np.random.default_rng(9)
    y = rng.random(20000) < 0.2
    votes = (rng.random((20000, 6)) < np.where(y[:, None], 0.7, 0.05)).astype(int)
    votes[:, 5] = votes[:, 4]  # a voter that copies another
    seen, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = toxicity.LabelModel(seen, counts.astype(float), np.clip(seen.mean(1), 0.02, 0.98))
    assert abs(model.prior[1] - 0.2) < 0.03
    assert ((model.posterior(seen)[at.ravel()] > 0.5) == y).mean() > 0.97
    assert {model.parent[4], model.parent[5]} & {4, 5}
