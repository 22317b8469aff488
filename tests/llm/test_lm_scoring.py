import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as public
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import words
from tillwise.llm import attention, lm_scoring

ARGS = (public.path("byte_bpe_50k.tiktoken"), public.PATTERN, 50256, 50257)


def test_gradients_match_differences(monkeypatch):
    monkeypatch.setattr(attention, "WIDTH", 4)
    rng = np.random.default_rng(1)
    params = {k: rng.standard_normal(s) * 0.3 for k, s in attention.shapes(6).items()}
    x = rng.integers(0, 6, 70)
    lengths = np.array([50, 20])
    doc, first, _ = attention.windows(lengths)
    parts = attention.gather(x, np.array([0, 50]), lengths, doc, first, 6)
    valid = parts[3]
    assert valid.sum() == 70

    def loss(p):
        return -(attention.log_shares(p, *parts[:3]) * valid).sum() / valid.sum()

    grads = attention.gradients(params, *parts)
    for name in attention.NAMES:
        at = tuple(rng.integers(0, n) for n in params[name].shape)
        step = {**params, name: params[name].copy()}
        step[name][at] += 1e-5
        back = {**params, name: params[name].copy()}
        back[name][at] -= 1e-5
        assert grads[name][at] == pytest.approx((loss(step) - loss(back)) / 2e-5, rel=1e-3, abs=1e-6), name


def test_no_token_sees_itself_or_later_ones(monkeypatch):
    monkeypatch.setattr(attention, "WIDTH", 4)
    rng = np.random.default_rng(2)
    params = {k: rng.standard_normal(s) for k, s in attention.shapes(6).items()}
    lengths, start = np.array([60]), np.array([0])
    doc, first, _ = attention.windows(lengths)

    def scores(x):
        return attention.log_shares(params, *attention.gather(x, start, lengths, doc, first, 6)[:3]).ravel()[:60]

    x = rng.integers(0, 6, 60)
    y = x.copy()
    y[40] = (x[40] + 1) % 6
    assert np.allclose(scores(x)[:40], scores(y)[:40]) and not np.allclose(scores(x)[41:], scores(y)[41:])


def test_products_taken_once_a_class_give_the_same_attention():
    rng = np.random.default_rng(9)
    params = attention.initial(np.full(64, 1 / 64))
    lengths = np.array([50, 3, 1, 200])
    doc, first, _ = attention.windows(lengths)
    x, real, *_ = attention.gather(rng.integers(0, 64, 254), np.cumsum(lengths) - lengths, lengths, doc, first, 64)
    assert np.allclose(attention._top(params, x, real), attention._forward(params, x, real)[-1], atol=1e-5)


def test_targets_of_few_groups_leave_the_others_alone():
    rng = np.random.default_rng(10)
    params = attention.initial(np.full(64, 1 / 64))
    lengths = np.array([40])
    doc, first, _ = attention.windows(lengths)
    parts = attention.gather(np.resize([8, 9, 63], 40), np.array([0]), lengths, doc, first, 64)
    grads = attention.gradients(params, *parts)
    assert [g for g in range(8) if grads["inner"][g].any() or grads["inner_bias"][g].any()] == [1, 7]
    assert np.flatnonzero(grads["embed"].any(1)).tolist() == [8, 9, 63, 64]
    for i in rng.permutation(8):
        order = rng.permutation(40)[: i + 1]
        found, ranges = attention._sorted_by(order % 8, 8)
        assert sorted(found) == list(range(len(order))) and all((order[found[a:b]] % 8 == g).all() and a < b for g, a, b in ranges)


def test_parameters_are_updated_in_place():
    start = attention.initial(np.full(64, 1 / 64))
    adam, rng = attention.Adam(attention.unflat(attention.flat(start), 64), 0.01), np.random.default_rng(11)
    m = v = 0.0
    for step in (1, 2, 3):
        grads = {k: rng.standard_normal(x.shape).astype(np.float32) for k, x in start.items()}
        m, v = 0.9 * m + 0.1 * grads["out"], 0.99 * v + 0.01 * grads["out"] ** 2
        start["out"] = start["out"] - 0.01 * (m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8))
        adam.update(grads)
        assert np.allclose(adam.params["out"], start["out"], atol=1e-6) and np.shares_memory(adam.params["out"], adam.vector)


def corpus():
    rng = np.random.default_rng(4)
    docs = [(i, " ".join(rng.choice(["the cat", "a Dog", "sat on", "mat.", "RUNS"], 40))) for i in range(120)]
    return [*docs, (500, None), (501, ""), (502, "\x0b the\tcat é"), (None, "the cat"), (502, "unseenword"), (700, "x" * 40_000)]


def test_base_scores_match_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("held", "block", "ids", "words")})
    got = lm_scoring.score_documents(docs, *ARGS).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    split = [(i, [*words("".join(c.lower() if c.isascii() else c for c in t or "")), "\0end"]) for i, t in rows]
    counts = Counter(w for i, w in split if not held(i) for w in w)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), held(i), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6))
        for i, w in split
    )
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    score = {r["doc_id"]: r["score"] for r in got}
    assert all(math.isfinite(s) and s < 0 for s in score.values())
    # held-out documents are likelier than by the shares of their subwords
    encoding = lm_scoring._encoding(*ARGS[:2])
    ids = {i: [*encoding.encode_ordinary((t or "").lower()), 50256] for i, t in rows if i is not None and i < 120}
    seen = Counter(x for i, own in ids.items() if not held(i) for x in own)
    known = [i for i in ids if held(i)]
    plain = sum(math.log10((seen[x] + 0.5) / (sum(seen.values()) + 0.5 * 50257)) for i in known for x in ids[i])
    assert sum(score[i] for i in known) > plain


def test_classes_and_empty(spark):
    classes = lm_scoring.deal_classes(np.arange(2000)[::-1], 64, 48)
    assert classes[:48].tolist() == list(range(48)) and set(classes) == set(range(64))
    assert lm_scoring.score_documents(spark.createDataFrame([], "doc_id long, text string"), *ARGS).count() == 0


def test_rounds_train_on_every_window_once():
    rng = np.random.default_rng(3)
    lengths = np.concatenate([rng.integers(1, 30, 200), [639, 640, 5000]])
    held = rng.random(len(lengths)) < 0.2
    doc, _, number = attention.windows(lengths)
    taken = np.concatenate([lm_scoring._windows_of_round(held, doc, number, r) for r in range(lm_scoring.ROUNDS)])
    assert sorted(taken) == np.flatnonzero(~held[doc]).tolist()


def test_one_short_document_is_trained_on(spark):
    ids = lm_scoring._pack(np.array([5, 6, 7, 50256], np.uint32))
    df = spark.createDataFrame([(1, [False], [4], ids)], "block long, held array<boolean>, n_ids array<long>, ids binary")
    class_of = lm_scoring.deal_classes(np.arange(50257)[::-1], 64, 48)
    start = attention.flat(attention.initial(np.full(64, 1 / 64))).astype(float)
    rounds = [lm_scoring._train(df, 1, class_of, start, 64, r) for r in range(lm_scoring.ROUNDS)]
    assert sum(not np.array_equal(r, start) for r in rounds) == 1


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 6000)
    rows = [*corpus(), (None, "the cat"), (None, None)]
    schema = "doc_id long, text string"
    one = spark.createDataFrame(rows, schema).coalesce(1)
    four = spark.createDataFrame(rows[::-1], schema).repartition(4)
    scores = [
        sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in lm_scoring.score_documents(d, *ARGS).collect()) for d in (one, four)
    ]
    assert len(scores[0]) == len(rows) and [x[:2] for x in scores[0]] == [x[:2] for x in scores[1]]
    assert np.allclose([x[2] for x in scores[0]], [x[2] for x in scores[1]], rtol=1e-5)


def test_blocks_hold_each_row_once_and_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 3000)
    rows = [*corpus(), *[(900, "the same text")] * 300]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held", F.lit(False))
    blocks = lm_scoring._blocks(docs, *ARGS[:3]).select("block", "doc_ids").collect()
    assert len({b["block"] for b in blocks}) == len(blocks) > 15
    assert sorted(str(i) for b in blocks for i in b["doc_ids"]) == sorted(str(i) for i, _ in rows)

    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 2000)
    batches = lm_scoring._sharded(docs).select("shard", "doc_id", "held", "text").toArrow().to_batches(max_chunksize=7)
    pieces = list(lm_scoring._pieces(iter(batches)))
    assert len({n for n, _ in pieces}) == len(pieces)
    assert sorted((str(i), t.decode()) for _, p in pieces for i, _, t in p) == sorted((str(i), t or "") for i, t in rows)
    assert all(sum(len(t) for _, _, t in p) <= 2000 or len(p) == 1 for _, p in pieces)
    assert max(len(p) for _, p in pieces if p[0][0] == 900) > 50


def test_vectors_are_added_up_in_groups(spark):
    vectors = spark.createDataFrame([(i, bytearray(np.array([i, 1]).tobytes())) for i in range(600)], "slot long, vector binary")
    assert lm_scoring._vector_sum(vectors, 600, 2, np.int64).tolist() == [sum(range(600)), 600]
    assert lm_scoring._vector_sum(vectors.limit(0), 0, 2, np.int64).tolist() == [0, 0]
