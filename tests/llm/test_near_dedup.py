import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm import brute
from tillwise.llm import components, near_dedup


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(90)]
    common = [f"p{i}" for i in range(55)]
    docs = []
    for _ in range(80):  # a large group of near copies around the limit
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
        docs.append(" ".join(text))
    for _ in range(60):  # a passage that many documents share
        docs.append(" ".join([*(rng.choice(vocabulary) for _ in range(40)), *common]))
    docs += [docs[0]] * 30 + [docs[100].upper()] + ["one two", "One  two", "three", "", None, "a b c d e", "a b c d e f"]
    return list(enumerate(docs, start=3))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 50), (7, 7), (None, 3), (70, 60)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 50: 50, 60: 50, 70: 50}
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_matches_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("node", "n", "kept", "sketch")})
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df, short=6).collect()}
    want = {i: (n, c, i == c) for i, (n, c) in brute.near_duplicates(docs).items()}
    assert got == want


def test_shared_values_are_counted_some_columns_at_a_time(monkeypatch):
    monkeypatch.setattr(near_dedup, "COLUMNS", 7)
    rng = np.random.default_rng(3)
    sides = [[rng.permutation(60)[: rng.integers(1, 40)] - 20 for _ in range(n)] for n in (9, 4)]
    x, y = ((np.array([len(s) for s in side]), np.concatenate(side)) for side in sides)
    assert near_dedup._intersections(x, y).tolist() == [[len(np.intersect1d(a, b)) for b in sides[1]] for a in sides[0]]
    assert not near_dedup._intersections((np.array([2]), np.array([1, 2])), (np.array([1]), np.array([3]))).any()


def test_members_outside_meet_all_others_of_their_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", 4)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 100)
    rng = np.random.default_rng(4)
    sets = [np.unique(np.concatenate([rng.permutation(16)[:13], rng.integers(16, 22, 2)])).tolist() for _ in range(60)]
    rows = [(g, bytes([i]), len(s), i % 7, i % 3 == 0, s) for i, s in enumerate(sets) for g in ("g", "h") if g == "g" or i % 2]
    df = spark.createDataFrame(rows, "main string, node binary, n long, part int, outside boolean, shingles array<long>")
    df = df.select("*", F.lit("key").alias("key"), F.col("n").alias("common"), F.col("part").cast("string").cast("binary").alias("component"))
    got = near_dedup._outside_links(df.drop("shingles"), df.select("node", "shingles").distinct(), 75).collect()
    want = {
        (i, j) for i in range(60) for j in range(i)
        if (i % 3 == 0 or j % 3 == 0) and i % 7 != j % 7
        and 100 * len({*sets[i]} & {*sets[j]}) >= 75 * len({*sets[i]} | {*sets[j]})
    }
    assert want and sorted((r["b"][0], r["a"][0]) for r in got) == sorted(want)


def test_small_sets_in_long_lists_match_brute_force(spark):
    rng = random.Random(8)
    docs = []
    for size in (7, 8, 9, 10, 13):
        text = [f"s{size}x{i}" for i in range(size)]
        docs += [" ".join(text), " ".join([*text, "more"]), " ".join(["first", *text])]
        docs += [" ".join([*text, *(f"t{rng.randrange(10**9)}" for _ in range(40))]) for _ in range(12)]
    docs = list(enumerate(docs, start=1))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(df, short=6).collect()}
    assert got == brute.near_duplicates(docs)
    assert got[2] == (4, 1)


def test_set_and_itself_plus_a_third_share_a_key():
    rng = np.random.default_rng(6)
    for n in (75, 150, 1500):
        for _ in range(200):
            whole = np.unique(rng.integers(-(2**63), 2**63, n * 4 // 3))
            part = np.sort(rng.permutation(whole)[: len(whole) * 3 // 4 + 1])
            assert np.isin(near_dedup.combination_keys(part), near_dedup.combination_keys(whole)).any()


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (2, "x"), (None, "y z"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, near_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted(
        [(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (2, 1, 2, True), (None, 1, None, False), (9, 0, 9, True)], key=str
    )
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in near_dedup.keep(df).collect())
    assert kept == [(0, "a b c d e f"), (0, "y z"), (2, "x"), (4, "a b c d e f"), (9, "")]


def test_empty_table(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text(spark):
    text = " ".join(f"w{i}" for i in range(30_000))
    df = spark.createDataFrame([(1, text), (2, text + " end")], "doc_id long, text string")
    assert {r["component_id"] for r in near_dedup.near_duplicates(df).collect()} == {1}
