from math import comb

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tillwise.llm import quality_rules as q

WORDS = " ".join(f"w{i}" for i in range(30))
TEXTS = [
    None, "", " \t\n", "a b c", WORDS, f"{WORDS}\n{WORDS}", "x " * 9, "x " * 8, f"{WORDS} # $$ |\x0b%\n\n{WORDS[:40]}\n{WORDS[:40]}",
    "é 日本 " * 40, "  " * 30, " ".join(f"v{i % 11}" for i in range(60)), f"{WORDS} {WORDS} tail",
]


def test_base_matches_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    docs = docs.withColumns({c: F.lit(1) for c in ("c", "l", "rules", "kept", "upper")})
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for r in q.judge(docs, labels).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == brute.quality(TEXTS[r["doc_id"]]), r
        assert r["kept"] is (not r["base_failed"])


@pytest.mark.parametrize(("k", "n", "p"), [(0, 10, 0.3), (3, 20, 0.2), (19, 20, 0.9), (20, 20, 0.5), (2, 500, 0.01), (150, 400, 0.4)])
def test_binomial_tail(k, n, p):
    exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert q.binomial_tail(k, n, p) == pytest.approx(exact, rel=1e-9)


def test_cutoffs_reject_junk_and_keep_good(spark):
    rows = [(i, f"{WORDS} number {i}", "en", 1) for i in range(3000)]
    rows += [(10_000 + i, f"{WORDS.upper()} NUMBER {i}", "en", 0) for i in range(100)]
    rows += [(20_000 + i, f"{WORDS.upper()} AGAIN {i}", lang, None) for i, lang in enumerate(["en", "xx", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    labels = df.select("doc_id", "quality")
    kept = {r["doc_id"]: (r["kept"], r["failed_rules"]) for r in q.judge(df.drop("quality"), labels).collect()}
    assert all(kept[i][0] for i in range(3000))
    assert not any(kept[10_000 + i][0] for i in range(100)) and kept[10_000][1] == ["uppercase"]
    assert [kept[20_000 + i][0] for i in range(3)] == [False, True, True]  # no evidence for other languages
    assert {r["doc_id"] for r in q.keep(df.drop("quality"), labels).collect()} == {i for i, k in kept.items() if k[0]}


def test_small_language_is_not_judged_by_rows_without_language(spark):
    rows = [(i, f"{WORDS} number {i}", None, 1) for i in range(3000)]
    rows += [(10_000 + i, f"{WORDS.upper()} NUMBER {i}", None, 0) for i in range(100)]
    rows += [(20_000 + i, f"{WORDS.upper()} CAPITALS {i}", "xx", 1) for i in range(50)]  # good, and too few for a cutoff
    rows += [(30_000, f"{WORDS.upper()} UNLABELLED", "xx", None), (30_001, f"{WORDS.upper()} UNLABELLED", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    labels = df.select("doc_id", "quality")
    kept = {r["doc_id"]: r["kept"] for r in q.judge(df.drop("quality"), labels).collect()}
    assert all(kept[20_000 + i] for i in range(50)) and kept[30_000]
    assert not kept[30_001] and not any(kept[10_000 + i] for i in range(100))
    assert {r["doc_id"] for r in q.keep(df.drop("quality"), labels).collect()} == {i for i, k in kept.items() if k}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert q.judge(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
