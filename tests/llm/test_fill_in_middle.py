import hashlib
import re

from pyspark.sql import functions as F

from tillwise.llm import fill_in_middle as fim

SHA = lambda t: hashlib.sha256(t.encode()).hexdigest()


def plain_version(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or doc_id is None or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    digits = SHA(f"7:{doc_id}")
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))
    if h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows():
    texts = ["one\ntwo\nthree", "\n", "\n\n\n", "no break", "é\U0001f600\r\nß\n", "a <M> b\nc", "<\nP>\n<S\n>", "ends in <\nP\n", "", None]
    texts += ["\n".join(f"line {i} {'x' * (i % 7)}" for i in range(20_000)), "y" * 300_000, "<P" * 500 + "\n" + ">" * 50]
    out = [(i * 31 + j, t) for i, t in enumerate(texts) for j in range(8)]
    return out + [out[0], out[0], (None, "one\ntwo"), (None, None), (-5, "a\nb\nc\nd")]


def test_matches_a_plain_version_and_restores(spark):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({c: F.lit(1) for c in ("n", "form", "output", "prefix_chars")})
    out = fim.transform(docs)
    key = lambda r: tuple((x is not None, x) for x in r)
    got = sorted((tuple(r) for r in out.collect()), key=key)
    assert got == sorted(((i, *plain_version(i, t)) for i, t in data), key=key)
    digests = fim.digest(out).collect()
    want = sorted(((i is not None, i or 0, SHA(t or "")) for i, t in data))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["restored_sha256"]) for r in digests) == want
    assert {r["form"] for r in digests} == {"plain", "psm", "spm"}


def test_parameters(spark):
    docs = spark.createDataFrame([(i, "a\nb c\n") for i in range(200)], "doc_id long, text string")
    got = fim.transform(docs, rate=30, spm=0).collect()
    assert sorted(tuple(r) for r in got) == [(i, *plain_version(i, "a\nb c\n", 30, 0)) for i in range(200)]
    words = fim.transform(docs, unit=r"\S++\s*+").collect()
    assert {r["n"] for r in words} == {3}
    none = fim.transform(docs, unit="z").collect()  # a unit that does not cover the text
    assert {(r["n"], r["form"], r["output"]) for r in none} == {(0, "plain", "a\nb c\n")}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.digest(fim.transform(docs)).count() == 0
