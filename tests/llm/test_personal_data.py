import hashlib

from pyspark.sql import functions as F

from tests.llm import brute
from tillwise.llm import personal_data as pd_

TEXTS = [
    "x a@b.com_c@d.org 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4", None, "", "+1 (255) 555-8013 and 4111 1111 1111 1111, 4111-1111-1111-1112",
    "a@b 12345678901234567890 +1" + "2" * 20, "9" * 20000 + " " + "a" * 3000 + "@ " + "1." * 500, "é😀 q@x.de 10.0.0.1 a.@-.-", "+12 +123456789",
]


def test_base_spans_match_plain_regex(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, "z@y.com"), (1, "again 1.1.1.1")], "doc_id long, text string")
    df = df.withColumns({c: F.lit(1) for c in ("base", "spans", "more", "found")})
    for r in pd_.digest(pd_.find_personal_data(df)).collect():
        texts = {"z@y.com"} if r["doc_id"] is None else {TEXTS[r["doc_id"]], "again 1.1.1.1"} if r["doc_id"] == 1 else {TEXTS[r["doc_id"]]}
        wanted = []
        for text in texts:
            found = brute.spans(text)
            joined = ",".join(f"{pd_.KINDS[k]}:{a}:{b}" for a, k, b in found)
            wanted.append((*(sum(x[1] == i for x in found) for i in range(4)), hashlib.sha256(joined.encode()).hexdigest()))
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) in wanted


def test_trees_add_unmarked_phones(spark):
    rows = []
    for i in range(900):
        number = f"({200 + i % 700}) {100 + i * 7 % 900}-{1000 + i * 37 % 9000}"
        rows.append((i, f"call +1 {number} now" if i % 3 else f"version +{i % 10}{i % 7} {i % 9}-{i % 8} and +{i * 7919} kg"))
    rows.append((5000, "please call (415) 555-2671 now"))
    rows.append((5001, "no number 2023 here"))
    got = {r["doc_id"]: pd_ and r["spans"] for r in pd_.digest(pd_.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), 0.9)).collect()}
    assert got[5000] == "phone:12:26"
    assert got[5001] == ""


def luhn_number(i):
    body = f"4{i * 7_919_317 % 10**14:014d}"
    return next(body + str(d) for d in range(10) if brute.luhn(body + str(d)))


def test_addresses_and_cards_of_other_forms(spark):
    rows = []
    for i in range(1800):
        card = luhn_number(i)
        wrong = card[:-1] + str((int(card[-1]) + 1 + i % 8) % 10)
        shape = lambda n: f"{n[:4]} {n[4:8]} {n[8:12]} {n[12:]}"
        number = f"({200 + i % 700}) {100 + i * 7 % 900}-{1000 + i * 37 % 9000}"
        rows.append((i, {
            0: f"write to user{i}@host{i % 50}.org, server at 10.{i % 256}.{i * 7 % 256}.{i * 13 % 256} up",
            1: f"pay with card {shape(card)} please, call +1 {number} now",
            2: f"handle bob{i}@site and file a{i % 9}.txt, version {i % 9}.{i % 7}.{i % 5} or {256 + i}.1.2.3, order no {shape(wrong)}, +{i * 7919} kg",
        }[i % 3]))
    forms = {
        9000: "mail jane (at) corner (dot) org today", 9001: "mail jane at corner dot org today", 9002: "host 10 . 20 . 30 . 40 is up",
        9003: "server 10[.]20[.]30[.]40 is up", 9004: f"card {'.'.join(luhn_number(7)[j:j + 4] for j in (0, 4, 8, 12))} ok",
        9006: "we met at noon. Then 3 . 5 of 900 . 1 . 2 . 3 were at home", 9007: "card 4111.1111.1111.1112 ok",
    }
    docs = spark.createDataFrame(rows + list(forms.items()), "doc_id long, text string")
    found = pd_.find_personal_data(docs, 0.95)
    got = {r["doc_id"]: r["spans"] for r in pd_.digest(found).where("doc_id >= 9000").collect()}
    spot = lambda i, kind, part: f"{kind}:{forms[i].index(part)}:{forms[i].index(part) + len(part)}"
    assert got[9000] == spot(9000, "email", "jane (at) corner (dot) org")
    assert got[9001] == spot(9001, "email", "jane at corner dot org")
    assert got[9002] == spot(9002, "ip", "10 . 20 . 30 . 40")
    assert got[9003] == spot(9003, "ip", "10[.]20[.]30[.]40")
    assert spot(9004, "card", forms[9004][5:24]) in got[9004]
    assert got[9006] == "" and "card" not in got[9007]
    # strict spans stay as they are
    for r in found.where("doc_id < 9000").collect():
        assert [tuple(b) for b in r["base"]] == brute.spans(dict(rows)[r["doc_id"]])
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))


def test_tree_expressions_score_like_the_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = [(float((i * i + i * 7 % 13) % 11 > 4), [float(i * 7 % 13), float(i % 3), float(i % 5)]) for i in range(300)]
    df = spark.createDataFrame(rows, "label double, x array<double>").selectExpr("label", "x", "x[0] a", "x[1] b", "x[2] c")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = GBTClassifier(maxIter=6, maxDepth=3, seed=1).fit(df)
    trees = pd_.Acceptance([(float(w), pd_._tree(t._java_obj.rootNode())) for w, t in zip(model.treeWeights, model.trees, strict=True)])
    both = model.transform(df).select(F.round(vector_to_array("probability")[1], 3).alias("a"), trees.score(F.col("x")).alias("b"))
    assert both.where("abs(a - b) > 0.0011").count() == 0 and both.select("a").distinct().count() > 3


def test_redaction(spark):
    df = spark.createDataFrame([(1, "mail a@b.com, ip 1.2.3.4.", "k"), (2, None, None), (3, "none", "k")], "doc_id long, text string, row string")
    got = {r["doc_id"]: (r["text"], r["row"]) for r in pd_.redacted(df.withColumn("n_chars", F.lit(0).cast("long"))).collect()}
    assert got == {1: ("mail <email>, ip <ip>.", "k"), 2: (None, None), 3: ("none", "k")}


def test_empty(spark):
    assert pd_.find_personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0
