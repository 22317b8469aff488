"""Personal data in texts: strict patterns, and more spans chosen by boosted trees.

Wide generators propose overlapping candidates of every kind, in several forms: as the strict patterns write them, near misses of
these (handles, versions, numbers that fail a check) and forms that the strict patterns don't know (an at sign or dots
spelled out, spaced or bracketed dots, other separators, numbers without the plus sign). Candidates in strict form are labelled
by the strict patterns and their checks; boosted trees per kind learn from their format and context, after the separators
are made alike. On held-out documents an exact binomial bound per kind calibrates the score from which a candidate of another
form is accepted; without enough evidence none is. Features are small whole numbers, so training runs on their
distinct combinations, and the trees score the candidates as expressions. Everything is DataFrame functions and MLlib.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import bind, fold_of
from tillwise.llm.quality_rules import binomial_tail
from tillwise.session import materialize

KINDS = ["email", "ip", "card", "phone"]
#: The strict patterns. Possessive runs and the guard at a run's start match the same spans as the plain forms, in
#: linear time and without recursion.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"\x20?[(\[{]\x20?(?:at|AT)\x20?[)\]}]\x20?"
_DOT = r"\x20?[(\[{]\x20?(?:dot|DOT|\.)\x20?[)\]}]\x20?"
_NAME, _LABEL = r"[A-Za-z0-9._%+-]++", r"[A-Za-z0-9-]++"
_START = r"(?:(?<![A-Za-z0-9._%+-])|\G)"
#: Forms of candidates by kind.
WIDE = {
    "email": [
        rf"{_START}{_NAME}(?:@|{_AT}){_LABEL}(?:(?:\.|{_DOT}){_LABEL})*+",
        rf"{_START}{_NAME}\x20(?:at|AT)\x20{_LABEL}(?:\x20(?:dot|DOT)\x20{_LABEL})++",
        rf"{_START}{_NAME}\x20@\x20{_LABEL}(?:\x20?\.\x20?{_LABEL})++",
        # an address without its at sign
        rf"(?<![A-Za-z0-9._%+@-]){_LABEL}(?:\.{_LABEL})++(?!@)",
    ],
    "ip": [rf"(?<![0-9])[0-9]++(?:(?:\x20?\.\x20?|{_DOT})[0-9]++)++"],
    "card": [r"[0-9](?:[\x20-]?[0-9])++", r"(?<![0-9])[0-9]++(?:[\x20./_:-]{1,3}+[0-9]++)++"],
    "phone": [r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9])++", r"(?<![0-9])[0-9]++(?:[/._\x20-]{1,2}+[0-9]++)++"],
}
#: The digits of a candidate, at least and at most.
DIGITS = {"email": (0, 10_000), "ip": (2, 24), "card": (10, 24), "phone": (7, 20)}
#: Letters of a text before a candidate in which these words count as context.
BEFORE = 24
CONTEXT = {
    "email": r"(?i)mail|write|reach|contact",
    "ip": r"(?i)\bip\b|host|server|address|from",
    "card": r"(?i)card|visa|credit|pay|account",
    "phone": r"(?i)phone|tel|call|fax|mobile|contact",
}
FEATURES = ["length", "groups", "first", "last", "check", "dashes", "digits", "context", "left", "right"]
#: Least precision of accepted candidates on held-out documents, and the chance to miss it.
PRECISION, CHANCE = 0.98, 0.05
TREES, DEPTH = 12, 3
SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, found) of a pattern's matches, in code points. The gaps between matches give the places."""

    def placed(found: Column) -> Column:
        def walk(gaps: Column) -> Column:
            step = lambda a, i: bind(
                a["at"] + F.length(F.get(gaps, i)),
                lambda s: F.struct(
                    (s + F.length(F.get(found, i))).alias("at"),
                    F.concat(a["out"], F.array(F.struct(s.alias("start"), (s + F.length(F.get(found, i))).alias("end"), F.get(found, i).alias("found")))).alias("out"),
                ),
            )
            start = F.struct(F.lit(0).alias("at"), none.alias("out"))
            return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, step)["out"]

        return F.when(F.size(found) == 0, none).otherwise(bind(F.split(text, pattern, -1), walk))

    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a run of digits passes the check sum."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(values, lambda v, i: F.when(i % 2 == 1, 2 * v - F.when(v > 4, 9).otherwise(0)).otherwise(v))
    return F.aggregate(doubled, F.lit(0), lambda a, v: a + v) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda p: (F.length(p) <= 3) & (F.coalesce(F.when(p == "", "0").otherwise(p).try_cast("int"), F.lit(999)) <= 255)
        return F.forall(F.split(found, r"\."), lambda p: small(F.ltrim(p, F.lit("0"))))
    n = F.length(_digits(found))
    if kind == "card":
        return n.between(12, 19) & F.when(n.between(12, 19), _luhn(_digits(found))).otherwise(False)
    return n.between(9, 15)


def base_spans(text: Column, kind: str) -> Column:
    """Array of (start, end, found) that the strict pattern and its checks accept."""
    return F.filter(_spans(text, STRICT[kind]), lambda s: _valid(kind, s["found"]))


def _alike(kind: str, found: Column) -> Column:
    """A candidate with its separators written in one way."""
    if kind == "email":
        at = F.regexp_replace(found, rf"{_AT}|\x20(?:at|AT|@)\x20", "@")
        return F.regexp_replace(at, rf"{_DOT}|\x20(?:dot|DOT)\x20|\x20?\.\x20?", ".")
    if kind == "ip":
        return F.regexp_replace(found, rf"{_DOT}|\x20?\.\x20?", ".")
    return F.regexp_replace(F.regexp_replace(found, r"^[+(]", ""), "[^0-9]+", " ")


def _strict_form(kind: str, found: Column) -> Column:
    """Whether a candidate is written as the strict pattern writes them, right or not."""
    return {
        "email": found.rlike(r"^[A-Za-z0-9._%+@-]+$"),
        "ip": found.rlike(r"^[0-9.]+$"),
        "card": found.rlike(r"^[0-9](?:[\x20-]?[0-9])+$"),
        "phone": found.startswith("+"),
    }[kind]


def _features(kind: str, text: Column, s: Column) -> list[Column]:
    """Small whole numbers that describe a candidate and its surroundings, whatever its separators."""
    most = lambda c, n: F.least(c, F.lit(n)).cast("int")
    edge = lambda c: F.when(c == "", 0).when(c.rlike(r"[\x20\x09-\x0D]"), 1).when(c.rlike("[A-Za-z]"), 2).when(c.rlike("[0-9]"), 3).otherwise(4)
    head = F.substring(text, F.greatest(s["start"] - (BEFORE - 1), F.lit(1)), F.least(s["start"], F.lit(BEFORE)))

    def shape(body: Column) -> Column:
        digits = F.length(_digits(body))
        tail = F.when(body.contains("@"), F.substring_index(body, "@", -1)).otherwise("") if kind == "email" else body
        parts = F.filter(F.split(tail, r"[.]" if kind in ("email", "ip") else "[^0-9]+"), lambda p: p != "")

        def counted(p: Column) -> Column:
            first, last = F.length(F.coalesce(F.get(p, F.lit(0)), F.lit(""))), F.coalesce(F.get(p, F.size(p) - 1), F.lit(""))
            check = {
                "email": lambda: last.rlike("^[A-Za-z]{2,}$"),
                "ip": lambda: _valid("ip", body),
                "card": lambda: F.when(digits.between(12, 19), _luhn(_digits(body))).otherwise(False),
                "phone": lambda: digits.between(9, 15),
            }[kind]()
            return F.array(
                most(F.length(body), 30), most(F.size(p), 8), most(first, 8), most(F.length(last), 8), check.cast("int"),
                most(F.length(body) - F.length(F.translate(body, "-", "")), 4), most(digits, 20),
            )

        return bind(parts, counted)

    return F.concat(
        bind(_alike(kind, s["found"]), shape),
        F.array(
            head.rlike(CONTEXT[kind]).cast("int"),
            edge(F.when(s["start"] > 0, F.substring(text, s["start"], F.lit(1))).otherwise("")),
            edge(F.substring(text, s["end"] + 1, F.lit(1))),
        ),
    )


def candidates(text: Column, base: Column) -> Column:
    """Array of (kind, start, end, marked, label, x) that the wide generators propose; base is the struct of strict spans by kind.

    marked: in strict form, or over a span of another kind, so that label says whether it is one; the others are open.
    """
    out = []
    for kind, patterns in WIDE.items():
        if kind in ("email", "phone"):
            inside = lambda s: F.exists(base[kind], lambda b: (b["start"] <= s["start"] + 1) & (b["end"] >= s["end"]))  # noqa: E731, B023
        else:
            inside = lambda s: F.exists(base[kind], lambda b: (b["start"] == s["start"]) & (b["end"] == s["end"]))  # noqa: E731, B023
        other = lambda s: F.exists(
            F.flatten(F.array(*(base[k] for k in KINDS if k != kind))), lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"])  # noqa: B023
        )
        low, high = DIGITS[kind]
        for pattern in patterns:
            spans = _spans(text, pattern)
            if kind != "email":
                spans = F.filter(spans, lambda s: F.length(_digits(s["found"])).between(low, high))  # noqa: B023
            out.append(F.transform(spans, lambda s: F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),  # noqa: B023
                (_strict_form(kind, s["found"]) | other(s)).alias("marked"),  # noqa: B023
                (inside(s) & ~other(s)).alias("label"),  # noqa: B023
                _features(kind, text, s).alias("x"),  # noqa: B023
            )))
    return F.array_distinct(F.concat(*out))


#: A tree: a number at a leaf, or feature, threshold, left and right.
Tree = float | tuple


def _tree(node) -> Tree:
    """A fitted tree as numbers; features are whole numbers, so every split compares."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def _walk(tree: Tree, x: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, threshold, left, right = tree
    return F.when(F.get(x, F.lit(feature)) <= F.lit(threshold), _walk(left, x)).otherwise(_walk(right, x))


class Acceptance:
    """The trees of a kind with their weights, and the score from which a candidate is accepted."""

    def __init__(self, trees: list[tuple[float, Tree]], cut: float | None = None):
        self.trees, self.cut = trees, cut

    def score(self, x: Column) -> Column:
        """Probability in thousandths."""
        margin = sum((F.lit(w) * _walk(t, x) for w, t in self.trees), F.lit(0.0))
        return F.round(1 / (1 + F.exp(-2 * margin)), 3)


def learn(found: DataFrame, precision: float = PRECISION, chance: float = CHANCE) -> dict[str, Acceptance]:
    """The calibrated trees of every kind that has any, from rows (doc_id, more)."""
    flat = found.select(
        F.coalesce(fold_of(F.col("doc_id")) == 1, F.lit(False)).alias("held"), F.explode("more").alias("c")
    ).groupBy("held", "c.kind", "c.marked", "c.label", "c.x").count()
    grouped = materialize(
        flat.select("held", "kind", "marked", F.col("label").cast("double").alias("label"), "x", F.col("count").cast("double").alias("n")),
        "personal-patterns",
    )
    out = {}
    # two labels a kind at most
    sizes = {(r["kind"], r["label"]) for r in grouped.where("marked and not held").select("kind", "label").distinct().collect()}
    open_kinds = {r["kind"] for r in grouped.where("not marked and label = 0").select("kind").distinct().collect()}
    for kind in KINDS:
        if (kind, 0.0) not in sizes or (kind, 1.0) not in sizes or kind not in open_kinds:
            continue
        own = grouped.where((F.col("kind") == kind) & F.col("marked"))
        columns = [F.get("x", F.lit(i)).cast("double").alias(f) for i, f in enumerate(FEATURES)]
        rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(own.where("not held").select("label", "n", *columns))
        model = GBTClassifier(weightCol="n", maxIter=TREES, maxDepth=DEPTH, seed=11).fit(rows)
        trees = Acceptance([(float(w), _tree(t._java_obj.rootNode())) for w, t in zip(model.treeWeights, model.trees, strict=True)])
        # at most a thousand scores
        tested = own.where("held").groupBy(trees.score(F.col("x")).alias("score")).agg(
            F.sum("n").alias("all"), F.sum(F.col("n") * (1 - F.col("label"))).alias("wrong")
        ).orderBy(F.desc("score")).collect()
        seen, wrong = 0, 0
        for r in tested:
            seen, wrong = seen + int(r["all"]), wrong + int(r["wrong"])
            if binomial_tail(wrong, seen, 1 - precision) <= chance / len(KINDS):
                trees.cut = r["score"]
        if trees.cut is not None:
            out[kind] = trees
    return out


def find_personal_data(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """(doc_id, base, spans) of every row of docs (doc_id, text, any more columns): arrays of (start, kind number, end), sorted.

    base are the strict spans, spans have the trees' as well; kind numbers follow KINDS; places are code points, the end
    exclusive. Null and empty texts have none; rows with a null id are searched, repeated ones each.
    """
    found = _search(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"])
    return found.select("doc_id", F.col("strict").alias("base"), _with_added(found, precision).alias("spans"))


def _search(docs: DataFrame, keys: list[str]) -> DataFrame:
    """The keys with strict, the sorted strict spans, and more, the candidates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(*keys, text.alias("searched"), F.struct(*(base_spans(text, k).alias(k) for k in KINDS)).alias("by_kind"))
    as_rows = lambda k: F.transform(F.col(f"by_kind.{k}"), lambda s: F.struct(s["start"], F.lit(KINDS.index(k)).alias("kind"), s["end"]))
    strict = F.sort_array(F.concat(*map(as_rows, KINDS))).cast(SPANS)
    return materialize(found.select(*keys, strict.alias("strict"), candidates(F.col("searched"), F.col("by_kind")).alias("more")), "personal")


def _with_added(found: DataFrame, precision: float) -> Column:
    """The strict spans and those that the trees accept, sorted."""
    chosen = [
        F.transform(
            F.filter("more", lambda c: (c["kind"] == kind) & ~c["marked"] & ~c["label"] & (trees.score(c["x"]) >= trees.cut)),  # noqa: B023
            lambda c: F.struct(c["start"], F.lit(KINDS.index(kind)).alias("kind"), c["end"]),  # noqa: B023
        ).cast(SPANS)
        for kind, trees in learn(found, precision).items()
    ]
    return F.sort_array(F.array_distinct(F.concat("strict", *chosen))) if chosen else F.col("strict")


def redacted(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """All rows of docs with their spans replaced and n_chars renewed where there is one; null texts stay null."""
    found = _search(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")), ["doc_id", "row"])
    rows = found.withColumn("spans", _with_added(found, precision)).select("row.*", F.col("spans").alias("redacted_spans"))
    rows = rows.withColumn("text", redact(F.col("text"), F.col("redacted_spans"))).drop("redacted_spans")
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of found personal data."""
    counts = [
        F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)  # noqa: B023
    ]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first stays, enlarged."""
    names = F.array(*(F.lit(f"<{k}>") for k in KINDS))
    step = lambda a, s: F.when(
        s["start"] >= a["at"],
        F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"]))).alias("out")),
    ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    walked = F.aggregate(spans, start, step)
    joined = bind(walked, lambda w: F.concat(F.array_join(w["out"], ""), F.substring(text, w["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, joined).otherwise(text)
