"""Quality rules whose cutoffs control the share of good documents they reject.

Every rule is a number that grows as a text gets worse, with a grid of cutoffs from lenient to strict. On
documents labelled good, an exact binomial test per stratum and cutoff asks whether the rule's false rejections are
below its share of the allowed risk. Cutoffs are tested in grid order until the first failure, which needs no
correction along the grid; rules and strata are corrected by Bonferroni. Of the cutoffs that passed, the most
lenient one that catches as many bad documents as the strictest is used. Without enough evidence a rule has no cutoff
and rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import bind, words_of
from tillwise.session import materialize

WINDOW = 8
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Share of good documents of a stratum that all rules together may reject, and the chance to exceed it.
RISK, CHANCE = 0.05, 0.05
#: Languages with a stratum of their own; all others share one. No document is left out.
STRATA = 50
#: Rule: its cutoffs from lenient to strict. A text is rejected from the cutoff on.
GRIDS = {
    "symbols": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04],
    "uppercase": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25],
    "marks": [2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25],
    "repeated": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25],
    "same_lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3],
    "long_words": [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0],
}


def _repeated(words: Column) -> Column:
    """Words in windows that occur twice or more. Hashes find texts that may have any, whole windows decide."""

    def positions(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
            lambda i: F.struct(F.array_join(F.slice(w, i, WINDOW), " ").alias("g"), i.alias("i")),
        )

        return F.sort_array(bind(F.sort_array(windows), lambda s: bind(s["g"], lambda g: F.filter(
            F.transform(s, lambda x, j: F.when(
                (F.get(g, j) == F.coalesce(F.get(g, j - 1), F.lit(""))) | (F.get(g, j) == F.coalesce(F.get(g, j + 1), F.lit(""))), x["i"]
            )), lambda i: i.isNotNull()))))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        doubled = bind(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(F.size(w) <= WINDOW, 0).when(doubled, bind(positions(w), covered)).otherwise(0)

    return counted(words)


def text_features(docs: DataFrame, keys: list[str]) -> DataFrame:
    """The keys with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the rules' numbers."""
    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = bind(words_of(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("r")))
    line_counts = bind(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    measured = docs.select(
        *keys, counts.alias("c"), line_counts.alias("l"),
        (F.length(F.translate(text, " \t\n\x0b\f\r", ""))).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        without(UPPER).alias("upper"), without("!?").alias("marks"),
    )
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest(F.col("c.n"), F.lit(1))
    return measured.select(
        *keys,
        F.col("c.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.col("l.n") - F.col("l.d")).cast("long").alias("n_dup_lines"),
        F.col("c.r").cast("long").alias("n_repeat_words"),
        F.struct(
            (F.col("n_symbols") / chars).alias("symbols"),
            (F.col("upper") / chars).alias("uppercase"),
            (F.col("marks") / words).alias("marks"),
            (F.col("c.r") / words).alias("repeated"),
            ((F.col("l.n") - F.col("l.d")) / F.greatest(F.col("l.n"), F.lit(1))).alias("same_lines"),
            (F.col("word_chars") / words).alias("long_words"),
        ).alias("rules"),
    )


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial, as the regularised incomplete beta function I(1 - p; n - k, k + 1)."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1, 1 - p
    if x >= (a + 1) / (a + b + 2):
        return 1 - _beta_part(b, a, 1 - x)
    return _beta_part(a, b, x)


def _beta_part(a: float, b: float, x: float) -> float:
    """Incomplete beta function by Lentz's continued fraction; x below (a + 1) / (a + b + 2)."""
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    out = d
    for m in range(1, 100_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + term * d)
            c = 1 + term / c
            out *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * out


def learn_cutoffs(
    measured: DataFrame, labels: DataFrame, risk: float = RISK, chance: float = CHANCE
) -> tuple[dict[tuple[str, str], float], list[str]]:
    """Cutoff by (stratum, rule) from measured (doc_id, lang, rules) and labels (doc_id, quality), and the languages with a stratum.

    Labels without id or quality are ignored; an id labelled twice counts as bad if any label says so. Stratum
    "" holds the languages without one of their own and null. A language with a stratum may have no cutoff in it.
    """
    judged = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    known = measured.where("doc_id is not null").join(judged, "doc_id")
    # counts per language and grid step: how many grid cutoffs of a rule a document reaches
    reached = [
        sum(((F.col(f"rules.{rule}") >= c).cast("int") for c in grid), F.lit(0)).alias(rule) for rule, grid in GRIDS.items()
    ]
    steps = known.select(F.coalesce("lang", F.lit("")).alias("lang"), "good", *reached).select(
        "lang", "good", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("step")) for r in GRIDS))).alias("s")
    )
    counts = steps.groupBy("lang", "good", "s.rule", "s.step").count()
    largest = [r["lang"] for r in counts.groupBy("lang").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "lang").limit(STRATA).collect()]
    stratum = F.when(F.col("lang").isin(largest), F.col("lang")).otherwise("") if largest else F.lit("")
    table: dict[tuple[str, str, int, int], int] = {}
    for r in counts.groupBy(stratum.alias("stratum"), "good", "rule", "step").agg(F.sum("count").alias("n")).collect():
        table[r["stratum"], r["rule"], r["good"], r["step"]] = r["n"]
    strata = sorted({s for s, *_ in table})
    share, level = risk / len(GRIDS), chance / max(1, len(GRIDS) * len(strata))
    out = {}
    for s in strata:
        for rule, grid in GRIDS.items():
            # a document that reaches i of the cutoffs reaches the i strictest
            caught = lambda good, i: sum(table.get((s, rule, good, step), 0) for step in range(len(grid) - i, len(grid) + 1))  # noqa: E731, B023
            n, passed = caught(1, len(grid)), 0
            while passed < len(grid) and n and binomial_tail(caught(1, passed), n, share) <= level:
                passed += 1
            if passed and caught(0, passed - 1):
                out[s, rule] = grid[next(i for i in range(passed) if caught(0, i) == caught(0, passed - 1))]
    return out, sorted(x for x in largest if x)


def _verdict(rows: DataFrame, cutoffs: dict[tuple[str, str], float], own: list[str]) -> DataFrame:
    """base_failed, failed_rules and kept for rows with text features and lang; own are the languages with a stratum."""
    stratum = F.when(F.col("lang").isin(own), F.col("lang")).otherwise("") if own else F.lit("")
    fails = [
        F.when((stratum == s) & (F.col(f"rules.{rule}") >= cut), F.lit(rule)) for (s, rule), cut in sorted(cutoffs.items())
    ]
    failed = F.array_compact(F.array(*fails)) if fails else F.array().cast("array<string>")
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.withColumn("base_failed", base).withColumn("failed_rules", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)
    )


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, chance: float = CHANCE) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_rules) of every row.

    Null texts count as empty and fail; rows with null or repeated ids are judged each for itself. Any columns of
    docs but doc_id, text and lang are ignored.
    """
    measured = materialize(
        text_features(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"), ["doc_id", "lang"]), "quality"
    )
    return _verdict(measured, *learn_cutoffs(measured, labels, risk, chance)).drop("lang", "rules")


def keep(docs: DataFrame, labels: DataFrame, risk: float = RISK, chance: float = CHANCE) -> DataFrame:
    """The rows of docs that are kept, with all their columns (none of them named row)."""
    whole = docs.select("doc_id", "text", "lang", F.struct(*docs.columns).alias("row"))
    measured = materialize(text_features(whole, ["doc_id", "lang", "row"]), "quality")
    learnt = learn_cutoffs(measured.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "rules"), labels, risk, chance)
    return _verdict(measured, *learnt).where("kept").select("row.*")
