"""Toxicity scores by weak supervision.

Lexicon and prefix patterns that set toxic documents apart are found on a bounded sample of labelled rows and dealt
to voters. A generative model of the votes over all training documents, a latent class with a tree of
correlations between voters, estimates how often each voter fires in either class; expectation maximisation
runs on the counts of vote patterns, of which there are at most 2^VOTERS. Its posterior labels train a
linear classifier on the patterns found, fitted over all training documents, which scores every row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import as_bytes, fold_of, only_memory, small_batches
from tillwise.session import materialize

#: Labelled rows of either class that the patterns are found on, at most.
SAMPLE = 15_000
#: Patterns kept, at most, and the least log odds and documents of one.
PATTERNS, LEAST_ODDS, LEAST_DOCS = 400, 2.5, 3
KINDS, PARTS = 4, 4
VOTERS = KINDS * PARTS
ROUNDS = 60

_LETTERS = re.compile(r"[^\W\d_]+")
_known: dict[int, dict[bytes, tuple[int, ...]]] = {}


def patterns_of(token: bytes) -> set[str]:
    """Patterns of a token: its letter runs as w:word, and their first four to six letters as 4:, 5: and 6:."""
    out = set()
    for run in _LETTERS.findall(token.decode("utf-8", "replace").lower()):
        if len(run) > 2:
            out.add(f"w:{run}")
            out.update(f"{n}:{run[:n]}" for n in (4, 5, 6) if len(run) >= n)
    return out


def _pattern_counts(labelled: DataFrame) -> DataFrame:
    """(pattern, toxic, docs) over labelled (text, toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text"):
            counts: Counter = Counter()
            for text, toxic in zip(as_bytes(b.column("text")), b.column("toxic").to_pylist(), strict=True):
                counts.update((p, toxic) for p in set(chain.from_iterable(map(patterns_of, set(text.split())))))
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in keys], pa.string()), pa.array([y for _, y in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
                ["pattern", "toxic", "docs"],
            )

    found = labelled.select("text", "toxic").mapInArrow(run, "pattern string, toxic int, docs long")
    return found.groupBy("pattern").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("docs")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("toxic") == 0, F.col("docs")).otherwise(0)).alias("n0"),
    )


def find_patterns(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[str]:
    """The strongest patterns of toxic documents, on at most sample labelled rows of either class (by hash of the id)."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    known = known.where(fold_of(F.col("doc_id")) != 0)
    halves = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    chosen = materialize(halves[0].union(halves[1]), "toxicity-sample")
    sizes = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    # bounded by the sample: two numbers a row
    labelled = docs.join(F.broadcast(chosen), "doc_id")
    ratio = lambda n, size: F.log((F.col(n) + 0.5) / (size + 1.0))
    odds = ratio("n1", sizes.get(1, 0)) - ratio("n0", sizes.get(0, 0))
    scored = _pattern_counts(labelled).where(F.col("n1") >= LEAST_DOCS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    best = scored.orderBy((F.col("odds") * F.col("n1")).desc(), "pattern").limit(PATTERNS)
    return sorted(r["pattern"] for r in best.collect())


def _hits(docs: DataFrame, patterns: list[str], keys: list[str]) -> DataFrame:
    """The keys and hits, the sorted indices of the patterns that a text holds."""
    index = {p: i for i, p in enumerate(patterns)}
    own = hash(tuple(patterns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memory("patterns", _known.clear)
        if own not in _known:
            _known.clear()
        known = _known.setdefault(own, {})
        for b in small_batches(batches, "text"):
            if len(known) > 500_000:
                known.clear()
            rows = []
            for text in as_bytes(b.column("text")):
                found: set[int] = set()
                for token in set(text.split()):
                    hit = known.get(token)
                    if hit is None:
                        hit = known[token] = tuple(index[p] for p in patterns_of(token) if p in index)
                    if hit:
                        found.update(hit)
                rows.append(sorted(found))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(rows, pa.list_(pa.int32()))], [*keys, "hits"])

    fields = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*dict.fromkeys([*keys, "text"])).mapInArrow(run, f"{fields}, hits array<int>")


def voters_of(patterns: list[str]) -> list[int]:
    """The voter of each pattern: one of PARTS of its kind, in turns."""
    kinds = {"w": 0, "4": 1, "5": 2, "6": 3}
    turns: Counter = Counter()
    out = []
    for p in patterns:
        kind = kinds[p[0]]
        out.append(kind * PARTS + turns[kind] % PARTS)
        turns[kind] += 1
    return out


class LabelModel:
    """P(toxic | votes): class-conditional vote rates, each voter also given its parent in a tree of correlations."""

    def __init__(self, votes: np.ndarray, counts: np.ndarray, seeds: np.ndarray):
        """votes: 0/1 by pattern and voter; counts: documents by pattern; seeds: first guesses of the posterior."""
        self.votes = votes
        self.parent = np.full(votes.shape[1], -1)
        posterior = seeds
        for stage in range(2):
            for _ in range(ROUNDS):
                self._maximise(counts, posterior)
                posterior = self.posterior(votes)
            if stage == 0:
                self.parent = self._tree(counts, posterior)

    def _maximise(self, counts: np.ndarray, posterior: np.ndarray) -> None:
        weights = np.stack([counts * (1 - posterior), counts * posterior])
        self.prior = np.clip(weights.sum(1) / weights.sum(), 1e-6, 1)
        above = self._above(self.votes)
        self.rate = np.empty((2, 2, self.votes.shape[1]))
        for y in range(2):
            for a in range(2):
                w = weights[y][:, None] * (above == a)
                self.rate[y, a] = ((w * self.votes).sum(0) + 0.5) / (w.sum(0) + 1)

    def _above(self, votes: np.ndarray) -> np.ndarray:
        return np.where(self.parent >= 0, votes[:, self.parent], 0)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        above, voter = self._above(votes), np.arange(votes.shape[1])
        rates = self.rate[:, above, voter]
        logs = np.log(self.prior)[:, None] + np.where(votes, np.log(rates), np.log1p(-rates)).sum(2)
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))

    def _tree(self, counts: np.ndarray, posterior: np.ndarray) -> np.ndarray:
        """Each voter's parent in the spanning tree of the largest mutual information given the class."""
        m = self.votes.shape[1]
        info = np.zeros((m, m))
        for w in (counts * (1 - posterior), counts * posterior):
            total = w.sum()
            if total < 1:
                continue
            on = (w[:, None] * self.votes).sum(0) / total
            both = (self.votes * w[:, None]).T @ self.votes / total
            for x in range(2):
                for y in range(2):
                    joint = both if x and y else on[:, None] - both if x else on[None, :] - both if y else 1 - on[:, None] - on[None, :] + both
                    single = (on if x else 1 - on)[:, None] * (on if y else 1 - on)[None, :]
                    ok = (joint > 1e-12) & (single > 1e-12)
                    info += total / counts.sum() * np.where(ok, joint * np.log(np.where(ok, joint, 1) / np.where(ok, single, 1)), 0)
        parent, reached = np.full(m, -1), [0]
        while len(reached) < m:
            rest = [j for j in range(m) if j not in reached]
            best = max(((info[i, j], i, j) for i in reached for j in rest))
            parent[best[2]] = best[1]
            reached.append(best[2])
        return parent


class Scorer:
    """Patterns, bias and weights learnt from docs (doc_id, text) and labels; scores any rows with a text."""

    def __init__(self, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        self.patterns = find_patterns(docs, labels, sample)
        #: (doc_id, hits) of every row of docs
        self.rows = materialize(_hits(docs, self.patterns, ["doc_id"]), "toxicity-hits")
        train = self.rows.where(~held_out(F.col("doc_id")))
        self.bias, self.weights = _fit(train, self.patterns) if self.patterns else (-np.inf, np.zeros(0))

    def score(self, hits: Column) -> Column:
        if np.isneginf(self.bias):
            return F.lit(0.0)
        table = F.array(*(F.lit(float(w)) for w in self.weights))
        return 1 / (1 + F.exp(-F.aggregate(hits, F.lit(float(self.bias)), lambda a, i: a + F.get(table, i))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold_of(doc_id) == 0, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs (doc_id, text, any more columns).

    Null texts count as empty. Rows with a null id are scored, and neither held out nor learnt from with a label; repeated
    rows count each. Without labels, or without any pattern, every score is 0.
    """
    scorer = Scorer(docs, labels, sample)
    scored = scorer.rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scorer.score(F.col("hits")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that are not predicted toxic, with all their columns."""
    scorer = Scorer(docs, labels, sample)
    slim = docs.withColumnsRenamed({c: f"own_{c}" for c in docs.columns if c != "text"})
    kept = _hits(slim, scorer.patterns, slim.columns).where(scorer.score(F.col("hits")) < 0.5).drop("hits")
    return kept.toDF(*docs.columns)


def _fit(rows: DataFrame, patterns: list[str]) -> tuple[float, np.ndarray]:
    """Bias and weights of the linear classifier trained on the label model's posteriors of all rows."""
    grouped = materialize(
        rows.withColumn("votes", _votes(voters_of(patterns))).groupBy("hits", "votes").agg(F.count("*").alias("n")),
        "toxicity-patterns",
    )
    counted = grouped.groupBy("votes").agg(F.sum("n").alias("n")).orderBy("votes").collect()
    if not counted:
        return -np.inf, np.zeros(0)
    masks, counts = np.array([r["votes"] for r in counted]), np.array([r["n"] for r in counted], float)
    votes = (masks[:, None] >> np.arange(VOTERS)) & 1
    model = LabelModel(votes, counts, np.clip(votes.mean(1) * 4, 0.02, 0.98))
    spark = rows.sparkSession
    posterior = spark.createDataFrame(
        [(int(m), float(p)) for m, p in zip(masks, model.posterior(votes), strict=True)], "votes int, p double"
    )
    # bounded: a row for each pattern of VOTERS votes
    weighed = grouped.join(F.broadcast(posterior), "votes").select(
        F.transform("hits", lambda i: F.concat(F.lit("f"), i.cast("string"))).alias("names"),
        F.explode(F.array(*(F.struct(F.lit(float(y)).alias("label"), (F.col("n") * share).alias("weight")) for y, share in ((1, F.col("p")), (0, 1 - F.col("p")))))).alias("x"),
    ).select("names", "x.label", "x.weight").where("weight > 0")
    names = [f"f{i}" for i in range(len(patterns))]
    vectors = CountVectorizerModel.from_vocabulary(names, inputCol="names", outputCol="features", minTF=1.0).transform(weighed)
    if vectors.select("label").distinct().count() < 2:
        return -np.inf, np.zeros(0)
    fitted = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=60, standardization=False).fit(vectors.select("features", "label", "weight"))
    return float(fitted.intercept), fitted.coefficients.toArray()


def _votes(voters: list[int]) -> Column:
    """The voters that hits make fire, as bits."""
    table = F.array(*(F.lit(1 << v) for v in voters))
    return F.aggregate("hits", F.lit(0), lambda a, i: a.bitwiseOR(F.get(table, i)))

