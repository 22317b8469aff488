"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

A text's letter runs, lower-cased and framed by one space each, give all n-grams of one to ORDERS characters, hashed to
2^BITS features. Document frequencies are counted over every training document. The classifier is fitted on a
bounded sample of labelled rows by follow-the-regularised-leader with an elastic net (L1 and L2), which leaves most weights zero; a
part of the sample that it never sees sets the temperature of its probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import as_bytes, fold_of, small_batches
from tillwise.session import materialize

ORDERS, BITS = 4, 18
FEATURES = 1 << BITS
#: Labelled rows of a language that the classifier is fitted on, about (rows are taken by a hash of the id), and the rows a
#: language must have to be learnt.
SAMPLE, LEAST = 1_500, 5
#: One in so many rows of the sample calibrates the temperature instead.
CALIBRATE = 5
EPOCHS = 2
#: Step size and its start, L1 and L2 of the follow-the-regularised-leader updates.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 0.1
#: Document frequencies are added up in so many groups.
SLICES = 16
_FACTOR, _STEP, _SHIFT = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(32 - BITS)
_OFFSETS = (np.arange(ORDERS) * 0x3C6EF372 % 2**32).astype(np.uint32)

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The features of a whole text and how often each occurs; none if it has no letter."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes * letter_table()[codes]
    solid = codes != 0
    solid[1:] |= solid[:-1]  # of a run of other characters the first one stays, as a space
    codes = codes[solid]
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gram = codes = np.concatenate([np.zeros(1, np.uint32), codes])
    every = np.empty(ORDERS * len(codes), np.int64)
    end = 0
    for n in range(min(ORDERS, len(codes))):
        if n:
            gram = gram[:-1] * _STEP + codes[n:]
        hashed = (gram + _OFFSETS[n]) * _FACTOR
        every[end : end + len(hashed)] = hashed >> _SHIFT
        end += len(hashed)
    every = every[:end]
    # distinct features without a sort: the last position of each stands for it
    place, at = _places(), np.arange(end, dtype=np.int32)
    place[every] = at
    last = place[every]
    chosen = np.flatnonzero(last == at)
    return every[chosen], np.bincount(last, minlength=end)[chosen]


_place: np.ndarray | None = None


def _places() -> np.ndarray:
    global _place
    if _place is None:
        _place = np.zeros(FEATURES, np.int32)
    return _place


def _text(b: bytes) -> str:
    return b.decode("utf-8", "replace")


def training(docs: DataFrame) -> DataFrame:
    """The rows that may be learnt from: a lang, and an id of another fold than the held-out one."""
    return docs.where(F.col("lang").isNotNull() & (fold_of(F.col("doc_id")) != 0))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Training documents with a letter, and in how many of them each feature occurs."""
    width = FEATURES // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(FEATURES, np.int64), 0
        for b in small_batches(batches, "text"):
            for text in as_bytes(b.column("text")):
                at, _ = features(_text(text))
                total[at] += 1
                seen += len(at) > 0
        if seen:
            parts = [total[i * width : (i + 1) * width].tobytes() for i in range(SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([seen] * SLICES, pa.int64()), pa.array(parts, pa.binary())], ["slice", "docs", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        docs: dict[int, int] = {}
        for b in batches:
            for s, n, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                sums[s] = sums.get(s, 0) + np.frombuffer(counts, np.int64)
                docs[s] = docs.get(s, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(docs.values()), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["slice", "docs", "counts"])

    schema = "slice int, docs long, counts binary"
    # one row a task and slice; a slice's rows meet in one task, which adds them up as they come
    parts = docs.select("text").mapInArrow(count, schema).repartition(SLICES, "slice").mapInArrow(add, schema)
    rows = parts.collect()
    frequency = np.zeros(FEATURES, np.int64)
    for r in rows:
        frequency[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["counts"], np.int64)
    return max((r["docs"] for r in rows), default=0), frequency


def sample(docs: DataFrame, rows: int = SAMPLE) -> tuple[list[str], DataFrame]:
    """The languages learnt, in order, and about rows training ids of each as (turn, doc_id, lang, text), chosen by a hash of the id."""
    counts = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().where(F.col("count") >= LEAST).collect()}
    turn = F.xxhash64(F.col("doc_id").cast("long"), F.lit(12))
    share = F.create_map(*(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, rows / n)))) if counts else None
    chosen = docs.select(turn.alias("turn"), F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    if share is None:
        return [], chosen.limit(0)
    place = F.col("turn") / float(2**64) + 0.5
    chosen = chosen.where(place < F.coalesce(share[F.col("lang")], F.lit(0.0)))
    # an id counts once, however often its row is repeated: the bound holds
    once = chosen.groupBy("turn", "doc_id").agg(F.min(F.struct("lang", "text")).alias("row"))
    return sorted(counts), once.select("turn", "doc_id", "row.lang", "row.text")


class Weighting:
    """TF-IDF of features: logarithmic counts times idf, scaled to length one."""

    def __init__(self, documents: int, frequency: np.ndarray):
        self.idf = (np.log((1 + documents) / (1 + frequency)) + 1).astype(np.float32)
        self.tf = (1 + np.log(np.maximum(np.arange(1 << 12), 1))).astype(np.float32)  # occurrences beyond add nothing

    def __call__(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = self.tf[np.minimum(counts, len(self.tf) - 1)] * self.idf[at]
        return x / math.sqrt(float(x @ x)) if len(x) else x


class Leader:
    """Multinomial logistic regression learnt row by row: FTRL-proximal with L1 and L2."""

    def __init__(self, classes: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, FEATURES), np.append(x, 1.0)  # the last feature is the bias
        w = self.weights(at)
        gradient = softmax(x @ w)
        gradient[label] -= 1
        g = x[:, None] * gradient
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least cross-entropy on labelled rows; 1 without rows."""
    if not len(scores):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / math.exp(log_t))
        return -float(np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean())

    low, high = math.log(0.02), math.log(20.0)
    ratio = (math.sqrt(5) - 1) / 2
    for _ in range(60):  # golden section
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


class Model:
    """Languages, features with a weight, weights and bias, idf and temperature."""

    def __init__(self, docs: DataFrame, rows: int = SAMPLE):
        train = training(docs.select("doc_id", "lang", "text"))
        self.languages, chosen = sample(train, rows)
        self.rows = self.weights = None
        if not self.languages:
            return
        documents, frequency = document_frequencies(train)
        weighting, index = Weighting(documents, frequency), {x: i for i, x in enumerate(self.languages)}
        examples = materialize(_examples(chosen, weighting, index), "language-examples")
        fitted = examples.repartition(1).sortWithinPartitions("turn", "doc_id", "label").mapInArrow(_fit(len(index)), "part int, data binary")
        parts = {r["part"]: np.frombuffer(r["data"], np.float64) for r in materialize(fitted, "language-weights").collect()}
        if not parts:
            self.languages = []
            return
        self.kept = parts[0].astype(np.int64)
        self.weights = parts[1].reshape(-1, len(index))
        self.bias, self.heat = parts[2], float(parts[3][0])
        self.weighting = weighting

    def predict(self, at: np.ndarray, counts: np.ndarray, slot: np.ndarray) -> tuple[str, float]:
        x = self.weighting(at, counts)
        where = slot[at]
        used = where >= 0
        p = softmax((self.bias + x[used] @ self.weights[where[used]]) / self.heat)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _examples(chosen: DataFrame, weighting: Weighting, index: dict[str, int]) -> DataFrame:
    """(turn, doc_id, label, at, x): weighted features of the sample's rows that have a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text"):
            for i, text in enumerate(as_bytes(b.column("text"))):
                at, counts = features(_text(text))
                if len(at):
                    label = index[b.column("lang")[i].as_py()]
                    row = b.slice(i, 1)
                    x = weighting(at, counts).astype(np.float32)
                    yield pa.RecordBatch.from_arrays(
                        [row.column("turn"), row.column("doc_id"), pa.array([label], pa.int32()), pa.array([at.astype(np.int32).tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())],
                        ["turn", "doc_id", "label", "at", "x"],
                    )

    return chosen.mapInArrow(run, "turn long, doc_id long, label int, at binary, x binary")


def _fit(classes: int):
    """One task over the bounded sample in a fixed order: the updates of each row follow on those of the row before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt, kept_back = [], []
        for b in batches:
            for turn, label, at, x in zip(*(b.column(c).to_pylist() for c in ("turn", "label", "at", "x")), strict=True):
                row = np.frombuffer(at, np.int32), np.frombuffer(x, np.float32), label
                (kept_back if turn % CALIBRATE == 0 else learnt).append(row)
        if not learnt:
            return
        leader = Leader(classes)
        for _ in range(EPOCHS):
            for row in learnt:
                leader.learn(*row)
        w = leader.weights(np.arange(FEATURES + 1))
        scores = np.array([w[FEATURES] + x @ w[at] for at, x, _ in kept_back]).reshape(-1, classes)
        heat = temperature(scores, np.array([y for *_, y in kept_back], int))
        kept = np.flatnonzero((w[:FEATURES] != 0).any(1))
        parts = [kept.astype(np.float64), w[kept].ravel(), w[FEATURES], np.array([heat])]
        yield pa.RecordBatch.from_arrays([pa.array(range(4), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "data"])

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold_of(doc_id) == 0, F.lit(False))


def identify(docs: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of docs (doc_id, text, lang, any more columns).

    A null text, or one without a letter, is und with score 0; so is every text if no language has LEAST training rows. Other
    texts get the likeliest language and its probability. Rows with a null id are predicted, and neither held out nor
    learnt from; repeated rows count each. An empty lang is a language like any other.
    """
    model = Model(docs, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(FEATURES, -1)
        if model.weights is not None:
            slot[model.kept] = np.arange(len(model.kept))
        for b in small_batches(batches, "text"):
            out = []
            for text in as_bytes(b.column("text")):
                at, counts = features(_text(text)) if model.weights is not None else ((), ())
                out.append(model.predict(at, counts, slot) if len(at) else ("und", 0.0))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array([x for x, _ in out], pa.string()), pa.array([p for _, p in out], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return slim.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
