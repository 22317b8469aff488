"""Hard negatives by bounds along spanning trees of anchors.

Anchors and candidates are cut into blocks of one label and bounded size. The anchors of a block form a spanning tree of
short edges. A candidate's score at an anchor differs from its score at the anchor's parent by at most edge length
times candidate norm, so an interval at the parent gives one at the child; only candidates whose interval
reaches a wanted window are scored again, exactly. A first pass over the block pairs of one label finds each anchor's positives,
a second one over the pairs of different labels finds the negatives below each positive.

The intervals only decide what is scored: every score that counts is an exact integer product, so results do not
depend on blocks or trees. Every block reports a bounded number of rows an anchor, which are merged afterwards.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwise.session import materialize

ANCHOR_ROWS, CANDIDATE_ROWS = 256, 2048
#: Blocks' worth of rows that a task cuts at least, if there are as many.
PARTITION_BLOCKS = 8
#: Scores are cut to it, either way, where a product passes a double's whole numbers.
CUT = 2**60
BLOCK = "block string, label long, dim int, ids binary, data binary, top long"
_BLOCK_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
POSITIVES = "block string, row int, anchor_id long, vec_id long, score long"
NEGATIVES = "block string, row int, anchor_id long, positive_rank int, vec_id long, score long"


def labelled_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): components as floor(256 x). Rows with a null id or label, no component, or a null or non-finite one, go."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    whole = vectors.where("vec_id is not null and label is not null and embedding is not null and size(embedding) > 0").where(~bad)
    return whole.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(x, lambda e: F.floor(e * 256)).alias("v"),
    )


def _longs(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.int64)


def _batch(names: str, types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in names.split(", ")])


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Matrices of up to rows vectors of one label and dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: dict[tuple[int, int], list] = {}

        def close(key: tuple[int, int]) -> pa.RecordBatch:
            ids, parts = zip(*open_rows.pop(key), strict=True)
            data = np.stack(parts)
            top = max(abs(int(data.max())), abs(int(data.min())))
            return _batch(BLOCK, _BLOCK_TYPES, [(uuid.uuid4().hex, key[0], key[1], np.array(ids, np.int64).tobytes(), data.tobytes(), top)])

        held = 0
        for batch in batches:
            ids, labels = batch.column("vec_id").to_pylist(), batch.column("label").to_pylist()
            offsets = batch.column("v").offsets.to_numpy()
            flat = batch.column("v").values.to_numpy()
            for i, (vec_id, label) in enumerate(zip(ids, labels, strict=True)):
                vector = flat[offsets[i] : offsets[i + 1]]
                key = (label, len(vector))
                open_rows.setdefault(key, []).append((vec_id, vector.copy()))
                held += 1
                if len(open_rows[key]) >= rows:
                    held -= rows
                    yield close(key)
                elif held >= 4 * rows:  # many labels: close the fullest, so that a task holds a bounded number of vectors
                    key = max(open_rows, key=lambda k: len(open_rows[k]))
                    held -= len(open_rows[key])
                    yield close(key)
        for key in list(open_rows):
            yield close(key)

    # small partitions are read together, so that blocks fill up
    count = max(1, -(-vectors.count() // (PARTITION_BLOCKS * rows)))
    return vectors.coalesce(count).mapInArrow(run, BLOCK)


def spanning_tree(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): a minimum spanning tree by Euclidean distance, parents before children; edge never falls short."""
    m = len(data)
    x = data.astype(np.float64)
    order, parent, edge = np.zeros(m, int), np.full(m, -1), np.zeros(m)
    reached = np.zeros(m, bool)
    best, near = np.full(m, np.inf), np.zeros(m, int)
    at = 0
    for i in range(m):
        order[i], reached[at] = at, True
        distance = np.sqrt(((x - x[at]) ** 2).sum(1))
        closer = ~reached & (distance < best)
        best[closer], near[closer] = distance[closer], at
        if i + 1 < m:
            at = int(np.argmin(np.where(reached, np.inf, best)))
            parent[at], edge[at] = near[at], best[at] * (1 + 1e-9) + 1e-6
    return order, parent, edge


class Pair:
    """Scores of a block of anchors and a block of candidates."""

    def __init__(self, row: dict):
        self.ids, self.cids = _longs(row["ids"]), _longs(row["cids"])
        self.a, self.c = _longs(row["data"]).reshape(-1, row["dim"]), _longs(row["cdata"]).reshape(-1, row["dim"])
        self.small = row["top"] * row["ctop"] * row["dim"] < 2**52
        if self.small:
            self.fa, self.fc = self.a.astype(np.float64), self.c.astype(np.float64)
        #: candidate scores that were computed, of all pairs; the rest was ruled out by a bound
        self.scored = 0

    def exact(self, anchor: int, at: np.ndarray) -> np.ndarray:
        """Integer products of an anchor with the candidates at."""
        self.scored += len(at)
        if self.small:
            return (self.fc[at] @ self.fa[anchor]).astype(np.int64)
        product = self.c[at].astype(object) @ self.a[anchor].astype(object)
        return np.clip(product, -CUT, CUT).astype(np.int64)

    def walk(self, wanted: Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, candidates, scores) along the tree; wanted(anchor, candidates, low, high) says which of the candidates to score."""
        if not self.small:  # bounds in doubles would not hold: every candidate is scored
            for anchor in range(len(self.ids)):
                at = np.flatnonzero(self.cids != self.ids[anchor])
                yield anchor, at, self.exact(anchor, at)
            return
        order, parent, edge = spanning_tree(self.a)
        norm = np.sqrt((self.fc**2).sum(1)) * (1 + 1e-9) + 1e-6
        children = np.bincount(parent[parent >= 0], minlength=len(order))
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for anchor in order:
            other = self.cids != self.ids[anchor]
            if parent[anchor] < 0:
                low = high = self.exact(anchor, np.arange(len(self.cids))).astype(np.float64)
                at = np.flatnonzero(other)
                scores = low[at].astype(np.int64)
            else:
                low, high = bounds[parent[anchor]]
                reach = edge[anchor] * norm
                low, high = np.floor(low - reach), np.ceil(high + reach)
                children[parent[anchor]] -= 1
                if not children[parent[anchor]]:
                    del bounds[parent[anchor]]
                at = np.flatnonzero(other)
                at = at[wanted(anchor, at, low[at], high[at])]
                scores = self.exact(anchor, at)
                low[at] = high[at] = scores
            if children[anchor]:
                bounds[anchor] = low, high
            yield anchor, at, scores


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _kth(values: np.ndarray, k: int) -> float:
    """The kth largest value; minus infinity if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def block_positives(row: dict, k: int) -> list[tuple]:
    """A pair of blocks of one label: each anchor's k best candidates."""
    pair = Pair(row)
    # a candidate whose highest possible score is below the kth of the lowest possible ones is not among the best
    wanted = lambda anchor, at, low, high: high >= _kth(low, k)
    out = []
    for anchor, at, scores in pair.walk(wanted):
        keep = _best(scores, pair.cids[at], k)
        out += [(row["block"], anchor, int(pair.ids[anchor]), int(pair.cids[at[j]]), int(scores[j])) for j in keep]
    return out


def window(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest whole number from low to high hundredths of a score, without passing a long."""
    whole, rest = score // 100, score % 100
    return whole * low - (-rest * low // 100), whole * high + rest * high // 100


def block_negatives(row: dict, k: int, low: int, high: int) -> list[tuple]:
    """A pair of blocks of different labels: for each anchor and positive the k best candidates of its window."""
    pair = Pair(row)
    positives = _longs(row["positives"]).reshape(len(pair.ids), -1)
    counts = _longs(row["counts"])
    first, last = window(positives, low, high)

    def wanted(anchor: int, at: np.ndarray, lowest: np.ndarray, highest: np.ndarray) -> np.ndarray:
        mask = np.zeros(len(at), bool)
        for r in range(counts[anchor]):
            f, t = first[anchor, r], last[anchor, r]
            if f <= t:
                sure = lowest[(lowest >= f) & (highest <= t)]
                mask |= (lowest <= t) & (highest >= max(f, _kth(sure, k)))
        return mask

    out = []
    for anchor, at, scores in pair.walk(wanted):
        for r in range(counts[anchor]):
            inside = np.flatnonzero((scores >= first[anchor, r]) & (scores <= last[anchor, r]))
            keep = inside[_best(scores[inside], pair.cids[at[inside]], k)]
            out += [(row["block"], anchor, int(pair.ids[anchor]), r + 1, int(pair.cids[at[j]]), int(scores[j])) for j in keep]
    return out


def _each(body: Callable[[dict], list[tuple]], names: str) -> Callable:
    """A function for mapInArrow: body over one pair of blocks at a time, so that a task holds one pair."""
    types = [{"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[f.split()[1]] for f in names.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _batch(names, types, body(batch.slice(i, 1).to_pylist()[0]))

    return run


def _windows(k: int) -> Callable:
    """For groupBy(block): an anchor block's scores of positives, k an anchor, and how many of them there are."""

    def run(key, found: pa.Table, blocks: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return pa.table({"block": pa.array([], pa.string()), "positives": pa.array([], pa.binary()), "counts": pa.array([], pa.binary())})
        m = len(blocks["ids"][0].as_py()) // 8
        scores, counts = np.zeros((m, k), np.int64), np.zeros(m, np.int64)
        rows, ranks = found["row"].to_numpy(), found["positive_rank"].to_numpy()
        scores[rows, ranks - 1] = found["positive_score"].to_numpy()
        np.add.at(counts, rows, 1)
        return pa.table({"block": pa.array([key[0].as_py()], pa.string()), "positives": pa.array([scores.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary())})

    return run


def _ranked(found: DataFrame, keys: list[str], name: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn(name, F.row_number().over(order).cast("int")).where(F.col(name) <= k)


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Both frames have vec_id, embedding and label; any more columns are ignored. An anchor's positives are the best other rows of its
    label, at most positives; for each, the best rows of other labels whose score lies between low and high
    hundredths of the positive's come out, at most negatives. Scores are integer inner products of floor(256 x); ties go to
    the smaller id. A positive without a negative in its window does not come out, a negative score has no window.

    Rows with a null id, label or vector, without components, or with a null or non-finite component take no part. Rows with the
    anchor's own id are no candidates for it; repeated rows count each, and repeated anchors are answered each for itself. Vectors
    meet only vectors of their own length. Components beyond a long are cut to it, scores to CUT, where products
    pass a double's whole numbers. Without anchors or candidates the result is empty.
    """
    a = materialize(_blocks(labelled_vectors(anchors), ANCHOR_ROWS), "negatives-anchors")
    c = materialize(_blocks(labelled_vectors(vectors), CANDIDATE_ROWS), "negatives-candidates")
    c = c.select(F.col("label").alias("clabel"), F.col("dim").alias("cdim"), F.col("ids").alias("cids"), F.col("data").alias("cdata"), F.col("top").alias("ctop"))

    # Every stated anchor meets every vector, block by block. Conditions that are no equality leave the blocks where they are:
    # an equality would deal all blocks of a common label to one task.
    fits = F.abs(F.col("dim") - F.col("cdim")) < 1
    same = F.abs(F.col("label") - F.col("clabel")) < 1
    found = a.join(c, fits & same).mapInArrow(_each(lambda row: block_positives(row, positives), POSITIVES), POSITIVES)
    found = _ranked(found, ["block", "row"], "positive_rank", positives)
    found = materialize(found.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}), "negatives-positives")

    windows = found.groupBy("block").cogroup(a.select("block", "ids").groupBy("block"))
    windows = materialize(windows.applyInArrow(_windows(positives), "block string, positives binary, counts binary"), "negatives-windows")
    reached = a.join(windows, "block").join(c, fits & ~same)
    body = _each(lambda row: block_negatives(row, negatives, low, high), NEGATIVES)
    hard = _ranked(reached.mapInArrow(body, NEGATIVES), ["block", "row", "positive_rank"], "rank", negatives)
    return hard.join(found.drop("anchor_id"), ["block", "row", "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def noisy_labels(vectors: DataFrame, every: int = 7, classes: int = 10) -> DataFrame:
    """vectors with a label moved to the next class where vec_id is divisible by every."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    return vectors.withColumn("label", moved)
