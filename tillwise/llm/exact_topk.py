"""Exact nearest vectors by distributed histogram selection.

Queries and candidates are cut into blocks of bounded size. Every pair of a query block and a candidate block
is scored as one integer matrix product. Each round counts the scores per query in a histogram over the range
that must hold its kth score, adds the histograms, and narrows the range to one bin; a block reports
only the bins that its own k best scores reach. When few scores are left above the range's lower end, or it holds a
single value, the scores above it are kept, a block's k best at most, and ranked; ties go to the smaller id.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwise.session import materialize

BINS = 64
QUERY_ROWS, CANDIDATE_ROWS = 256, 2048
#: A range is narrow enough when at most this many times k scores lie above its lower end.
NEAR = 8
#: Scores beyond it, either way, are cut to it.
CUT = 2**60
BLOCK = "block string, dim int, ids binary, data binary, top long"
STATE = "block string, lo binary, hi binary, above binary, open long"


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): components as floor(256 x). Rows without id or vector, or with a null or non-finite component, go."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    whole = vectors.where("vec_id is not null and embedding is not null and size(embedding) > 0").where(~bad)
    return whole.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * 256)).alias("v")
    )


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Matrices of up to rows vectors of one dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            offsets = batch.column("v").offsets.to_numpy()
            flat = batch.column("v").values.to_numpy()
            dims = np.diff(offsets)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for i in range(0, len(at), rows):
                    part = at[i : i + rows]
                    data = flat[offsets[part][:, None] + np.arange(dim)]
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "block": uuid.uuid4().hex,
                                "dim": int(dim),
                                "ids": ids[part].astype(np.int64).tobytes(),
                                "data": data.astype(np.int64).tobytes(),
                                "top": max(abs(int(data.max())), abs(int(data.min()))),
                            }
                        ],
                        schema,
                    )

    schema = pa.schema(
        [("block", pa.string()), ("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("top", pa.int64())]
    )
    return vectors.mapInArrow(run, BLOCK)


def _longs(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.int64)


def _scores(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of a pair of blocks, a mask of the pairs that count, and the candidates' ids."""
    q, c = _longs(row["data"]).reshape(-1, row["dim"]), _longs(row["cdata"]).reshape(-1, row["dim"])
    if row["top"] * row["ctop"] * row["dim"] < 2**53:
        scores = (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    else:  # beyond a double's whole numbers: exact, and cut
        product = q.astype(object) @ c.astype(object).T
        scores = np.clip(product, -CUT, CUT).astype(np.int64)
    ids = _longs(row["cids"])
    return scores, _longs(row["ids"])[:, None] != ids[None, :], ids


def _width(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return np.maximum(1, -(-(hi - lo + 1) // BINS))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row.get("cdim", row.get("dim")) == row.get("dim"):
                yield row


def _count(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            scores, counts, _ = _scores(row)
            lo, hi, above = _longs(row["lo"]), _longs(row["hi"]), _longs(row["above"])
            inside = counts & (scores >= lo[:, None]) & (scores <= hi[:, None])
            at, _ = np.nonzero(inside)
            bins = ((scores - lo[:, None]) // _width(lo, hi)[:, None])[inside]
            hist = np.bincount(at * BINS + bins, minlength=len(lo) * BINS).reshape(len(lo), BINS)
            higher = hist[:, ::-1].cumsum(1)[:, ::-1] - hist
            hist[higher >= (k - above)[:, None]] = 0  # the block's own best fill the places above
            r, b = np.nonzero(hist)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]] * len(r), pa.string()), pa.array(r, pa.int32()), pa.array(b, pa.int32()), pa.array(hist[r, b], pa.int64())],
                ["block", "row", "bin", "n"],
            )

    return run


def _narrow(k: int):
    def run(key, counts: pa.Table, state: pa.Table) -> pa.Table:
        old = state.to_pylist()[0]
        lo, hi, above = (_longs(old[x]).copy() for x in ("lo", "hi", "above"))
        hist = np.zeros((len(lo), BINS), np.int64)
        hist[counts["row"].to_numpy(), counts["bin"].to_numpy()] = counts["n"].to_numpy()
        width, open_rows = _width(lo, hi), 0
        for i in range(len(lo)):
            if lo[i] == hi[i]:
                continue
            reached = above[i] + hist[i, ::-1].cumsum()
            best = int(np.argmax(reached >= k)) if reached[-1] >= k else BINS - 1
            if best == BINS - 1 and reached[-1] < k:  # fewer candidates than k: all of them
                hi[i] = lo[i]
                continue
            b, total = BINS - 1 - best, int(reached[best])
            above[i] = total - hist[i, b]
            low = lo[i] + b * width[i]
            lo[i], hi[i] = low, min(hi[i], low + width[i] - 1)
            if total <= NEAR * k:
                hi[i] = lo[i]
            open_rows += lo[i] < hi[i]
        return pa.Table.from_pylist(
            [{"block": old["block"], "lo": lo.tobytes(), "hi": hi.tobytes(), "above": above.tobytes(), "open": int(open_rows)}],
            pa.schema([("block", pa.string()), ("lo", pa.binary()), ("hi", pa.binary()), ("above", pa.binary()), ("open", pa.int64())]),
        )

    return run


def _collect(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            scores, counts, ids = _scores(row)
            queries, lo = _longs(row["ids"]), _longs(row["lo"])
            kept = counts & (scores >= lo[:, None])
            out = []
            for i in np.flatnonzero(kept.any(1)):
                at = np.flatnonzero(kept[i])
                at = at[np.lexsort((ids[at], -scores[i, at]))[:k]]
                out += [(row["block"], int(i), int(queries[i]), int(ids[j]), int(scores[i, j])) for j in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["block", "row", "query_id", "vec_id", "score"],
            )

    return run


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries its k best rows of vectors by integer inner product.

    Both have vec_id and embedding, any more columns are ignored. A candidate with the query's own id is left out;
    queries repeated with one id are answered each for itself, repeated candidates count each. Vectors
    meet only vectors of their own length. Components beyond a long are cut to it, scores to CUT.
    Without queries or candidates the result is empty.
    """
    q = materialize(_blocks(integer_vectors(queries), QUERY_ROWS), "topk-queries")
    c = materialize(_blocks(integer_vectors(vectors), CANDIDATE_ROWS), "topk-candidates")
    c = c.select(F.col("dim").alias("cdim"), F.col("ids").alias("cids"), F.col("data").alias("cdata"), F.col("top").alias("ctop"))
    bound = c.agg(F.max("ctop"), F.max("cdim")).first()
    limit = min((bound[0] or 0) * (bound[1] or 0) * (q.agg(F.max("top")).first()[0] or 0) + 1, CUT)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            n = len(row["ids"]) // 8
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "block": row["block"],
                        "lo": np.full(n, -limit).tobytes(),
                        "hi": np.full(n, limit).tobytes(),
                        "above": np.zeros(n, np.int64).tobytes(),
                        "open": n,
                    }
                ]
            )

    state = materialize(q.select("block", "ids").mapInArrow(start, STATE), "topk-state")
    # every stated query meets every vector, block by block
    pairs = lambda s: q.join(s.drop("open"), "block").crossJoin(c)
    while state.where("open > 0").limit(1).count():
        counts = pairs(state.where("open > 0")).mapInArrow(_count(k), "block string, row int, bin int, n long")
        counts = counts.groupBy("block", "row", "bin").agg(F.sum("n").alias("n"))
        narrowed = counts.groupBy("block").cogroup(state.where("open > 0").groupBy("block")).applyInArrow(_narrow(k), STATE)
        state = materialize(narrowed.union(state.where("open = 0")), "topk-state")
    best = pairs(state).mapInArrow(_collect(k), "block string, row int, query_id long, vec_id long, score long")
    order = Window.partitionBy("block", "row").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
