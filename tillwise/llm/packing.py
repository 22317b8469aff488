"""Packing of tokenized documents into sequences of one length, by cutting-stock column generation.

A document's ids are cut into pieces of at most the sequence length; only its last piece may be shorter. Where that would
leave more than PADDING of the sequences empty, documents are cut finer: at FINE ids, and what is left at a multiple of GRAIN,
so that pieces fill sequences to the last id. The histogram of the pieces' lengths, in steps of GRAIN, goes to the driver (at most capacity / GRAIN numbers); the patterns
found there come back as a table of intervals of ranks. The pieces of a length are ranked in buckets of bounded
size, and a join with the intervals gives each its sequence and slot.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwise.llm import cutting_stock
from tillwise.llm.common import as_bytes, small_batches
from tillwise.llm.word_ids import encoder
from tillwise.session import materialize

CAPACITY, GRAIN = 4096, 8
#: Ids of a fine cut, and the padding (beyond one sequence) that calls for it.
FINE, PADDING = 512, 0.01
#: Pieces ranked by one task.
BUCKET_ROWS = 20_000


def cuts(n: int, capacity: int, fine: bool) -> list[tuple[int, int]]:
    """(start, end) of the pieces of n ids."""
    if not fine:
        return [(i, min(i + capacity, n)) for i in range(0, n, capacity)]
    step = min(FINE, capacity)
    whole, even = n - n % step, n - n % GRAIN
    edges = sorted({*range(0, whole + 1, step), even, n})
    return list(zip(edges[:-1], edges[1:], strict=True))


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, keep_ids: bool = True, fine: bool = False,
    both: bool = False,
) -> DataFrame:
    """Cut every document: (doc_id, start, length, ids_crc32, doc_tokens, ids); ids are null without keep_ids.

    Null and empty texts are the end id alone. Rows are cut each for itself, also with a null or repeated doc_id.
    With both, each document is tokenized once and cut both ways, and a last column fine tells the cuts apart.
    """
    kinds = (False, True) if both else (fine,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for b in small_batches(batches, "text"):
            out = []
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), own.encode(as_bytes(b.column("text"))), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for kind in kinds:
                    for start, end in cuts(len(ids), capacity, kind):
                        cut = ids[start:end]
                        row = (doc_id, start, len(cut), zlib.crc32(cut.tobytes()), len(ids), cut if keep_ids else None)
                        out.append((*row, kind) if both else row)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema, strict=True)], schema=schema)

    schema = pa.schema(
        [(x, pa.int64()) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")] + [("ids", pa.list_(pa.int32()))]
        + ([("fine", pa.bool_())] if both else [])
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>" + (", fine boolean" if both else "")
    )


def _intervals(bins: list[tuple[cutting_stock.Pattern, int]]) -> list[tuple[int, int, int, int, int]]:
    """(units, first rank, ranks end, first sequence, items a sequence) of each pattern and length."""
    taken: dict[int, int] = {}
    sequence, out = 0, []
    for pattern, times in bins:
        for units, count in pattern.items():
            first = taken.get(units, 0)
            taken[units] = first + times * count
            out.append((units, first, taken[units], sequence, count))
        sequence += times
    return out


class Plan:
    """The patterns for the lengths of pieces, how many pieces there are, and the share of the sequences, beyond one, that stays empty."""

    def __init__(self, cut: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN):
        sizes = cut.groupBy(F.ceil(F.col("length") / grain).cast("int").alias("units")).agg(
            F.count("*").alias("n"), F.sum("length").alias("ids")
        ).collect()  # capacity / grain rows at most
        demand = np.zeros(capacity // grain, np.int64)
        for row in sizes:
            demand[row["units"] - 1] = row["n"]
        self.pieces = int(demand.sum())
        self.bins = cutting_stock.plan(demand, capacity // grain)
        used = capacity * sum(times for _, times in self.bins)
        self.padding = max(0, used - capacity - sum(r["ids"] for r in sizes)) / used if used else 0.0


def pack(cut: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN, plan: Plan | None = None) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, start, length, any more columns); cut must give the same rows each time.

    Every piece gets one place; a sequence holds at most capacity ids, without gaps from offset 0.
    Without pieces the result is empty.
    """
    spark = cut.sparkSession
    units = F.ceil(F.col("length") / grain).cast("int")
    keyed = cut.withColumn("units", units)
    plan = plan or Plan(cut, capacity, grain)
    places = spark.createDataFrame(
        _intervals(plan.bins),
        "units int, first long, last long, sequence long, each long",
    )
    buckets = max(1, plan.pieces // BUCKET_ROWS)
    keyed = keyed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    within = Window.partitionBy("units", "bucket").orderBy("doc_id", "start")
    numbered = materialize(keyed.withColumn("number", F.row_number().over(within) - 1), "packing-numbers")
    before = Window.partitionBy("units").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy("units", "bucket").agg(F.count("*").alias("n")).select(
        "units", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    ranked = numbered.join(offsets, ["units", "bucket"]).withColumn("rank", F.col("number") + F.col("before"))
    # bounded: a pattern holds few lengths, and patterns number capacity / grain and the bins of what they leave over
    placed = ranked.alias("r").join(
        F.broadcast(places.alias("p")),
        F.expr("r.units = p.units AND r.rank >= p.first AND r.rank < p.last"),
    )
    slot = F.expr("r.rank - p.first")
    columns = [F.col(f"r.{c}") for c in cut.columns]
    placed = placed.select(
        *columns, F.col("r.units"), slot.alias("slot"),
        (F.col("p.sequence") + F.floor(slot / F.col("p.each"))).alias("sequence_id"),
    )
    order = Window.partitionBy("sequence_id").orderBy(F.col("units").desc(), "slot")
    offset = F.sum("length").over(order) - F.col("length")
    return placed.withColumn("offset", offset).drop("units", "slot")


def pack_fine(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Places of pieces whose lengths are multiples of GRAIN or below it; the short ones fill sequences of their own to the last id."""
    even = pack(cut.where(F.col("length") % GRAIN == 0), capacity)
    even = materialize(even, "packing-even")
    first = even.agg(F.max("sequence_id")).first()[0]
    short = pack(cut.where(F.col("length") % GRAIN != 0), capacity, 1)
    return even.unionByName(short.withColumn("sequence_id", F.col("sequence_id") + F.lit(0 if first is None else first + 1)))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces that kept their ids."""
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids")
    )


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; the texts are tokenized once, for either cut."""
    cut = materialize(pieces(docs, tokenizer, end_id, capacity, keep_ids, both=True), "packing-pieces")
    coarse, finer = (cut.where(F.col("fine") == kind).drop("fine") for kind in (False, True))
    slim = coarse if keep_ids else coarse.drop("ids")
    plan = Plan(slim, capacity)
    if plan.padding <= PADDING:
        return pack(slim, capacity, plan=plan)
    return pack_fine(finer if keep_ids else finer.drop("ids"), capacity)
