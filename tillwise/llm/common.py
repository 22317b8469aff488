"""Helpers the operators of this package share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as a regular expression; bytes.split() splits at the same characters.
SPACE = r"[\x20\x09-\x0D]+"

_shipped: set[str] = set()
_memories: dict[str, Callable[[], None]] = {}


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once per application, for sessions that were started without it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="tillwise-")) / package.name
        context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def only_memory(owner: str, clear: Callable[[], None]) -> None:
    """In a worker that jobs of several operators share, forget what the others remembered of words: one memory at a time."""
    for other in [name for name in _memories if name != owner]:
        _memories.pop(other)()
    _memories[owner] = clear


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5: the folds of the labelled rows. Null ids are in no fold."""
    return F.crc32(doc_id.cast("string")) % 5


def words_of(text: Column) -> Column:
    """Words of a text between ASCII white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it several times: a lambda's variable is not computed again, a shared expression is."""
    return F.transform(F.array(value), body)[0]


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece holds at most about limit bytes of text (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if total + size > limit and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)
