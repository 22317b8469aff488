"""Fill-in-the-middle: texts cut at unit borders into prefix, middle and suffix, and put in another order.

One possessive match of (unit)* over the whole text keeps the end of every repetition, so the number of units
and both cuts are read off match.ends(1). The cuts and the form follow from a hash of the id and a seed alone; they are
the same however the rows are dealt to tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import as_bytes, small_batches

#: A line with its break, or a last line without one; a repetition is never given back.
LINE = r"[^\n]*+\n|[^\n]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIELDS = "n long, form string, prefix_chars long, middle_chars long, output string"
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]


def draws(seed: int, doc_id: int) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 from sha256 of seed:id."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def cut(text: str, units: regex.Pattern, doc_id: int | None, seed: int, rate: int, spm: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    match = units.fullmatch(text)
    ends = [0, *match.ends(1)] if match else [0]
    n = len(ends) - 1
    if n == 0 or doc_id is None or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    h1, h2, h3, h4 = draws(seed, doc_id)
    if h3 % 100 >= rate:
        return n, "plain", None, None, text
    first, last = sorted((ends[h1 % (n + 1)], ends[h2 % (n + 1)]))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if h4 % 100 < spm:
        return n, "spm", first, last - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, last - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, unit: str = LINE, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of docs (doc_id, text, any more columns).

    Of 100 texts about rate are transformed, spm of 100 of these suffix first. A null text counts as empty. Plain, with
    null lengths, stay: empty texts, texts holding a marker, texts that the unit does not cover whole (n is 0 then),
    and rows with a null id, which nothing can be drawn for. Repeated rows count each and come out alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*+")
        for batch in small_batches(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            # bytes that are no UTF-8 come out as they went in
            texts = [t.decode("utf-8", "surrogateescape") for t in as_bytes(batch.column("text"))]
            rows = [cut(t, units, i, seed, rate, spm) for i, t in zip(ids, texts, strict=True)]
            rows = [(*r[:4], r[4].encode("utf-8", "surrogateescape")) for r in rows]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, _TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns[:4], columns[4].view(pa.string())], names)

    names = ["doc_id", *(f.split()[0] for f in FIELDS.split(", "))]
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, f"doc_id long, {FIELDS}")


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of. A transformed text holds no marker, so the three in its output are the cuts."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    return F.when(form == "plain", output).otherwise(
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))
    )


def digest(transformed: DataFrame) -> DataFrame:
    """Outputs and the texts restored from them as sha256."""
    return transformed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )
