"""Encoding and decoding of whole texts with a SentencePiece model on the tokenizers library."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, normalizers

from tillwise.llm.common import as_bytes, small_batches
from tillwise.llm.piece_model import MARK, PieceModel
from tillwise.llm.word_ids import WordEncoder

#: Threads of the library within a task.
THREADS = 2

_WORDS = re.compile(rb" *[^ ]+| +")
_codecs: dict[str, Codec] = {}


def _split(text: bytes) -> list[bytes]:
    """Words, each with the spaces before it; spaces at the end are a word."""
    text = text.replace(MARK.encode(), b" ")
    if text[:1] == b" " and b"  " not in text and text[-1:] != b" ":
        return [b" " + w for w in text[1:].split(b" ")]
    return _WORDS.findall(text)


class Codec:
    """Encoder and decoder of one model file. Where no piece reaches over a space, words are looked up one by one."""

    def __init__(self, path: str, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        model = PieceModel.read(path)
        self.tokenizer = model.tokenizer()
        self.prefix = b" " if model.dummy_prefix else b""
        plain = not model.char_map and not model.trim_spaces and model.escape_spaces
        self.words = None
        if plain and self.tokenizer.pre_tokenizer is not None:
            bare: Tokenizer = model.tokenizer()
            bare.normalizer = normalizers.Replace(" ", MARK)
            # a mark in the text itself is a space to the model, so it is one here
            self.words = WordEncoder(bare, _split)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if self.words is not None:
            return self.words.encode([self.prefix + t if t else t for t in texts])
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)


def codec(path: str, threads: int = THREADS) -> Codec:
    """The worker's codec of a model file, kept between tasks."""
    if path not in _codecs:
        _codecs[path] = Codec(path, threads)
    return _codecs[path]


def encode(docs: DataFrame, model: str, threads: int = THREADS) -> DataFrame:
    """(doc_id, ids) of every row of docs (doc_id, text, any more columns). Null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, threads)
        for b in small_batches(batches, "text"):
            ids = own.encode(as_bytes(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: str, threads: int = THREADS) -> DataFrame:
    """(doc_id, text) of every row of encoded (doc_id, ids); null and empty ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, threads)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                ids = [np.array(x or [], np.uint32) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(own.decode(ids), pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def _same_texts(own: Codec, other, ids: list[np.ndarray], threads: int) -> list[bool]:
    """Whether each text's ids decode to the same whole text in both libraries."""
    return [x == y for x, y in zip(own.decode(ids), other.decode([x.tolist() for x in ids], num_threads=threads), strict=True)]


def verify(docs: DataFrame, model: str, threads: int = THREADS) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, same_ids, round_trip) of every row of docs (doc_id, text, any more columns).

    same_ids: the ids are those of the sentencepiece library; round_trip: decoding them gives what that library decodes.
    Null texts count as empty; ids are hashed as little-endian unsigned 32-bit numbers; repeated rows count each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        own, other = codec(model, threads), sentencepiece.SentencePieceProcessor(model_file=model)
        for b in small_batches(batches, "text", 2 << 20):
            texts = as_bytes(b.column("text"))
            ids = own.encode(texts)
            same = [x.tolist() == y for x, y in zip(ids, other.encode([t.decode("utf-8", "replace") for t in texts], num_threads=threads), strict=True)]
            restored = _same_texts(own, other, ids, threads)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array(map(len, ids), pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array(same, pa.bool_()), pa.array(restored, pa.bool_()),
                ],
                ["doc_id", "n_ids", "ids_crc32", "same_ids", "round_trip"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_ids long, ids_crc32 long, same_ids boolean, round_trip boolean")
