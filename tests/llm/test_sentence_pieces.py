import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from tillwise.llm import sentence_pieces
from tillwise.llm.piece_model import PieceModel

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  a  b ", "\n\n", "a\tb", "日本語 text", "\U0001f600 ok", "▁x ▁", "<s> </s> <0x0A> <unk>", "a" * 3000, "x \xa0y", "\x00a", "é é",
    "The end.\r\n" * 50, " ".join(f"w{i}" for i in range(20_000)),
]


def test_ids_and_texts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, "z")], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    other = sentencepiece.SentencePieceProcessor(model_file=PATH)
    encoded = sentence_pieces.encode(docs, PATH)
    ids = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert ids == {**{i: other.encode(t or "") for i, t in enumerate(TEXTS)}, None: other.encode("z")}
    back = {r["doc_id"]: r["text"] for r in sentence_pieces.decode(encoded, PATH).collect()}
    assert back == {**{i: (t or "").replace("▁", " ") for i, t in enumerate(TEXTS)}, None: "z"}
    for r in sentence_pieces.verify(docs, PATH).collect():
        assert r["same_ids"] and r["round_trip"] and r["n_ids"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["doc_id"]], "<u4").tobytes())
    assert sentence_pieces.verify(docs.limit(0), PATH).count() == 0


def test_round_trip_decodes_every_text_in_both_libraries():
    class Other(sentencepiece.SentencePieceProcessor):
        seen = 0

        def decode(self, ids, **more):
            self.seen += len(ids)
            return [x + "!" if x.startswith("wrong") else x for x in super().decode(ids, **more)]

    own, other = sentence_pieces.codec(PATH), Other(model_file=PATH)
    ids = own.encode([t.encode() for t in ("", "two words", "wrong words", "two words")])
    assert sentence_pieces._same_texts(own, other, ids, 1) == [True, True, False, True] and other.seen == 4


def _message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += bytes([number << 3]) + bytes([value]) if number < 16 else bytes([(number << 3) & 127 | 128, number >> 4, value])
        else:
            data = np.float32(value).tobytes() if isinstance(value, float) else value
            out += bytes([number << 3 | (5 if isinstance(value, float) else 2)])
            out += data if isinstance(value, float) else bytes([len(data)]) + data
    return out


def test_unigram_model_with_byte_fallback():
    pieces = [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("b", -2.0, 1), ("ab", -0.5, 1), ("▁", -3.0, 1), ("a", -3.0, 1)]
    pieces += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    data = b"".join(bytes([10, len(m)]) + m for m in (_message((1, p.encode()), (2, s), (3, k)) for p, s, k in pieces))
    spec = _message((3, 1), (35, 1))
    data += bytes([18, len(spec)]) + spec
    model = PieceModel.parse(data)
    assert (model.kind, model.byte_fallback, model.dummy_prefix, model.trim_spaces) == (1, True, True, True)
    tokenizer = model.tokenizer()
    names = [p for p, *_ in pieces]
    assert [names[i] for i in tokenizer.encode("ab", add_special_tokens=False).ids] == ["▁", "ab"] or [
        names[i] for i in tokenizer.encode("ab", add_special_tokens=False).ids
    ] == ["▁a", "b"]
    assert tokenizer.decode(tokenizer.encode(" b  é", add_special_tokens=False).ids, skip_special_tokens=False) == "b é"
