import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwise.llm import cutting_stock, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "Hello, World! it's  a\ttest\n", "a" * 5000, "<|endoftext|> x <|startoftext|>y", "é́ ́x ÉCOLE", "日本 語。", "1234 5,6",
    "x y z\x1cq", "don't 's", "\U0001f600\U0001f600",
]


def ids_of(text):
    return np.array([*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_pieces_are_the_tokenizers_ids(spark):
    texts = [*ODD, " ".join(f"word{i}" for i in range(9000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("units", F.lit(1))
    out = packing.pack_documents(docs, PATH, 2, keep_ids=True).collect()
    found = defaultdict(list)
    for r in out:
        found[r["doc_id"]].append(r)
    for i, text in enumerate(texts):
        want, at = ids_of(text), 0
        for r in sorted(found[i], key=lambda r: r["start"]):
            cut = want[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"], r["ids"]) == (at, len(want), zlib.crc32(cut.tobytes()), cut.tolist())
            at += r["length"]
        assert at == len(want)
    check_places(out)


def check_places(rows):
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(places)


def test_little_padding_and_repeated_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 900), 0, int(n)) for i, n in enumerate(np.clip(rng.lognormal(6.5, 1, 1000), 1, 4096))]
    cut = spark.createDataFrame(rows, "doc_id long, start long, length long")
    out = packing.pack(cut).collect()
    assert len(out) == len(rows)
    used = check_places(out)
    assert used * 4096 < 1.02 * sum(n for *_, n in rows) + 4096


@pytest.mark.parametrize("low, high, rows", [(1, 8, 30_000), (9, 24, 12_000), (2049, 2049, 60), (1300, 1500, 90)])
def test_little_padding_whatever_the_lengths(spark, low, high, rows):
    """A text of n words that the vocabulary knows is n ids and the end."""
    rng = np.random.default_rng(4)
    sizes = rng.integers(low, high + 1, rows)
    docs = spark.createDataFrame([(i, "the " * (int(n) - 1)) for i, n in enumerate(sizes)], "doc_id long, text string")
    out = packing.pack_documents(docs, PATH, 2).collect()
    total = sum(r["length"] for r in out)
    assert total == sizes.sum()
    used = check_places(out)
    assert used * packing.CAPACITY <= 1.02 * total + 2 * packing.CAPACITY  # the last ones of either cut
    covered = defaultdict(list)
    for r in out:
        covered[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
    for parts in covered.values():
        at = 0
        for start, length, tokens in sorted(parts):
            assert start == at
            at += length
        assert at == tokens


def test_fine_cuts_cover_every_id():
    for n in [*range(1, 40), 511, 512, 513, 4095, 4096, 4097, 9001]:
        parts = packing.cuts(n, 4096, True)
        assert [a for a, _ in parts] == [0, *[b for _, b in parts[:-1]]] and parts[-1][1] == n
        assert all((b - a) % packing.GRAIN == 0 or b - a < packing.GRAIN for a, b in parts)


def test_sequences_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    whole = packing.sequences(packing.pack_documents(docs, PATH, 2, keep_ids=True)).collect()
    assert sum(len(r["ids"]) for r in whole) == len(ids_of("a b")) + len(ids_of("c"))
    assert packing.pack_documents(docs.limit(0), PATH, 2).count() == 0


def test_cutting_stock_is_near_its_bound():
    demand = np.zeros(100, np.int64)
    demand[[44, 33, 20]] = [970, 6100, 3950]  # lengths 45, 34, 21
    bins = cutting_stock.plan(demand, 100)
    held = np.zeros(100, np.int64)
    for pattern, times in bins:
        assert sum(u * n for u, n in pattern.items()) <= 100
        for u, n in pattern.items():
            held[u - 1] += n * times
    assert (held >= demand).all()
    # 970 of 45 + 34 + 21, 2565 of 34 + 34 + 21 and 104 of four 21 hold everything
    assert sum(t for _, t in bins) <= 970 + 2565 + 104
    assert cutting_stock.plan(np.zeros(100, np.int64), 100) == []


def test_one_tokenization_gives_both_cuts(spark):
    texts = [None, "a b", " ".join(f"word{i}" for i in range(1500)), "the " * 700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    both = packing.pieces(docs, PATH, 2, both=True).collect()
    for fine in (False, True):
        alone = packing.pieces(docs, PATH, 2, fine=fine).collect()
        assert sorted(tuple(r)[:-1] for r in both if r["fine"] == fine) == sorted(tuple(r) for r in alone)
