"""Language-model scores of documents by a causal self-attention model on subword ids.

Documents are dealt to shards by a hash of id and text and cut into blocks of bounded text once, so a block's documents
and their order follow from the table alone: each block keeps its distinct words with their counts in
training documents, which words each document holds, and its subword ids. Counting and looking up words
is one grouping by ranges of word hashes, so a frequent word costs one number a block. The ids' counts over all
training documents deal the ids to classes; the attention model predicts a token's class from the classes before it, and
the token's share within its class comes from the counts. In each round every block trains from the same parameters on
the windows of its training documents, each window in one of the rounds, and the blocks' parameters are averaged, weighted
by windows. A task adds up its blocks' parameters and puts out one vector; vectors are added up in groups of bounded size.
Scores depend on how the table is partitioned only by the rounding of these sums.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import attention
from tillwise.llm.common import fold_of
from tillwise.llm.word_hashes import word_hashes
from tillwise.session import materialize

#: Text of a block at most (or one document), of a shard on average, and words of one range of hashes.
BLOCK_BYTES, SHARD_BYTES, RANGE_WORDS = 4 << 20, 3 << 20, 500_000
#: Shards of a partition at most, where the cluster's cores do not ask for more partitions.
SHARDS_READ = 128
#: Blocks of a shard are told apart by these low digits of their number.
SHARD_BITS = 20
#: Vectors added up at once.
ADDED = 16
CLASSES, OWN_CLASS = 1024, 960
#: Rounds of averaging, which share out the windows; windows of a step; steps whose windows are gathered at once.
ROUNDS, BATCH, RATE = 3, 64, 0.015
GATHERED = 16
#: Windows scored at once.
SCORED = 720
BLOCK = (
    "block long, doc_ids array<long>, held array<boolean>, words array<long>, counts array<long>, "
    "doc_words binary, n_words array<long>, ids binary, n_ids array<long>"
)

_encodings: dict = {}


def _encoding(ranks_file: str, pattern: str):
    if ranks_file not in _encodings:
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[ranks_file] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[ranks_file]


def _pack(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def _sharded(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, held) with their shard, a shard's documents together and in an order of their own.

    The number of shards follows from the bytes of text and the rows. Rows that agree in id and text share a shard.
    """
    size, rows = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    shards = -(-((size or 0) + 64 * rows) // SHARD_BYTES) or 1
    parts = max(min(shards, 2 * docs.sparkSession.sparkContext.defaultParallelism), shards // SHARDS_READ)
    keyed = docs.withColumns(
        {"shard": F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)), "place": F.xxhash64(F.lit("place"), "doc_id", "text")}
    )
    dealt = keyed.repartitionById(parts, F.pmod("shard", F.lit(parts)).cast("int"))
    return dealt.sortWithinPartitions("shard", "place", "doc_id")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(block number, rows (doc_id, held, text)): a shard's rows in order, cut where they exceed the text of a block."""
    shard, number, rows, size = None, 0, [], 0
    for batch in batches:
        for own, doc_id, held, text in zip(
            *(batch.column(c).to_pylist() for c in ("shard", "doc_id", "held")), batch.column("text").cast(pa.binary()).to_pylist(), strict=True
        ):
            if rows and (own != shard or size + len(text or b"") > BLOCK_BYTES):
                yield (shard << SHARD_BITS) + number, rows
                number, rows, size = number + 1, [], 0
            if own != shard:
                shard, number = own, 0
            rows.append((doc_id, held, text or b""))
            size += len(text or b"")
    if rows:
        yield (shard << SHARD_BITS) + number, rows


def _blocks(docs: DataFrame, ranks_file: str, pattern: str, end_id: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks_file, pattern)
        end = int(word_hashes([b""]).view(np.int64)[0])
        for block, rows in _pieces(batches):
            texts = [t.lower() for _, _, t in rows]
            held = np.array([h for _, h, _ in rows], bool)
            split = [t.split() for t in texts]
            n_words = np.array([len(w) + 1 for w in split])
            hashes = np.concatenate([np.append(word_hashes(w).view(np.int64), end) for w in split])
            words, local = np.unique(hashes, return_inverse=True)
            counts = np.bincount(local[np.repeat(~held, n_words)], minlength=len(words))
            ids = [np.array([*encoding.encode_ordinary(t.decode("utf-8", "replace")), end_id], np.uint32) for t in texts]
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "block": block, "doc_ids": [i for i, _, _ in rows], "held": held.tolist(),
                        "words": words, "counts": counts, "doc_words": _pack(local.astype(np.uint32)), "n_words": n_words,
                        "ids": _pack(np.concatenate(ids)), "n_ids": [len(x) for x in ids],
                    }
                ],
                schema,
            )

    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [("block", pa.int64()), ("doc_ids", longs), ("held", pa.list_(pa.bool_())), ("words", longs), ("counts", longs),
         ("doc_words", pa.binary()), ("n_words", longs), ("ids", pa.binary()), ("n_ids", longs)]
    )
    return _sharded(docs).select("shard", "doc_id", "held", "text").mapInArrow(run, BLOCK)


def _ranges(blocks: DataFrame, parts: int) -> DataFrame:
    """(part, block, words, counts): a block's sorted words cut at the borders of parts equal ranges of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = np.array([-(2**63) + (2**64 * i) // parts for i in range(1, parts)], np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column("block")[i].as_py()
                words, counts = (np.asarray(batch.column(c)[i].values) for c in ("words", "counts"))
                cuts = [0, *np.searchsorted(words, borders).tolist(), len(words)]
                full = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()),
                        pa.array([words[cuts[p] : cuts[p + 1]] for p in full], pa.list_(pa.int64())),
                        pa.array([counts[cuts[p] : cuts[p + 1]] for p in full], pa.list_(pa.int64())),
                    ],
                    ["part", "block", "words", "counts"],
                )

    return blocks.select("block", "words", "counts").mapInArrow(run, "part int, block long, words array<long>, counts array<long>")


def _totals(part: pa.Table) -> pa.Table:
    """Of one range: each block's words' counts over all blocks; in a row without a block, how many tokens and words there are."""
    rows = part.combine_chunks()
    lengths = np.asarray(rows["words"].combine_chunks().value_lengths())
    words = np.asarray(rows["words"].combine_chunks().flatten())
    counts = np.asarray(rows["counts"].combine_chunks().flatten())
    distinct, at = np.unique(words, return_inverse=True)
    total = np.bincount(at, counts, len(distinct)).astype(np.int64)
    own = np.split(total[at], np.cumsum(lengths)[:-1])
    n, number = len(own), rows["part"][0].as_py()
    return pa.table(
        {
            "block": pa.array([*rows["block"].to_pylist(), None], pa.int64()),
            "part": pa.array([number] * (n + 1), pa.int32()),
            "totals": pa.array([*own, []], pa.list_(pa.int64())),
            "tokens": pa.array([0] * n + [int(total.sum())], pa.int64()),
            "distinct": pa.array([0] * n + [int((total > 0).sum())], pa.int64()),
        }
    )


def _base_scores(looked_up: DataFrame, tokens: int, distinct: int) -> DataFrame:
    """(block, i, n_tokens, n_known, base_score) for every document i of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                totals = np.concatenate([np.asarray(x["totals"], np.int64) for x in sorted(row["found"], key=lambda x: x["part"])])
                logs = np.log10(totals + 0.5) - np.log10(tokens + 0.5 * (distinct + 1))
                local, n = _unpack(row["doc_words"], np.uint32), np.asarray(row["n_words"])
                starts = np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(n), pa.int64()), pa.array(range(len(n)), pa.int32()), pa.array(n, pa.int64()),
                        pa.array(np.add.reduceat((totals > 0)[local].astype(np.int64), starts), pa.int64()),
                        pa.array(np.add.reduceat(logs[local], starts), pa.float64()),
                    ],
                    ["block", "i", "n_tokens", "n_known", "base_score"],
                )

    return looked_up.mapInArrow(run, "block long, i int, n_tokens long, n_known long, base_score double")


def _vector_batch(slot: int, vector: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([vector.tobytes()], pa.binary())], ["slot", "vector"])


def _task_vector(vector: np.ndarray) -> pa.RecordBatch:
    """One vector of a task, by the number of its partition."""
    return _vector_batch(TaskContext.get().partitionId(), vector)


def _vector_sum(vectors: DataFrame, at_most: int, size: int, kind) -> np.ndarray:
    """The sum of at most so many vectors (slot, vector), added up in groups until a few are left for the driver."""

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(size, kind)
        for v in rows["vector"]:
            total += np.frombuffer(v.as_py(), kind)
        return pa.Table.from_batches([_vector_batch(rows["slot"][0].as_py(), total)])

    while at_most > ADDED:
        at_most = -(-at_most // ADDED)
        vectors = vectors.withColumn("slot", F.col("slot") % at_most).groupBy("slot").applyInArrow(add, "slot long, vector binary")
    out = np.zeros(size, kind)
    for row in vectors.orderBy("slot").collect():
        out += np.frombuffer(row["vector"], kind)
    return out


def _id_counts(blocks: DataFrame, n_blocks: int, size: int) -> np.ndarray:
    """How often each subword id occurs in training documents; as many numbers as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                train = np.repeat(~np.asarray(row["held"], bool), row["n_ids"])
                total += np.bincount(_unpack(row["ids"], np.uint32)[train], minlength=size)
        if total.any():
            yield _task_vector(total)

    found = blocks.select("held", "n_ids", "ids").mapInArrow(run, "slot long, vector binary")
    return _vector_sum(found, n_blocks, size, np.int64)


def deal_classes(counts: np.ndarray, classes: int = CLASSES, own: int = OWN_CLASS) -> np.ndarray:
    """The class of each id: one each for the most frequent ids, and about equal shares of the rest for the others."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    out = np.empty(len(counts), np.int64)
    out[order[:own]] = np.arange(own)
    rest = counts[order[own:]] + 0.5
    share = (np.cumsum(rest) - rest / 2) / rest.sum()
    out[order[own:]] = own + np.minimum((share * (classes - own)).astype(np.int64), classes - own - 1)
    return out


def _windows_of_round(held: np.ndarray, doc: np.ndarray, number: np.ndarray, round_: int) -> np.ndarray:
    """Places of the windows that a round trains on: the rounds together take every window of every training document once."""
    return np.flatnonzero(~held[doc] & ((number + doc) % ROUNDS == round_))


def _train(blocks: DataFrame, n_blocks: int, class_of: np.ndarray, start: np.ndarray, classes: int, round_: int) -> np.ndarray:
    """Parameters after one round: every block trains from start on its windows, and the results are averaged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(start) + 1)
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                n, held = np.asarray(row["n_ids"]), np.asarray(row["held"], bool)
                doc, first, number = attention.windows(n)
                taken = np.random.default_rng(round_).permutation(_windows_of_round(held, doc, number, round_))
                if not len(taken):
                    continue
                adam = attention.Adam(attention.unflat(start, classes), RATE / (1 + round_))
                x, starts = class_of[_unpack(row["ids"], np.uint32)], np.cumsum(n) - n
                for i in range(0, len(taken), GATHERED * BATCH):
                    t = taken[i : i + GATHERED * BATCH]
                    gathered = attention.gather(x, starts, n, doc[t], first[t], classes)
                    for j in range(0, len(t), BATCH):
                        adam.update(attention.gradients(adam.params, *(g[j : j + BATCH] for g in gathered)))
                total[:-1] += attention.flat(adam.params).astype(float) * len(taken)
                total[-1] += len(taken)
        if total[-1]:
            yield _task_vector(total)

    trained = blocks.select("held", "n_ids", "ids").mapInArrow(run, "slot long, vector binary")
    total = _vector_sum(trained, n_blocks, len(start) + 1, np.float64)
    return total[:-1] / total[-1] if total[-1] else start.astype(float)


def _model_scores(blocks: DataFrame, class_of: np.ndarray, log_within: np.ndarray, values: np.ndarray, classes: int) -> DataFrame:
    """(block, i, doc_id, held_out, score) for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params = attention.unflat(values, classes)
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                n, ids = np.asarray(row["n_ids"]), _unpack(row["ids"], np.uint32)
                x, starts = class_of[ids], np.cumsum(n) - n
                doc, first, _ = attention.windows(n)
                score = np.add.reduceat(log_within[ids], starts)
                for i in range(0, len(doc), SCORED):
                    d = doc[i : i + SCORED]
                    inputs, real, target, valid = attention.gather(x, starts, n, d, first[i : i + SCORED], classes)
                    logs = np.where(valid, attention.log_shares(params, inputs, real, target), 0).sum(1, dtype=np.float64)
                    np.add.at(score, d, logs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(n), pa.int64()), pa.array(range(len(n)), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(score / np.log(10)),
                    ],
                    ["block", "i", "doc_id", "held_out", "score"],
                )

    return blocks.select("block", "doc_ids", "held", "n_ids", "ids").mapInArrow(
        run, "block long, i int, doc_id long, held_out boolean, score double"
    )


def score_documents(docs: DataFrame, ranks_file: str, pattern: str, end_id: int, vocabulary: int) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of docs (doc_id, text, more columns).

    Null and empty texts are the end token alone. Rows without an id are training rows; repeated rows count and are scored
    each. Words are told apart by 64-bit hashes. Without training rows the scores are those of the uniform smoothing.
    Rows that agree in id and text train in one shard, in blocks of bounded text.
    """
    doc_id = F.col("doc_id").cast("long")
    held = F.coalesce(fold_of(doc_id) == 1, F.lit(False))
    blocks = materialize(
        _blocks(docs.select(doc_id.alias("doc_id"), "text", held.alias("held")), ranks_file, pattern, end_id), "lm-blocks"
    )
    entries, n_blocks = blocks.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)), F.count("*")).first()
    parts = max(16, entries // RANGE_WORDS)
    totals = materialize(
        _ranges(blocks, parts).groupBy("part").applyInArrow(
            _totals, "block long, part int, totals array<long>, tokens long, distinct long"
        ),
        "lm-totals",
    )
    tokens, distinct = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    found = totals.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("part", "totals")).alias("found"))
    base = _base_scores(blocks.select("block", "doc_words", "n_words").join(found, "block"), tokens, distinct)

    counts = _id_counts(blocks, n_blocks, vocabulary)
    class_of = deal_classes(counts)
    sizes, mass = np.bincount(class_of, minlength=CLASSES), np.bincount(class_of, counts, CLASSES)
    log_within = np.log(counts + 0.5) - np.log(mass + 0.5 * sizes)[class_of]
    values = attention.flat(attention.initial((mass + 0.5 * sizes) / (mass + 0.5 * sizes).sum()))
    if counts.any():
        for round_ in range(ROUNDS):
            values = _train(blocks, n_blocks, class_of, values, CLASSES, round_)
    scores = _model_scores(blocks, class_of, log_within, values, CLASSES)
    return scores.join(base, ["block", "i"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"), "base_score", "score"
    )
