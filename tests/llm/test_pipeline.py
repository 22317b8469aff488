import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm import brute
from tillwise.llm import personal_data, toxicity
from tillwise.llm.common import table


def redacted(text):
    out, at = [], 0
    for start, kind, end in brute.spans(text):
        if start >= at:
            out += [text[at:start], f"<{personal_data.KINDS[kind]}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_run_matches_a_plain_version(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}
    good = {i: t for i, t in docs.items() if not brute.quality(t)[-1]}  # too few labels for any cutoff
    kept = spark.createDataFrame(sorted(good.items()), "doc_id long, text string")
    scores = toxicity.score(kept, table(spark, SMALL, "labels")).collect()
    clean = {r["doc_id"]: good[r["doc_id"]] for r in scores if not r["predicted"]}
    groups = brute.near_duplicates(list(clean.items()))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, (_, component) in groups.items():
        if i == component:
            ids = np.array([*tokenizer.encode(redacted(clean[i] or ""), add_special_tokens=False).ids, 2], "<u4")
            for start in range(0, len(ids), 4096):
                cut = ids[start : start + 4096]
                want.add((i, start, len(cut), zlib.crc32(cut.tobytes()), len(ids)))
    rows = corpus_pipeline.run(spark, SMALL).collect()
    got = [(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows]
    assert len(got) == len(set(got)) and set(got) == want
    assert 0 < len(groups) < len(docs)


def test_stages_keep_the_columns_and_stand_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "a b c", "en", "s", 5), (2, "", "en", None, 0), (3, "x " * 30, None, "s", 60)]
    rows += [(4, " ".join(f"word{i}" for i in range(60)) + " me@x.org", "en", "s", 1)] * 2 + [(5, rows[-1][1] + " !", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        now = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SMALL)
            assert now.columns == docs.columns
        left = now.collect()
        if frame is docs:
            assert [(r["doc_id"], r["text"][-7:], r["n_chars"]) for r in left] == [(4, "<email>", len(left[0]["text"]))]
        else:
            assert left == []
        assert corpus_pipeline.STAGES[-1][1](spark, now, SMALL).count() == len(left)
