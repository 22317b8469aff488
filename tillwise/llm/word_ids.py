"""Token ids word by word: a tokenizer that joins nothing over a word's end sees each distinct word once per worker."""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from tillwise.llm.common import only_memory

#: Words remembered by one worker; the memory is emptied beyond it.
REMEMBERED = 600_000

#: Words on which the way by letter runs must agree with the tokenizer before it is used.
SAMPLES = ["word", "Word.", "ÉCOLE,", "straße...", "l'été", "don't", "a1", "x.,", "...", "ñandú.", "it's,", "ŁÓDŹ"]

_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of texts, cut into words by split; a text's ids must be those of its words in turn.

    With runs, words that are a run of Latin letters and perhaps points and commas share the ids of their run.
    """

    def __init__(self, tokenizer: Tokenizer, split: Callable[[bytes], list[bytes]], runs: bool = False):
        self.tokenizer, self.split, self.runs = tokenizer, split, False
        self._clear()
        if runs and self._by_runs(SAMPLES) == self._whole(SAMPLES):
            self.runs = True

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.start = np.zeros(1, np.int64)
        self.run_ids: dict[str, bytes] = {}

    # ids as bytes of unsigned 32-bit numbers: millions of lists would keep the garbage collector busy
    def _whole(self, words: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _by_runs(self, words: list[str]) -> list[bytes]:
        known, out, others = self.run_ids, [], []
        for i, word in enumerate(words):
            run = word.rstrip(".,")
            low = run.lower()
            # beyond these letters, lower case and composition depend on more than the letter
            if not low.isalpha() or max(low) > "\u024f":
                others.append(i)
                out.append(b"")
                continue
            ids = known.get(low)
            if ids is None:
                shown = low if low.isascii() else self.tokenizer.pre_tokenizer.pre_tokenize_str(low)[0][0]
                ids = known[low] = array("I", [x.id for x in self.tokenizer.model.tokenize(shown)]).tobytes()
            tail = word[len(run) :]
            if tail:
                if tail not in known:
                    known[tail] = self._whole([tail])[0]
                ids = ids + known[tail]
            out.append(ids)
        for i, ids in zip(others, self._whole([words[i] for i in others]), strict=True):
            out[i] = ids
        return out

    def _learn(self, words: set[bytes]) -> None:
        fresh = [w for w in words if w not in self.index]
        if not fresh:
            return
        texts = [w.decode("utf-8", "replace") for w in fresh]
        lists = self._by_runs(texts) if self.runs else self._whole(texts)
        self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh)), strict=True))
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(lists), np.uint32)])
        ends = self.start[-1] + np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)) // 4)
        self.start = np.concatenate([self.start, ends])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        return self.looked_up(texts)[0]

    def looked_up(self, texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text, and the places of its words in the memory."""
        if len(self.index) > REMEMBERED:
            self._clear()
        split = [self.split(t) for t in texts]
        words = list(chain.from_iterable(split))
        self._learn(set(words))
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        begin, count = self.start[at], self.start[at + 1] - self.start[at]
        total = np.concatenate([[0], np.cumsum(count)])
        flat = self.ids[np.arange(total[-1]) + np.repeat(begin - total[:-1], count)]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in split])]).astype(np.int64)
        edges = total[ends]
        ids = [flat[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return ids, [at[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file that drops white space, kept between tasks."""
    only_memory("ids", _encoders.clear)
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[path] = WordEncoder(Tokenizer.from_file(path), bytes.split, runs=True)
    return _encoders[path]
