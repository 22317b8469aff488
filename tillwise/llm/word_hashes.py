"""64-bit hashes of words, remembered by each worker."""

from __future__ import annotations

import numpy as np
import xxhash

from tillwise.llm.common import only_memory

#: Words remembered by one worker; the memory is emptied beyond it.
REMEMBERED = 500_000

_hashes: dict[bytes, int] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    only_memory("hashes", _hashes.clear)
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    for w in words:
        if w not in _hashes:
            _hashes[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
