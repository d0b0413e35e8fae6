"""Words and word shingles: one definition for all operators on shingles.

A word is a run of characters other than the six ASCII white-space characters; A-Z are lower-cased, nothing else is.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = r"[\x20\x09-\x0D]+"
#: Words a worker remembers the hash of before it starts afresh.
MEMO = 400_000
_HASHES: dict[str, int] = {}
_ODD = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: Column) -> Column:
    """The words of a text, lower-cased, with one space between them; null and wordless texts become empty."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(lower, WHITE, " "))


def word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    missing = set(words).difference(_HASHES)
    if missing:
        if len(_HASHES) + len(missing) > MEMO:
            _HASHES.clear()
            missing = set(words)
        _HASHES.update((w, xxhash.xxh3_64_intdigest(w)) for w in missing)
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` words."""
    n = len(hashes) - width + 1
    found = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(width):
        found *= _ODD
        found += hashes[k : k + len(found)]
    return found


def shingle_set(normal: str, width: int) -> set:
    """The distinct shingles of a normalised text; shorter texts are one shingle, empty ones have none."""
    words = normal.split(" ") if normal else []
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width))))
