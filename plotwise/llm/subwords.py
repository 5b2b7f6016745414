"""Character n-grams of words as hashed buckets, vectorised over a vocabulary."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plotwise.llm.words import mix

EDGES = "<>"


def plain(words: pa.Array) -> pa.Array:
    """Lower case, without punctuation at the ends; what is left may be empty."""
    return pc.replace_substring_regex(pc.utf8_lower(words), r"^[\p{P}\p{S}]+|[\p{P}\p{S}]+$", "")


def subwords(words: pa.Array, shortest: int, longest: int, bits: int):
    """Yields (word places in ascending order, buckets) for each length of n-gram.

    Words are put between edge marks and taken as code points. A word shorter than an
    n-gram has none of that length.
    """
    text = pc.binary_join_element_wise(EDGES[0], words, EDGES[1], "")
    lengths = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(text.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    places = np.arange(len(points))
    rolling = np.zeros(len(points), np.uint64)
    for n in range(1, longest + 1):
        size = len(points) - n + 1
        if size <= 0:
            return
        rolling = rolling[:size] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :] + np.uint64(n)
        if n >= shortest:
            ok = np.flatnonzero(places[:size] + n <= ends[:size])
            yield word[ok], (mix(rolling[ok]) >> np.uint64(64 - bits)).astype(np.int64)


def mean_over_subwords(words: pa.Array, table: np.ndarray, shortest: int, longest: int, bits: int) -> np.ndarray:
    """Mean of the table's rows over each word's n-grams; table is (buckets,) or (buckets, d)."""
    total = np.zeros((len(words), *table.shape[1:]))
    count = np.zeros(len(words))
    for word, bucket in subwords(words, shortest, longest, bits):
        if not len(word):
            continue
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        total[word[first]] += np.add.reduceat(table[bucket], first, axis=0)
        count += np.bincount(word, minlength=len(words))
    return total / np.maximum(count, 1).reshape(-1, *[1] * (table.ndim - 1))
