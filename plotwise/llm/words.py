"""Words and their hashes, a slice of an Arrow batch at a time.

A word is a run of characters other than the six ASCII white-space characters, as the
pattern `[^\\x20\\x09-\\x0D]+` finds them. Everything is vectorised: the words of a slice
are dictionary-encoded, so that work per distinct word is done once a slice.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle

import plotwise

# Python workers get these helpers with the function itself, as for the page reader.
cloudpickle.register_pickle_by_value(plotwise)

SLICE_BYTES = 8 << 20  # text held in one step by a Python worker; one row at least
LONG_WORD = 256  # bytes; longer words are hashed one by one


class Words(NamedTuple):
    codes: np.ndarray  # the word of each position, an index of vocabulary
    starts: np.ndarray  # where each document starts in codes, and the end
    vocabulary: pa.Array  # distinct words


def slices(batches, column="text", most_bytes=SLICE_BYTES):
    """Rows of record batches in steps of bounded text; a longer text is a step of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        step = np.cumsum(sizes.astype(np.int64)) // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def split_words(texts: pa.Array) -> Words:
    """The words of every text; a null has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    vocabulary = coded.dictionary
    empty = pc.index(vocabulary, "").as_py()  # beside white space at an end
    if empty >= 0:
        rows = np.repeat(np.arange(len(counts)), counts)
        real = codes != empty
        counts = np.bincount(rows[real], minlength=len(counts))
        codes = codes[real]
        codes = codes - (codes > empty)
        vocabulary = pa.concat_arrays([vocabulary[:empty], vocabulary[empty + 1 :]])
    return Words(codes, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), vocabulary)


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def hash_strings(strings: pa.Array) -> np.ndarray:
    """64-bit hashes of non-empty strings: a sum of bytes times random multipliers, mixed."""
    n = len(strings)
    if not n:
        return np.zeros(0, np.uint64)
    raw = pc.cast(strings, pa.binary())
    if raw.offset:
        raw = pa.concat_arrays([raw])
    offsets = np.frombuffer(raw.buffers()[1], np.int32, n + 1).astype(np.int64)
    lengths = np.diff(offsets)
    data = np.frombuffer(raw.buffers()[2], np.uint8, offsets[-1])[offsets[0] :]
    place = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], lengths)
    powers = _odd(11, LONG_WORD)
    products = (data.astype(np.uint64) + np.uint64(1)) * powers[np.minimum(place, LONG_WORD - 1)]
    out = mix(np.add.reduceat(products, offsets[:-1] - offsets[0]) + lengths.astype(np.uint64))
    for i in np.flatnonzero(lengths > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(raw[int(i)].as_py())
    return out


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive values; the order counts."""
    n = len(hashes) - k + 1
    if n <= 0:
        return hashes[:0]
    total = np.zeros(n, np.uint64)
    for j, factor in enumerate(_odd(100 + k, k)):
        total += hashes[j : j + n] * factor
    return mix(total)


def inside(starts: np.ndarray, k: int) -> np.ndarray:
    """Which of the k-grams over all documents' words lie in one document."""
    total = int(starts[-1])
    n = max(total - k + 1, 0)
    ends = np.repeat(starts[1:], np.diff(starts))
    return np.arange(n) + k <= ends[:n]


def lists(values: np.ndarray, offsets, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.asarray(offsets), pa.int32()), pa.array(values, kind))
