"""Packing token sequences: best-fit start, then swap-based local search."""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from plotwise.llm.spark import in_arrow, stored
from plotwise.llm.words import SLICE_BYTES, slices, split_words

CAPACITY = 4096
END_ID = 1
BLOCK_PIECES = 8192  # pieces one task packs
PATIENCE = 6  # passes of the local search
CACHED_WORDS = 500_000  # stems a worker remembers; it changes no result
TAILS = ".,"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _WordIds:
    """Token ids of words between white space.

    The tokenizer drops white space and never joins across it, so a text's ids are its
    words' ids. A full stop or comma after a letter or digit is a word of its own to it,
    and A-Z are lower-cased, which lets many words share an entry. What is known is an Arrow
    array of stems beside one array of ids; nothing is kept per word in Python.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # every core has a task of its own
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()
        self.tails = {t: ids[0] for t in TAILS if len(ids := self._encode([t])[0]) == 1}

    def forget(self):
        self.known = pa.array([], pa.string())
        self.ends = np.zeros(1, np.int64)  # of each known stem's ids
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _places(self, stems: pa.Array) -> np.ndarray:
        """Where the stems stand among the known ones; unknown ones are encoded first."""
        if len(self.known) > CACHED_WORDS:
            self.forget()
        at = pc.index_in(stems, value_set=self.known)
        missing = stems.filter(pc.is_null(at))
        if not len(missing):
            return at.to_numpy()
        made = self._encode(missing.to_pylist())
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        flat = np.fromiter(chain.from_iterable(made), np.uint32, int(sizes.sum()))
        first = len(self.known)
        self.known = pa.concat_arrays([self.known, missing])
        self.ids = np.concatenate([self.ids, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        out = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(out < 0)
        out[new] = first + np.arange(len(new))
        return out

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each word the start and number of its stem's ids in self.ids, and its tail's id or -1."""
        tail = np.full(len(words), -1, np.int64)
        stems = words
        if self.tails:
            marks = "".join(map(re.escape, self.tails))
            tailed = pc.match_substring_regex(words, rf"[\p{{L}}\p{{N}}][{marks}]$")
            stems = pc.if_else(tailed, pc.utf8_slice_codeunits(words, 0, -1), words)
            for mark, number in self.tails.items():
                tail[pc.and_(tailed, pc.ends_with(words, mark)).to_numpy(zero_copy_only=False)] = number
        stems = pc.ascii_lower(stems).dictionary_encode()
        places = self._places(stems.dictionary)[stems.indices.to_numpy(zero_copy_only=False)]
        return self.ends[places], self.ends[places + 1] - self.ends[places], tail


def _word_ids(path: str) -> _WordIds:
    """One per worker process and vocabulary: kept among the modules, so tasks share it."""
    kept = sys.modules.setdefault("_plotwise_word_ids", types.ModuleType("_plotwise_word_ids"))
    if path not in kept.__dict__:
        kept.__dict__[path] = _WordIds(path)
    return kept.__dict__[path]


def _ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + lengths[i]] for all i, one after another."""
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


def _tokens(part: pa.RecordBatch, word_ids) -> tuple[np.ndarray, np.ndarray]:
    """All documents' ids with their end ids, and where each document starts."""
    words = split_words(part.column("text"))
    documents = np.arange(len(words.starts) - 1)
    if not words.starts[-1]:
        return np.full(len(documents), END_ID, "<u4"), np.arange(len(documents) + 1)
    starts, sizes, tail = (x[words.codes] for x in word_ids(words.vocabulary))
    lengths = sizes + (tail >= 0)
    # a word ends where the ids of all words before it do, and the end ids of the documents before
    ends = np.cumsum(lengths) + np.repeat(documents, np.diff(words.starts))
    of_document = np.concatenate([[0], np.cumsum(lengths)])[words.starts]
    cuts = of_document + np.arange(len(of_document))
    ids = np.empty(cuts[-1], "<u4")
    rest = np.ones(cuts[-1], bool)
    closing, tailed = cuts[1:] - 1, np.flatnonzero(tail >= 0)
    ids[closing], rest[closing] = END_ID, False
    at = ends[tailed] - 1
    ids[at], rest[at] = tail[tailed], False
    ids[rest] = _ragged(word_ids.ids, starts, sizes)
    return ids, cuts


PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int, with_ids: bool):
    def read(batches):
        word_ids, task = None, TaskContext.get()
        row = (task.partitionId() if task else 0) << 40
        for part in slices(batches, most_bytes=SLICE_BYTES):
            word_ids = word_ids or _word_ids(path)
            ids, starts = _tokens(part, word_ids)
            out = {k: [] for k in ("of", "row", "piece", "start", "length", "crc", "ids")}
            for i in range(part.num_rows):
                for piece, at in enumerate(range(starts[i], starts[i + 1], capacity)):
                    own = ids[at : min(at + capacity, starts[i + 1])]
                    out["of"].append(i)
                    out["row"].append(row)
                    out["piece"].append(piece)
                    out["start"].append(at - starts[i])
                    out["length"].append(len(own))
                    out["crc"].append(zlib.crc32(own.tobytes()))
                    if with_ids:
                        out["ids"].append(own.astype(np.int32))
                    row += 1
            columns = [
                pc.take(part.column("doc_id"), pa.array(out["of"], pa.int64())),
                pa.array(out["row"], pa.int64()),
                pa.array(out["piece"], pa.int32()),
                pa.array(out["start"], pa.int64()),
                pa.array(out["length"], pa.int64()),
                pa.array(out["crc"], pa.int64()),
            ]
            names = ["doc_id", "row", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(out["ids"], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return read


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Longest first, each into the fullest bin that has room; the bin of each piece."""
    bins = np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made = 0, 0  # rooms: a bit for each room that some bin has
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = capacity, made
            made += 1
        bins[i] = chosen
        by_room[room - n].append(chosen)
        rooms |= 1 << (room - n)
    return bins


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer: by volume, and by pieces of which no two fit together."""
    return max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))


def _trade(giver: int, lengths, bins, fill, capacity: int):
    """The exchange that shifts most tokens from the giver: (given, taken, target, shift) or None.

    A shift of d from a bin of fill s to one of fill t raises the sum of squares if t + d > s.
    """
    own = np.flatnonzero(bins == giver)
    _, at = np.unique(lengths[own], return_index=True)
    offers = {int(lengths[i]): (i,) for i in own[at]}
    room = capacity - fill
    targets = np.flatnonzero((fill > 0) & (room > 0))
    targets = targets[targets != giver]
    best = None
    shift = 0
    for given, items in offers.items():  # moves
        fits = targets[(room[targets] >= given) & (fill[targets] + given > fill[giver])]
        if len(fits) and given > shift:
            best, shift = (items, (), int(fits[np.argmin(room[fits])])), given
    if best is None:
        for x in range(len(own)):
            for y in range(x):
                offers.setdefault(int(lengths[own[x]] + lengths[own[y]]), (own[x], own[y]))
        items = np.flatnonzero((fill[bins] < capacity) & (bins != giver))
        theirs, into = lengths[items], bins[items]
        limit, gain = room[into], fill[into] - fill[giver]
        for given, mine in offers.items():  # one for one, two for one
            d = given - theirs
            d = np.where((d > shift) & (d <= limit) & (gain + d > 0), d, 0)
            j = int(np.argmax(d)) if len(d) else 0
            if len(d) and d[j] > shift:
                best, shift = (mine, (items[j],), int(into[j])), int(d[j])
    return best and (*best, shift)


def local_search(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Exchanges between underfull bins that raise the sum of squared fills, to empty bins.

    In each pass every underfull bin, the emptiest first, gives what it can: it moves a
    piece, or trades one piece or two for one smaller piece. The search ends when no bin
    can be spared, or when PATIENCE passes in a row have emptied none.
    """
    lengths, bins = lengths.astype(np.int64), bins.copy()
    fill = np.bincount(bins, weights=lengths, minlength=bins.max(initial=-1) + 1).astype(np.int64)
    bound, fewest, waited = least_bins(lengths, capacity), len(fill) + 1, 0
    while (used := int((fill > 0).sum())) > bound and waited < PATIENCE:
        waited = waited + 1 if used == fewest else 0
        fewest = used
        for giver in np.argsort(fill, kind="stable"):
            while 0 < fill[giver] < capacity and (trade := _trade(int(giver), lengths, bins, fill, capacity)):
                given, taken, target, shift = trade
                bins[list(given)] = target
                bins[list(taken)] = giver
                fill[target] += shift
                fill[giver] -= shift
            if int((fill > 0).sum()) <= bound:
                break
    return bins


def _pack(capacity: int, turn: int):
    """Pack one block; the emptiest bin of a block is marked loose."""

    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins = local_search(lengths, best_fit(lengths, capacity), capacity)
        order = np.lexsort((np.arange(len(bins)), bins))
        ends = np.cumsum(lengths[order])
        before = ends - lengths[order]
        first = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
        offset = np.zeros(len(bins), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        fill = np.bincount(bins, weights=lengths)
        loose = bins == np.argmin(np.where(fill > 0, fill, np.inf))
        block = table.column("block").to_numpy()
        table = table.append_column("sequence_id", pa.array((block * 2 + turn) * (1 << 24) + bins, pa.int64()))
        table = table.append_column("offset", pa.array(offset, pa.int64()))
        return table.append_column("loose", pa.array(loose, pa.bool_()))

    return pack


def _packed(pieces: DataFrame, capacity: int, turn: int) -> DataFrame:
    blocks = max(1, -(-pieces.count() // BLOCK_PIECES))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return (
        pieces.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(_pack(capacity, turn), f"{kinds}, block long, sequence_id long, offset long, loose boolean")
        .drop("block")
    )


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its token ids and an end id; longer ones are cut into pieces of
    `capacity`. Pieces are dealt by hash into blocks of some eight thousand, each packed by
    one task: best fit, longest first, then local search, until as few bins as the volume
    allows are left or no exchange helps. The emptiest bin of every block is taken apart
    and those pieces are packed once more together, so blocks cost next to nothing.

    A null or empty text is its end id alone. Every row is a document, also when ids repeat
    or are null: rows have numbers of their own here. Other columns are ignored. An empty
    table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = PIECES + (", ids array<int>" if with_ids else "")
    pieces = stored(in_arrow(rows, _pieces(path or vocabulary_path(), capacity, with_ids), schema), "packing-pieces")
    columns = [c for c in pieces.columns if c != "row"]
    full = pieces.filter(F.col("length") == capacity)
    first = stored(_packed(pieces.filter(F.col("length") < capacity), capacity, 0), "packing-first")
    second = _packed(first.filter("loose").drop("sequence_id", "offset", "loose"), capacity, 1)
    placed = [*columns, "sequence_id", "offset"]
    return (
        full.withColumn("sequence_id", -1 - F.col("row"))
        .withColumn("offset", F.lit(0).cast("long"))
        .select(*placed)
        .unionByName(first.filter("not loose").select(*placed))
        .unionByName(second.select(*placed))
    )
