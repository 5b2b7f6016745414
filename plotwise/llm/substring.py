"""Repeated passages by a join of window hashes over the whole corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plotwise.llm.spark import stored
from plotwise.llm.words import grams, hash_strings, inside, lists, slices, split_words

WINDOW = 20
ANCHOR = 8  # words of an anchor
LAST = 2**63 - 1  # the place of rows without an id: after all others


def _running_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` consecutive values, by doubling."""
    done, low = 1, values
    while done * 2 <= width:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    return np.minimum(low[: len(values) - width + 1], low[width - done : len(values) - done + 1]) if done < width else low


def _windows(words, size: int):
    """Hash of every window, which document it is of, and whether it starts earlier there."""
    hashes = grams(hash_strings(words.vocabulary)[words.codes], size)
    real = np.flatnonzero(inside(words.starts, size))
    rows = np.repeat(np.arange(len(words.starts) - 1), np.diff(words.starts))[real]
    hashes = hashes[real]
    order = np.lexsort((hashes, rows))  # stable: equal windows stay in order of place
    again = np.zeros(len(real), bool)
    again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
    return hashes, rows, real, again


def _anchors(window: int, anchor: int):
    """Anchors of each document: the smallest anchor hash of every window, once each.

    Equal windows have equal anchors, whatever stands around them, and neighbouring windows
    mostly share theirs: a seventh as many values as there are windows.
    """

    def read(batches):
        for part in slices(batches):
            words = split_words(part.column("text"))
            n = part.num_rows
            hashes = grams(hash_strings(words.vocabulary)[words.codes], anchor)
            values, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            if words.starts[-1] >= window:
                low = _running_min(hashes, window - anchor + 1)
                real = np.flatnonzero(inside(words.starts, window))
                rows = np.repeat(np.arange(n), np.diff(words.starts))[real]
                values = low[real]
                order = np.lexsort((values, rows))
                values, rows = values[order], rows[order]
                first = np.ones(len(rows), bool)
                first[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
                values, rows = values[first], rows[first]
            offsets = np.searchsorted(rows, np.arange(n + 1))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("key", "row", "copy_key")), lists(values.view(np.int64), offsets, pa.int64())],
                ["key", "row", "copy_key", "anchors"],
            )

    return read


def _repeated_windows(window: int, anchor: int):
    """Windows whose anchor occurs in several documents, once per document."""

    def read(batches):
        for part in slices(batches):
            words = split_words(part.column("text"))
            if words.starts[-1] < window:
                continue
            hashes, rows, real, again = _windows(words, window)
            low = _running_min(grams(hash_strings(words.vocabulary)[words.codes], anchor), window - anchor + 1)[real]
            hits = part.column("anchors")
            known_rows = np.repeat(np.arange(part.num_rows), pc.list_value_length(hits).to_numpy(zero_copy_only=False))
            known = hits.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            # a pair (document, anchor) as one value; a clash only lets a window through
            salt = np.uint64(0x9E3779B97F4A7C15)
            wanted = np.isin(
                low + rows.astype(np.uint64) * salt, known + known_rows.astype(np.uint64) * salt
            )
            take = wanted & ~again
            keys, texts = (part.column(c).to_numpy(zero_copy_only=False)[rows[take]] for c in ("key", "row"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[take].view(np.int64)), pa.array(keys, pa.int64()), pa.array(texts, pa.int64())],
                ["hash", "key", "row"],
            )

    return read


def _factors(starts, sources, window: int):
    """Windows already found, from left to right, as stretches of one source; decides nothing.

    `starts` are windows that occur earlier. Windows across two factors are among them, so
    what factors cover is what the windows cover.
    """
    out, at = [], 0
    breaks = np.flatnonzero((np.diff(starts) != 1) | (sources[1:] != sources[:-1])) + 1
    for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(starts)]):
        start, end = max(int(starts[a]), at), int(starts[b - 1]) + window
        if end > start:
            out.append({"start": start, "words": end - start, "source": int(sources[a])})
            at = end
    return out


FOUND = (
    "doc_id long, n_words long, n_removed long, kept_text string, "
    "spans array<struct<start:long,end:long>>, factors array<struct<start:long,words:long,source:long>>"
)
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
FACTORS = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("source", pa.int64())]))


def _parse(window: int):
    """Flag the windows that the index answered, and cut the spans out."""

    def read(batches):
        for part in slices(batches):
            words = split_words(part.column("text"))
            n = part.num_rows
            texts, keys = part.column("text"), part.column("key").to_numpy(zero_copy_only=False)
            copy_of = part.column("copy_of").to_pylist()
            known, sources_known = part.column("hashes"), part.column("sources")
            counts = np.diff(words.starts)
            removed, kept, spans, factors = np.zeros(n, np.int64), [], [], []
            hashes, rows, real, again = _windows(words, window)
            bounds = np.searchsorted(rows, np.arange(n + 1))
            for i in range(n):
                a, b = bounds[i], bounds[i + 1]
                flagged = again[a:b].copy()
                source = np.full(b - a, keys[i], np.int64)
                if copy_of[i] is not None:
                    flagged[:] = True
                    source[:] = copy_of[i]
                elif known[i].is_valid and b > a:
                    seen = known[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    order = np.argsort(seen)
                    place = np.minimum(np.searchsorted(seen, hashes[a:b], sorter=order), len(seen) - 1)
                    hit = seen[order[place]] == hashes[a:b]
                    source[hit] = sources_known[i].values.to_numpy(zero_copy_only=False)[order[place]][hit]
                    flagged |= hit
                text = (texts[i].as_py() or "").encode().split()
                starts = np.flatnonzero(flagged)
                if not len(starts):
                    kept.append(b" ".join(text))
                    spans.append([])
                    factors.append([])
                    continue
                step = np.zeros(counts[i] + 1, np.int64)
                step[starts] += 1
                np.subtract.at(step, starts + window, 1)
                gone = np.cumsum(step[:-1]) > 0
                removed[i] = gone.sum()
                kept.append(b" ".join([text[j] for j in np.flatnonzero(~gone)]))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
                factors.append(_factors(starts, source[starts], window))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(spans, SPANS),
                    pa.array(factors, FACTORS),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text", "spans", "factors"],
            )

    return read


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text, spans, factors.

    Removed is each word covered by a window of `window` consecutive words whose sequence
    also starts earlier: in a document with a smaller id, or further left in its own.
    Spans are word places, end exclusive; factors say which earlier document (by id) each
    stretch repeats.

    The reference is the corpus itself, indexed in blocks by hash. The first index holds
    anchors: of each window the smallest hash of its 8-word grams, so a seventh of all
    places. Documents are looked up in every block by a join; windows whose anchor stands
    in one document only cannot repeat elsewhere. The remaining windows are looked up in
    the second index, of windows and the smallest document id of each. The windows answered
    decide what is removed; factors only group them by source afterwards. Windows are compared by 64-bit hashes of 64-bit
    word hashes. A document equal to an earlier one, letter by letter, is one factor.

    Null texts have no words. A null id counts as later than all others; rows that share an
    id are not earlier than each other, and each is answered for its own text (`row`). Other columns are ignored. An empty table gives an
    empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col), F.lit(LAST)).alias("key"),
        F.xxhash64(text_col).alias("row"),
        F.col(text_col).alias("text"),
    )
    own = ["key", "row"]
    marks = stored(
        rows.select(*own, "text", F.md5("text").alias("copy_key")).mapInArrow(
            _anchors(window, anchor), "key long, row long, copy_key string, anchors array<long>"
        ),
        "substring-anchors",
    )
    firsts = marks.groupBy("copy_key").agg(F.min("key").alias("first"), F.count("*").alias("n")).filter("n > 1")
    copies = (
        marks.select(*own, "copy_key").join(firsts, "copy_key").filter("first < key").groupBy(*own).agg(F.min("first").alias("copy_of"))
    )
    copies = stored(copies, "substring-copies")
    each = marks.select(*own, F.explode("anchors").alias("anchor"))
    shared = each.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    hits = each.join(shared, "anchor").groupBy(*own).agg(F.collect_set("anchor").alias("anchors"))
    hits = stored(hits.join(copies, own, "left_anti"), "substring-hits")
    windows = stored(
        rows.select(*own, "text")
        .join(hits, own)
        .mapInArrow(_repeated_windows(window, anchor), "hash long, key long, row long"),
        "substring-windows",
    )
    index = windows.groupBy("hash").agg(F.min("key").alias("source"), F.max("key").alias("last")).filter("source < last")
    answers = (
        windows.join(index.select("hash", "source"), "hash")
        .filter("source < key")
        .groupBy(*own)
        .agg(F.collect_set(F.struct("hash", "source")).alias("found"))
        .select(*own, F.col("found.hash").alias("hashes"), F.col("found.source").alias("sources"), F.lit(None).cast("long").alias("copy_of"))
    )
    whole = copies.select(
        *own, F.lit(None).cast("array<long>").alias("hashes"), F.lit(None).cast("array<long>").alias("sources"), "copy_of"
    )
    return rows.join(answers.unionByName(whole), own, "left").mapInArrow(_parse(window), FOUND)
