"""Collocations from FM-indexes of shards: bidirectional extension counts phrases, shards add up."""

from __future__ import annotations

from collections import defaultdict
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

import plotwise
from plotwise.llm.spark import in_arrow, stored
from plotwise.llm.words import slices
from plotwise.session import scratch_path, shuffles_freed

# Python workers get this module with the function itself.
cloudpickle.register_pickle_by_value(plotwise)

DEPTH = 4  # words of the longest phrase
LEAST = 30  # occurrences of a candidate
TOP = 2000  # rows reported for a language
SHARD_BYTES = 4 << 20  # text of one index; one document at least
SHARDS_PER_TASK = 1 << 24
SALTS = 64
IDS = 1 << 31

BREAKS = ".,;:!?\n\x0b\x0c\r"
KIND = np.zeros(256, np.uint8)  # of a byte: 0 part of a word, 1 blank, 2 ends a piece
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in BREAKS]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

SHARD = "shard long, lang string, n_words long, words array<string>, counts array<int>, forward binary, backward binary"


def coded(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """Word codes from 1 in order, 0 wherever a piece or a text ends, and the words of the codes."""
    raw = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    kind = KIND[raw]
    word = np.concatenate([[False], kind == 0, [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    data = LOWER[raw[word[1:-1]]]
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    words = words.dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ended = np.cumsum(kind == 2)[starts] if len(starts) else starts
    cut = np.flatnonzero(np.diff(ended)) + 1
    return np.concatenate([[0], np.insert(codes, cut, 0), [0]]), words.dictionary


def ordered(keys: np.ndarray, bound: int) -> np.ndarray:
    """Stable order of keys from 0 to below the bound."""
    bits = max(len(keys).bit_length(), 1)
    if bound << bits >= 2**63:
        return np.argsort(keys, kind="stable")
    packed = (keys.astype(np.int64) << bits) | np.arange(len(keys))
    packed.sort()
    return packed & ((1 << bits) - 1)


def _ranks(keys: np.ndarray, bound: int) -> np.ndarray:
    order = ordered(keys, bound)
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.concatenate([[0], np.diff(keys[order]) != 0]))
    return out


def transform(codes: np.ndarray, size: int, depth: int = DEPTH) -> np.ndarray:
    """Burrows-Wheeler transform with suffixes ordered by their first words only, depth at least.

    Phrases of up to depth words are whole runs of suffixes in it, as in a full sort.
    """
    rank, bound, width = codes.astype(np.int64), size + 1, 1
    while width < depth:
        keys = rank * bound + np.concatenate([rank[width:], np.zeros(min(width, len(rank)), np.int64)])[: len(rank)]
        rank = _ranks(keys, bound * bound)
        bound, width = len(rank) + 1, 2 * width
    return codes[ordered(rank, bound) - 1]


class Runs(NamedTuple):
    """Phrases of one length: their runs of suffixes in the forward and the backward index."""

    low: tuple[np.ndarray, np.ndarray]
    size: np.ndarray  # the occurrences; the same in both
    words: np.ndarray  # codes, a row per phrase

    def where(self, keep) -> Runs:
        return Runs((self.low[0][keep], self.low[1][keep]), self.size[keep], self.words[keep])


class Index:
    """A bidirectional FM-index: transforms of the text and of the reversed text."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, size: int):
        self.size = size
        self.last = (forward, backward)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(forward, minlength=size + 1))])
        self.steps = [None, None]

    @classmethod
    def of(cls, codes: np.ndarray, size: int) -> Index:
        return cls(transform(codes, size), transform(codes[::-1], size), size)

    def counts(self) -> np.ndarray:
        """Occurrences of every word code; of 0 the breaks."""
        return np.diff(self.first)

    def single(self, allowed: np.ndarray) -> Runs:
        """The runs of single words."""
        low = self.first[allowed]
        return Runs((low, low), self.first[allowed + 1] - low, allowed[:, None])

    def _step(self, side: int) -> np.ndarray:
        if self.steps[side] is None:
            order = ordered(self.last[side], self.size + 1)
            self.steps[side] = np.empty(len(order), np.int64)
            self.steps[side][order] = np.arange(len(order))
        return self.steps[side]

    def extended(self, runs: Runs, left: bool) -> Runs:
        """Every phrase made by one more word to the left or right, with its runs in both indexes.

        A run of suffixes tells the words before them; the one index steps to their runs and
        the other keeps them side by side in its own run, by word.
        """
        side = 0 if left else 1
        total = int(runs.size.sum())
        ends = np.cumsum(runs.size)
        begin = ends - runs.size
        parent = np.repeat(np.arange(len(runs.size)), runs.size)
        rows = np.arange(total) - np.repeat(begin - runs.low[side], runs.size)
        keys = parent * (self.size + 1) + self.last[side][rows]
        order = ordered(keys, (len(runs.size) + 1) * (self.size + 1))
        keys = keys[order]
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if total else np.zeros(0, np.int64)
        mother, word = np.divmod(keys[new], self.size + 1)
        mine = self._step(side)[rows[order[new]]]
        other = runs.low[1 - side][mother] + new - begin[mother]
        size = np.diff(np.concatenate([new, [total]]))
        pair = [word[:, None], runs.words[mother]]
        made = Runs((mine, other) if left else (other, mine), size, np.concatenate(pair if left else pair[::-1], axis=1))
        return made.where(word > 0)


def packed(ids: np.ndarray) -> np.ndarray:
    """Two ids in a number; a missing second one is 0."""
    return (ids[:, 0] << 32) | (ids[:, 1] if ids.shape[1] > 1 else 0)


def _whole(blob: bytes) -> np.ndarray:
    kind = np.dtype("<u2" if blob[:1] == b"h" else "<i4")
    planes = np.frombuffer(blob, np.uint8, offset=4).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _blob(values: np.ndarray, size: int) -> bytes:
    """The values, first the lowest byte of all, then the next one: the higher bytes compress well."""
    kind = "<u2" if size < 2**16 else "<i4"
    planes = values.astype(kind).view(np.uint8).reshape(len(values), -1).T
    return (b"h\0\0\0" if size < 2**16 else b"i\0\0\0") + planes.tobytes()


def _index_shards(schema: pa.Schema, most: int):
    def run(batches):
        number = TaskContext.get().partitionId() * SHARDS_PER_TASK
        held, sizes = defaultdict(list), defaultdict(int)

        def flushed(lang):
            nonlocal number
            codes, words = coded(held.pop(lang))
            del sizes[lang]
            index = Index.of(codes, len(words))
            counts = index.counts()[1:]
            ends = pa.array([0, len(words)], pa.int32())
            made = [pa.array([v]) for v in (number, lang, int(counts.sum()))]
            made += [pa.ListArray.from_arrays(ends, v) for v in (words, pa.array(counts.astype(np.int32)))]
            made += [pa.array([_blob(side, len(words))]) for side in index.last]
            number += 1
            return pa.RecordBatch.from_arrays(made, schema=schema)

        for batch in slices(batches, most_bytes=most):
            langs = batch.column("lang").dictionary_encode()
            texts = pc.cast(pc.fill_null(batch.column("text"), ""), pa.binary())
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                mine = texts.filter(pc.equal(langs.indices, code)).to_pylist()
                held[lang] += mine
                sizes[lang] += sum(map(len, mine))
                if sizes[lang] >= most:
                    yield flushed(lang)
            while sum(sizes.values()) >= 4 * most:  # many languages in one task
                yield flushed(max(sizes, key=sizes.get))
        for lang in list(held):
            yield flushed(lang)

    return run


def _opened(batch, row):
    """The index of a shard, the codes of its allowed words, and ids by code."""
    forward, backward = (_whole(batch.column(side)[row].as_py()) for side in ("forward", "backward"))
    allowed = batch.column("allowed")[row].values
    codes = allowed.field("code").to_numpy(zero_copy_only=False).astype(np.int64)
    index = Index(forward, backward, int(max(forward.max(initial=0), codes.max(initial=0))))
    ids = np.zeros(index.size + 1, np.int64)
    ids[codes] = allowed.field("id").to_numpy(zero_copy_only=False)
    return index, np.sort(codes), ids


def _pairs(index: Index, codes: np.ndarray, ids: np.ndarray) -> Runs:
    """Pairs of allowed words."""
    found = index.extended(index.single(codes), left=False)
    return found.where(ids[found.words[:, 1]] > 0)


def _per_shard(schema: pa.Schema, counted):
    """counted(batch, row) of every row; what a shard needs is free before the next one is opened."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                yield from (pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema) for columns in counted(batch, row))
                pa.default_memory_pool().release_unused()

    return run


def _counted_pairs(batch, row):
    index, codes, ids = _opened(batch, row)
    found = _pairs(index, codes, ids)
    return [(np.full(len(found.size), batch.column("shard")[row].as_py()), packed(ids[found.words]), found.size)]


def _counted_longer(batch, row):
    index, codes, ids = _opened(batch, row)
    often = np.sort(batch.column("pairs")[row].values.to_numpy(zero_copy_only=False))

    def held(keys):
        return often[np.minimum(np.searchsorted(often, keys), len(often) - 1)] == keys

    found = _pairs(index, codes, ids)
    found = found.where(held(packed(ids[found.words])))
    made = []
    for length in range(3, DEPTH + 1):
        left = length % 2 == 1
        found = index.extended(found, left)
        own = ids[found.words]
        edge = own[:, :2] if left else own[:, -2:]
        keep = (edge > 0).all(axis=1) & held(packed(edge))
        found, own = found.where(keep), own[keep]
        made.append((packed(own[:, :2]), packed(own[:, 2:]), found.size))
    return made


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Rows of a stored table with numbers from 1, by the partitions that read it."""
    part = F.spark_partition_id()
    nth = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    sizes = {r["part"]: r["n"] for r in df.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = [], 1
    for p in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(p, 0)
    if total > IDS:
        raise ValueError(f"more than {IDS - 1} words are frequent")
    first = F.element_at(F.array(*[F.lit(b).cast("long") for b in before or [1]]), part + 1)
    return df.withColumn(name, first + nth)


def _ids(hi: str = "hi", lo: str = "lo") -> list[Column]:
    return [
        F.shiftrightunsigned(hi, 32),
        F.col(hi).bitwiseAND((1 << 32) - 1),
        F.shiftrightunsigned(lo, 32),
        F.col(lo).bitwiseAND((1 << 32) - 1),
    ]


def _key(ids: list[Column]) -> list[Column]:
    a, b, c, d = [*ids, *[F.lit(0).cast("long")] * (4 - len(ids))]
    return [F.shiftleft(a, 32).bitwiseOR(b), F.shiftleft(c, 32).bitwiseOR(d)]


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST):
    """Words and phrases of 2 to 4 words with at least so many occurrences, and words per language.

    words: lang, word, id, f. phrases: hi, lo (ids of the words, two in each; 0 for none),
    size, f. totals: lang, n.

    A task indexes the texts of a language 4 MB at a time, over ids of the words in them. What is counted
    over the shards decides what is extended: words that are frequent in the whole language
    become pairs, and frequent pairs longer phrases, so a shard never counts what cannot be
    frequent. Every occurrence of the rest is counted.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.col(text_col).alias("text"))
    with _shards(in_arrow(texts, _index_shards(_arrow(SHARD), SHARD_BYTES), SHARD)) as shards:
        totals = stored(shards.groupBy("lang").agg(F.sum("n_words").alias("n")), "totals")
        said = shards.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
        words = said.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
        words = stored(numbered(stored(words.filter(F.col("f") >= least), "words"), "id"), "word-ids")

        places = shards.select("shard", "lang", F.posexplode("words").alias("code", "word"))
        mine = places.join(words.select("lang", "word", "id"), ["lang", "word"])
        own = F.struct((F.col("code") + 1).cast("int").alias("code"), F.col("id"))
        allowed = stored(mine.groupBy("shard").agg(F.collect_list(own).alias("allowed")), "shard-words")
        index = shards.select("shard", "forward", "backward").join(allowed.hint("shuffle_hash"), "shard")
        made = "shard long, key long, f long"
        pairs = in_arrow(index, _per_shard(_arrow(made), _counted_pairs), made)
        pairs = pairs.withColumn("total", F.sum("f").over(Window.partitionBy("key"))).filter(F.col("total") >= least)
        pairs = stored(pairs.select("shard", "key", "total"), "shard-pairs")

        often = pairs.groupBy("shard").agg(F.collect_list("key").alias("pairs"))
        made = "hi long, lo long, f long"
        longer = index.join(often.hint("shuffle_hash"), "shard")
        longer = in_arrow(longer, _per_shard(_arrow(made), _counted_longer), made)
        longer = longer.groupBy("hi", "lo").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
        size = F.when(F.col("lo").bitwiseAND((1 << 32) - 1) > 0, 4).otherwise(3)
        two = pairs.groupBy(F.col("key").alias("hi")).agg(F.max("total").alias("f"))
        phrases = two.select("hi", F.lit(0).cast("long").alias("lo"), F.lit(2).alias("size"), "f").unionByName(
            longer.select("hi", "lo", size.alias("size"), "f")
        )
        return words, stored(phrases, "phrases"), totals


@contextmanager
def _shards(made: DataFrame):
    """The indexes, stored in buckets by shard, so that joins with them move the other side alone.

    The table's name lasts as long as it is used; its files lie in the scratch folder.
    """
    spark = made.sparkSession
    path = scratch_path(spark, "fm-index")
    name = "fm_index_" + path.rsplit("-", 1)[1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_freed(spark):
        # the indexes are most of what the query keeps on disk
        made.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, "shard").saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _arrow(kinds: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(kinds))


def _exact(value) -> Column:
    return F.col(value).cast("decimal(20,0)")


def scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """hi, lo, size, a, l, r, score of every phrase by its lowest-scoring cut, ties to the first."""
    w = _ids()
    parts = phrases.select("hi", "lo", "f").unionByName(
        words.select(F.shiftleft("id", 32).alias("hi"), F.lit(0).cast("long").alias("lo"), "f")
    )
    cuts = []
    for size in range(2, DEPTH + 1):
        for k in range(1, size):
            one, two = _key(w[:k]), _key(w[k:size])
            names = ("hi1", "lo1", "hi2", "lo2")
            cut = F.struct(F.lit(k).alias("k"), *[c.alias(n) for c, n in zip((*one, *two), names)])
            cuts.append(F.when(F.col("size") == size, cut))
    cut = phrases.select("hi", "lo", "size", F.col("f").alias("a"), F.explode(F.array_compact(F.array(*cuts))).alias("cut"))
    cut = cut.select("hi", "lo", "size", "a", "cut.*")
    for side, name in (("1", "l"), ("2", "r")):
        part = parts.select(F.col("hi").alias(f"hi{side}"), F.col("lo").alias(f"lo{side}"), F.col("f").alias(name))
        cut = cut.join(part, [f"hi{side}", f"lo{side}"])
    cut = cut.withColumn("both", _exact("l") + _exact("r")).withColumn("times", F.lit(2000000).cast("decimal(8,0)") * _exact("a"))
    best = F.min(F.struct(F.expr("times div both").alias("score"), "k", "l", "r")).alias("best")
    found = cut.groupBy("hi", "lo", "size", "a").agg(best)
    return found.select("hi", "lo", "size", "a", "best.l", "best.r", "best.score")


def not_inside_longer(found: DataFrame, phrases: DataFrame) -> DataFrame:
    """Without phrases that a longer frequent one holds in four of five occurrences.

    A phrase in a longer one is in a phrase one word longer, which is at least as frequent:
    left and right extensions decide.
    """
    w, longer = _ids(), phrases.filter("size > 2")
    inner = []
    for size in range(3, DEPTH + 1):
        for own in (w[: size - 1], w[1:size]):
            hi, lo = _key(own)
            inner.append(F.when(F.col("size") == size, F.struct(hi.alias("hi"), lo.alias("lo"))))
    inner = longer.select("f", F.explode(F.array_compact(F.array(*inner))).alias("inner"))
    most = inner.groupBy("inner.hi", "inner.lo").agg(F.max("f").alias("most"))
    found = found.join(most, ["hi", "lo"], "left")
    held = F.col("most").cast("decimal(20,0)") * 100 >= _exact("a") * 80
    return found.filter(~F.coalesce(held, F.lit(False))).drop("most")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z only), cut into pieces at `.,;:!?` and line ends, and those
    into words at blanks and tabs; counts are per language, a null language being `und`.
    Candidates are phrases of 2 to 4 words of a piece with a >= least occurrences. A cut after
    k words has l and r occurrences of its parts and scores floor(2000000 * a / (l + r)); the
    lowest cut counts, ties to the smallest k. Candidates that lie in a longer one with at least
    four fifths of their occurrences go. The first `top` by score, a (both descending) and phrase
    (order of its bytes) are returned. Counts are exact: ids, not hashes, stand for words.

    Null and empty texts add nothing; repeated rows count each time; further columns are
    ignored. An empty table gives an empty result. A text longer than a shard is one shard.
    """
    words, phrases, totals = frequent_phrases(docs, text_col, lang_col, least)
    found = stored(not_inside_longer(scored(words, phrases), phrases), "collocations")
    every = F.posexplode(F.filter(F.array(*_ids()), lambda i: i > 0)).alias("place", "id")
    spelt = (
        found.select("hi", "lo", every)
        .join(words.select("id", "lang", "word"), "id")
        .groupBy("hi", "lo")
        .agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("place", "word"))).alias("said"))
        .select("hi", "lo", "lang", F.array_join(F.transform("said", lambda s: s["word"]), " ").alias("phrase"))
    )
    best = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    some = found.join(spelt, ["hi", "lo"]).withColumn("nth", F.row_number().over(salted)).filter(F.col("nth") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    out = some.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).join(totals, "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
