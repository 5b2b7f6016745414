"""Toxicity by subword-bag embeddings averaged into a linear softmax."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plotwise.llm.spark import in_arrow
from plotwise.llm.subwords import mean_over_subwords, plain, subwords
from plotwise.llm.words import slices, split_words

MAX_ROWS = 6000  # labelled documents that the model is fitted on, at the most
THRESHOLD = 0.3
PASSAGE = 10  # words whose embeddings are averaged
SHORTEST, LONGEST, BITS, SIZE = 3, 6, 17, 8
EPOCHS, BATCH, RATE, START = 8, 32, 0.1, 0.5


class Model(NamedTuple):
    embeddings: np.ndarray  # (buckets, size)
    readout: np.ndarray  # (size, 2)
    bias: np.ndarray  # (2,)

    def folded(self) -> tuple[np.ndarray, float]:
        """One number per bucket and an offset: averaging and the softmax's logit are linear."""
        return self.embeddings @ (self.readout[:, 1] - self.readout[:, 0]), float(self.bias[1] - self.bias[0])


def _top_passages(scores: np.ndarray, starts: np.ndarray, passage: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and mean of each document's passage of the highest mean; -inf without words."""
    n = len(starts) - 1
    best, at, long = np.full(n, -np.inf), starts[:-1].copy(), np.zeros(n, np.int64)
    counts = np.diff(starts)
    long[:] = np.minimum(counts, passage)
    total = np.concatenate([[0.0], np.cumsum(scores)])
    whole = counts >= passage
    if whole.any():
        sums = total[passage:] - total[:-passage]
        rows = np.flatnonzero(whole)
        edges = np.stack([starts[rows], starts[rows + 1] - passage + 1], 1).ravel()
        padded = np.concatenate([sums, [-np.inf]])  # so that the last edge is a place
        best[rows] = np.maximum.reduceat(padded, edges)[::2] / passage
        for i in rows:
            a, b = starts[i], starts[i + 1] - passage + 1
            at[i] = a + int(np.argmax(sums[a:b]))
    short = (counts > 0) & ~whole
    best[short] = (total[starts[1:]] - total[starts[:-1]])[short] / counts[short]
    return at, long, best


def _by_word(vocabulary: pa.Array, step: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, word after word, and how many each word has; a few words at a time."""
    buckets, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for start in range(0, len(vocabulary), step):
        part = vocabulary.slice(start, step)
        of, bucket = (np.concatenate(x) for x in zip(*subwords(part, SHORTEST, LONGEST, BITS)))
        buckets.append(bucket[np.argsort(of, kind="stable")].astype(np.int32))
        sizes.append(np.bincount(of, minlength=len(part)))
    return np.concatenate(buckets), np.concatenate(sizes)


def _excess(words, bucket, first, per_word, labels) -> np.ndarray:
    """z-score of each n-gram's share of positive against that of other documents."""
    hits = np.zeros((2, 1 << BITS))
    for i, (a, b) in enumerate(zip(words.starts[:-1], words.starts[1:])):
        codes = np.unique(words.codes[a:b])
        sizes = per_word[codes]
        ids = bucket[np.repeat(first[codes] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        hits[labels[i]][np.unique(ids)] += 1
    n = np.array([(labels == y).sum() for y in (0, 1)])
    share, overall = hits / n[:, None], hits.sum(0) / n.sum()
    return (share[1] - share[0]) / np.sqrt((overall * (1 - overall) + 1 / n.sum()) * (1 / n).sum())


def fit(texts: list | pa.Array, labels: list, epochs: int = EPOCHS, seed: int = 3) -> Model | None:
    """Embeddings and softmax trained jointly; None unless both labels occur.

    A document is judged by its highest passage, and that passage is what it teaches: a
    positive document pulls it up, a negative one pushes it down. So a few bad words in a
    long text count, and what occurs in clean texts as well does not. Vectors start along
    the readout by how much more often an n-gram's documents are positive than chance
    allows (a z-score). AdaGrad, in batches; the rarer label weighs more.
    """
    labels = np.asarray(labels, np.int64)
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    words = split_words(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
    vocabulary = plain(words.vocabulary)
    bucket, per_word = _by_word(vocabulary)
    first = np.concatenate([[0], np.cumsum(per_word)])
    filled = np.flatnonzero(per_word)
    embeddings = rng.normal(0, 0.01, (1 << BITS, SIZE))
    readout, bias = rng.normal(0, 0.1, (SIZE, 2)), np.array([0.0, -1.0])
    readout[0] = (-0.5, 0.5)
    embeddings[:, 0] += START * _excess(words, bucket, first, per_word, labels)
    past = [np.full(x.shape, 1e-6) for x in (embeddings, readout, bias)]
    weight = np.where(labels == 1, np.sqrt((labels == 0).sum() / (labels == 1).sum()), 1.0)
    usable = np.flatnonzero(np.diff(words.starts) > 0)
    for _ in range(epochs):
        rounds = np.array_split(rng.permutation(usable), 4)
        for chosen in rounds:
            folded = Model(embeddings, readout, bias).folded()[0].astype(np.float32)
            score = np.zeros(len(vocabulary))
            score[filled] = np.add.reduceat(folded[bucket], first[filled]) / per_word[filled]
            at, long, _ = _top_passages(score[words.codes], words.starts, PASSAGE)
            for batch in np.array_split(chosen, max(1, len(chosen) // BATCH)):
                if not len(batch):
                    continue
                # every passage's words, every word's n-grams
                row = np.repeat(np.arange(len(batch)), long[batch])
                place = np.concatenate([np.arange(a, a + n) for a, n in zip(at[batch], long[batch])])
                code = words.codes[place]
                grams = np.repeat(first[code] - np.concatenate([[0], np.cumsum(per_word[code])[:-1]]), per_word[code])
                ids = bucket[grams + np.arange(len(grams))]
                owner = np.repeat(row, per_word[code])
                share = np.repeat(1.0 / (np.maximum(per_word[code], 1) * long[batch][row]), per_word[code])
                mean = np.zeros((len(batch), SIZE))
                np.add.at(mean, owner, embeddings[ids] * share[:, None])
                logits = mean @ readout + bias
                odds = np.exp(logits - logits.max(1, keepdims=True))
                error = odds / odds.sum(1, keepdims=True)
                error[np.arange(len(batch)), labels[batch]] -= 1
                error *= weight[batch][:, None]
                slopes = (error @ readout.T, mean.T @ error, error.sum(0))
                distinct, back = np.unique(ids, return_inverse=True)
                down = np.zeros((len(distinct), SIZE))
                np.add.at(down, back, slopes[0][owner] * share[:, None])
                past[0][distinct] += down**2
                embeddings[distinct] -= RATE * down / np.sqrt(past[0][distinct])
                for value, slope, sums in ((readout, slopes[1], past[1]), (bias, slopes[2], past[2])):
                    sums += slope**2
                    value -= RATE / 4 * slope / np.sqrt(sums)
    return Model(embeddings, readout, bias)


def _scores(texts: pa.Array, folded: np.ndarray, offset: float) -> np.ndarray:
    words = split_words(texts)
    best = np.full(len(texts), -np.inf)
    if words.starts[-1]:
        each = mean_over_subwords(plain(words.vocabulary), folded, SHORTEST, LONGEST, BITS)
        best = _top_passages(each[words.codes], words.starts, PASSAGE)[2]
    score = 1 / (1 + np.exp(-np.clip(best + offset, -60, 60)))
    return np.where(np.isneginf(best), 0.0, score)


def _scored(folded: np.ndarray, offset: float, threshold: float):
    def read(batches):
        for part in slices(batches):
            score = _scores(part.column("text"), folded, offset)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return read


def _clean(folded: np.ndarray, offset: float, threshold: float, text_col: str):
    def read(batches):
        for part in slices(batches, text_col):
            score = _scores(part.column(text_col), folded, offset)
            yield part.filter(pa.array(score < threshold))

    return read


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    """id, text, label of at most `max_rows` labelled documents, drawn by hash of the id.

    Documents whose crc32(id as text) leaves 2 when divided by 4 are held out. Ids are
    drawn first, so only that many texts travel.
    """
    labelled = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
        .filter("id is not null and label is not null and pmod(crc32(cast(id as string)), 4) <> 2")
        .groupBy("id")
        .agg(F.max("label").cast("int").alias("label"))
    )
    known = docs.select(F.col(id_col).alias("id")).distinct()
    drawn = labelled.join(known, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(drawn), "id").select("id", "text", "label")


def _fitted(batches):
    rows = pa.Table.from_batches(list(batches))
    if not rows.num_rows:
        return
    rows = rows.sort_by([("id", "ascending"), ("text", "ascending")])
    labels = rows.column("label").to_pylist()
    texts = pc.fill_null(rows.column("text").combine_chunks(), "")
    del rows, batches
    model = fit(texts, labels)
    parts = [x.tobytes() for x in model] if model else [None] * 3
    yield pa.RecordBatch.from_arrays(
        [pa.array([sum(labels) / len(labels)]), *[pa.array([x], pa.binary()) for x in parts]],
        ["share", *Model._fields],
    )


def trained(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> tuple[Model | None, float]:
    """The model and the share of positive labels; fitted by one task on the bounded sample."""
    rows = training_rows(docs, labels, id_col, text_col, label_col, max_rows).repartition(1)
    made = in_arrow(rows, _fitted, "share double, embeddings binary, readout binary, bias binary").collect()
    if not made or made[0]["bias"] is None:
        return None, made[0]["share"] if made else 0.0
    shapes = {"embeddings": (1 << BITS, SIZE), "readout": (SIZE, 2), "bias": (2,)}
    return Model(*[np.frombuffer(made[0][n]).reshape(shape) for n, shape in shapes.items()]), made[0]["share"]


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = THRESHOLD,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    The model is fitted on a bounded sample (`max_rows`) of labelled documents that are not
    held out, and scores every whole text: a word is the mean of the vectors of its
    character n-grams, a passage of ten words the mean of its words, a linear softmax gives
    a passage's score, and a document has the score of its highest passage. Unseen
    misspellings share n-grams with what was seen. One task fits the model; 2^17 numbers go
    to all tasks, whatever the corpus.

    Texts that are null or without words score 0. Null ids are never held out. With fewer
    than two labels to learn from, every score is the share of positive labels. Rows that
    repeat an id are scored each. Other columns are ignored.
    """
    model, share = trained(docs, labels, id_col, text_col, label_col, max_rows)
    parts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    if model is None:
        score = F.lit(float(share))
        return parts.select("doc_id", "held_out", score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
    folded, offset = model.folded()
    scored = _scored(folded.astype(np.float32), offset, threshold)
    return in_arrow(parts, scored, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = THRESHOLD,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """The documents that score below the threshold, all their columns unchanged, none shuffled."""
    model, _ = trained(docs, labels, id_col, text_col, label_col, max_rows)
    if model is None:
        return docs
    folded, offset = model.folded()
    return in_arrow(docs, _clean(folded.astype(np.float32), offset, threshold, text_col), docs.schema)
