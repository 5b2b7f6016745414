"""Language by error-correcting output codes over character n-grams."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from plotwise.llm.subwords import mean_over_subwords, plain, subwords
from plotwise.llm.words import slices, split_words

MAX_ROWS = 2400  # labelled documents that the model is fitted on, at the most
SHORTEST, LONGEST, BITS = 1, 4, 12
UNKNOWN = "und"
AMBIGUOUS = 0.15  # a smaller lead over the second language is flagged
EPOCHS, BATCH, RATE = 8, 64, 0.5
SLICE = 2 << 20  # bytes of text at once: a vector per word is held


class Model(NamedTuple):
    languages: list[str]
    codewords: np.ndarray  # (languages, bits) of -1 and 1
    weights: np.ndarray  # (buckets, bits)
    bias: np.ndarray  # (bits,)
    trust: np.ndarray  # weight of each bit in decoding


def codebook(languages: int, seed: int = 9, tries: int = 200) -> np.ndarray:
    """Codewords far apart: of random balanced books the one with the largest least distance."""
    bits = max(7, 4 * int(np.ceil(np.log2(max(languages, 2)))) + 3)
    rng = np.random.default_rng(seed)
    best, far = None, -1.0
    for _ in range(tries):
        book = np.where(rng.random((languages, bits)).argsort(0) < (languages + 1) // 2, 1, -1)
        apart = (book[:, None, :] != book[None, :, :]).sum(2) + bits * np.eye(languages, dtype=int)
        score = apart.min() + apart.mean() / (10 * bits)
        if score > far:
            best, far = book, score
    return best.astype(float)


def _profiles(texts) -> np.ndarray:
    """Each text's mean over its words of the share of each n-gram bucket."""
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    words = split_words(pa.array(texts, pa.string()))
    vocabulary = plain(words.vocabulary)
    parts = list(subwords(vocabulary, SHORTEST, LONGEST, BITS))
    if not parts:
        return out
    of, bucket = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(of, kind="stable")
    bucket, sizes = bucket[order], np.bincount(of, minlength=len(vocabulary))
    first = np.cumsum(sizes) - sizes
    for i, (a, b) in enumerate(zip(words.starts[:-1], words.starts[1:])):
        codes = words.codes[a:b]
        n = sizes[codes]
        ids = bucket[np.repeat(first[codes] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        share = np.repeat(1.0 / np.maximum(n, 1), n)
        out[i] = np.bincount(ids, weights=share, minlength=1 << BITS) / max(b - a, 1)
    return out


def fit(texts: list, languages: list, seed: int = 5) -> Model | None:
    """A logistic classifier per bit of the codewords; None without rows.

    Bits are trusted by how well they separate the sample's last fifth, on which a first
    fit was not trained.
    """
    names = sorted(set(languages))
    if not names:
        return None
    book = codebook(len(names))
    target = book[[names.index(x) for x in languages]]
    x = _profiles([t or "" for t in texts]) * 100
    rng = np.random.default_rng(seed)

    def train(rows):
        w, b = np.zeros((x.shape[1], book.shape[1])), np.zeros(book.shape[1])
        past_w, past_b = np.full(w.shape, 1e-4), np.full(b.shape, 1e-4)
        for _ in range(EPOCHS):
            for batch in np.array_split(rng.permutation(rows), max(1, len(rows) // BATCH)):
                margin = target[batch] * (x[batch] @ w + b)
                slope = -target[batch] / (1 + np.exp(np.clip(margin, -50, 50))) / len(batch)
                down = x[batch].T @ slope
                past_w += down**2
                past_b += slope.sum(0) ** 2
                w -= RATE * 0.1 * down / np.sqrt(past_w)
                b -= RATE * 0.1 * slope.sum(0) / np.sqrt(past_b)
        return w, b

    rows = np.arange(len(languages))
    kept, tried = rows[rows % 5 != 4], rows[rows % 5 == 4]
    trust = np.ones(book.shape[1])
    if len(tried) and len(kept):
        w, b = train(kept)
        right = ((x[tried] @ w + b) * target[tried] > 0).mean(0)
        right = np.clip((right * len(tried) + 1) / (len(tried) + 2), 0.51, 0.999)
        trust = np.log(right / (1 - right))
    w, b = train(rows)
    return Model(names, book, w * 100, b, trust / trust.sum())


def decode(margins: np.ndarray, model: Model) -> np.ndarray:
    """Share of each language: loss-weighted distance to the codewords, as a softmax."""
    loss = np.logaddexp(0, -margins[:, None, :] * model.codewords[None]) @ model.trust
    odds = np.exp(-(loss - loss.min(1, keepdims=True)) * model.codewords.shape[1])
    return odds / odds.sum(1, keepdims=True)


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"


def _predicted(model: Model | None):
    def read(batches):
        for part in slices(batches, most_bytes=SLICE):
            words = split_words(part.column("text"))
            n, counts = part.num_rows, np.diff(words.starts)
            spoken = np.zeros(n, bool)
            names, score, lead = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n)
            if words.starts[-1] and model is not None:
                lettered = pc.match_substring_regex(words.vocabulary, r"\p{L}").to_numpy(zero_copy_only=False)
                some = counts > 0
                firsts = words.starts[:-1][some]
                spoken[some] = np.logical_or.reduceat(lettered[words.codes], firsts)
                each = mean_over_subwords(plain(words.vocabulary), model.weights, SHORTEST, LONGEST, BITS)
                margins = np.zeros((n, each.shape[1]))
                margins[some] = np.add.reduceat(each[words.codes], firsts, axis=0) / counts[some][:, None]
                shares = decode(margins + model.bias, model)
                ranked = np.sort(shares, axis=1)
                best = np.array(model.languages, object)[shares.argmax(1)]
                names[spoken], score[spoken] = best[spoken], ranked[spoken, -1]
                lead = ranked[:, -1] - (ranked[:, -2] if shares.shape[1] > 1 else 0)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array(names.tolist(), pa.string()),
                    pa.array(score),
                    pa.array(~spoken | (lead < AMBIGUOUS)),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    return read


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_rows: int) -> list:
    """(text, language) of at most `max_rows` documents, as evenly over languages as they come.

    Drawn by hash of the id from documents with a language whose crc32(id as text) does not
    leave 2 when divided by 4. Ranks are taken in 64 salted parts of a language first, then
    among those parts' first rows, so no task ranks a whole language.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).filter(
        "id is not null and lang is not null and pmod(crc32(cast(id as string)), 4) <> 2"
    )
    known = known.withColumn("draw", F.xxhash64("id"))
    languages = max(1, known.select("lang").distinct().count())
    each = max(1, max_rows // languages)
    parts = Window.partitionBy("lang", F.pmod("draw", F.lit(64))).orderBy("draw", "id")
    whole = Window.partitionBy("lang").orderBy("draw", "id")
    drawn = (
        known.withColumn("place", F.row_number().over(parts))
        .filter(F.col("place") <= each)
        .withColumn("place", F.row_number().over(whole))
        .filter(F.col("place") <= each)
        .orderBy("place", "draw", "id")
        .limit(max_rows)
        .select("id", "lang")
        .distinct()
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = texts.join(F.broadcast(drawn), ["id", "lang"]).select("id", "text", "lang").toArrow()
    rows = rows.sort_by([("id", "ascending"), ("text", "ascending")])
    return list(zip(rows.column("text").to_pylist(), rows.column("lang").to_pylist()))


def identify_language(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, ambiguous.

    Each learned language has a codeword; a binary classifier over hashed 1- to 4-grams of
    words predicts each bit, and the codeword with the smallest weighted logistic loss wins.
    The score is its share in a softmax over the losses. Learned on a bounded sample of
    documents that are not held out, applied to every whole text.

    Null texts and texts without a letter are `und` with score 0 and ambiguous, as is every
    text if there is nothing to learn from. Null ids are never held out; rows that repeat an
    id are judged each. Other columns are ignored. An empty table gives an empty result.
    """
    rows = training_rows(docs, id_col, text_col, lang_col, max_rows)
    model = fit([t for t, _ in rows], [y for _, y in rows])
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    ).mapInArrow(_predicted(model), PREDICTED)
