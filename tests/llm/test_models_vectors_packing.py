"""Trained operators by held-out accuracy, vectors and packing by brute force."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotwise.llm import embeddings
from plotwise.llm.embeddings import audit, links_between, near_vectors
from plotwise.llm.langid import codebook, identify_language
from plotwise.llm.packing import best_fit, least_bins, local_search, pack_documents, vocabulary_path
from plotwise.llm.toxicity import drop_toxic, score_toxicity

SOUNDS = {
    "aa": "ba da ga ma na sa ta la ra pa",
    "bb": "tsch pfu kei heit ung lich ver ent zu stra",
    "cc": "eux oi eau que ment tion aire ette ou ive",
}


def word(rnd, lang):
    return "".join(rnd.choice(SOUNDS[lang].split()) for _ in range(rnd.randint(1, 4)))


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        lang = rnd.choice(list(SOUNDS))
        words = [word(rnd, lang) for _ in range(rnd.randint(30, 300))]
        toxic = int(rnd.random() < 0.2)
        for _ in range(3 * toxic):
            words.insert(rnd.randrange(len(words)), "zwo" + rnd.choice("abcd") + "xfiend" + rnd.choice(["", "s", "ly"]))
        rows.append((i, " ".join(words), lang, "src"))
        labels.append((i, toxic))
    rows += [(2000, None, "aa", None), (2001, "", None, None), (2002, "123 456 !", "bb", "s"), (None, "ba da", None, "s"), (0, "ba ga na", "aa", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({n: F.lit("clash") for n in ("label", "id", "score", "held_out", "predicted", "word")})
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    return docs.cache(), marks.cache(), {i: (t, lang) for i, t, lang, _ in rows}, dict(labels)


def test_toxicity(corpus):
    docs, marks, _, labels = corpus
    got = score_toxicity(docs, marks).collect()
    assert len(got) == docs.count()
    out = [r for r in got if r.doc_id in labels and held_out(r.doc_id)]
    assert all(r.held_out == held_out(r.doc_id) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    hits = [r.predicted for r in out if labels[r.doc_id]]
    false = [r.predicted for r in out if not labels[r.doc_id]]
    assert sum(hits) >= 0.85 * len(hits) and sum(false) <= 0.08 * len(false)
    assert {r.score for r in got if r.doc_id in (2000, 2001)} == {0.0}


def test_drop_toxic(corpus):
    docs, marks, _, _ = corpus
    kept = drop_toxic(docs, marks)
    scores = score_toxicity(docs, marks)
    assert kept.columns == docs.columns
    assert kept.count() == scores.filter("predicted = 0").count()


def test_toxicity_with_nothing_to_learn(spark, corpus):
    docs, marks, _, _ = corpus
    got = score_toxicity(docs, marks.filter("toxic = 0")).collect()
    assert {r.score for r in got} == {0.0} and len(got) == docs.count()
    assert drop_toxic(docs, marks.limit(0)).count() == docs.count()
    assert score_toxicity(docs.limit(0), marks).collect() == []


def test_language(corpus):
    docs, _, known, _ = corpus
    got = identify_language(docs).collect()
    assert len(got) == docs.count()
    out = [r for r in got if r.doc_id is not None and r.doc_id < 1000 and held_out(r.doc_id) and r.doc_id]
    assert np.mean([r.lang_pred == known[r.doc_id][1] for r in out]) > 0.98
    unknown = [r for r in got if r.doc_id in (2000, 2001, 2002)]
    assert {(r.lang_pred, r.score, r.ambiguous) for r in unknown} == {("und", 0.0, True)}
    assert all(0 <= r.score <= 1 for r in got)


def test_language_with_nothing_to_learn(corpus):
    docs = corpus[0]
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in identify_language(none).collect()} == {"und"}
    assert identify_language(docs.limit(0)).collect() == []


def test_codewords_are_far_apart():
    for n in (2, 4, 11):
        book = codebook(n)
        apart = (book[:, None] != book[None]).sum(2) + 99 * np.eye(n)
        assert apart.min() >= 3


def plain_vectors(rows, threshold=0.93):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    own = {}
    for i, v, label in rows:
        usable = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if usable and i is not None:
            own[i] = (label, np.array(v, float))
    links = {i: set() for i in ids}
    for a in own:
        for b in own:
            if a != b and own[a][0] == own[b][0] and len(own[a][1]) == len(own[b][1]):
                x, y = own[a][1], own[b][1]
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a].add(b)
    part = {}
    for i in ids:
        if i not in part:
            reached, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()] - reached:
                    reached.add(j)
                    todo.append(j)
            part.update({j: i for j in reached})
    return {i: (len(links[i]), part[i], part[i] == i) for i in ids}


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for label in range(3):
        for size in [1] * 80 + [2] * 15 + [5] * 4 + [90]:
            centre = rng.normal(size=16)
            for _ in range(size):
                v = centre + rng.normal(size=16) * 0.12 * np.linalg.norm(centre) / 4
                rows.append((n, v.astype(np.float32).tolist(), label))
                n += 1
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [1.0, None], 1), (n + 3, [float("nan")] * 16, 2), (n + 4, [], 0)]
    rows += [(n + 5, rows[0][1], None), (n + 6, [float("inf")] * 16, 1), (n + 7, [1.0, 2.0], 1), (n + 8, [2.0, 4.0], 1)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    docs = docs.withColumns({c: F.lit("clash") for c in ("id", "v", "cell", "a", "b", "component")})
    want = plain_vectors([(i, v, y) for i, v, y in rows])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(docs).collect()}
    assert set(got) == set(want)
    missed = sum(got[i] != want[i] for i in want)
    assert missed <= 0.01 * len(want)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert all(got[i] == (0, i, True) for i in range(n, n + 7)) and got[n + 7] == (1, n + 7, True)


def test_near_vectors_empty_and_repeated(spark):
    kinds = "vec_id long, embedding array<float>, label int"
    assert near_vectors(spark.createDataFrame([], kinds)).collect() == []
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    got = sorted(str(tuple(r)) for r in near_vectors(spark.createDataFrame(rows, kinds)).collect())
    assert got == ["(1, 1, 1, True)", "(1, 1, 1, True)", "(2, 1, 1, False)", "(None, 0, None, True)"]


def clumps(rng, sizes, apart=0.95, width=32):
    """Clumps of nearly equal vectors, or of equal ones (negative size), whose centres have a cosine of `apart`."""
    first = rng.normal(size=width)
    first /= np.linalg.norm(first)
    out = []
    for turn, size in enumerate(sizes):
        side = rng.normal(size=width)
        side -= (side @ first) * first
        side /= np.linalg.norm(side)
        centre = first if not turn else apart * first + math.sqrt(1 - apart * apart) * side
        for _ in range(abs(size)):
            out.append((centre + (rng.normal(size=width) * 0.0005 if size > 0 else 0)).tolist())
    return out


@pytest.mark.parametrize("sizes", [(-20, -20), (40, 40), (60, -30, 25)])
def test_near_vectors_full_lists(spark, sizes):
    """Clumps that fill each other's lists are linked nevertheless, also beside a group of copies with most links."""
    rng = np.random.default_rng(8)
    rows = [(i, v, 1) for i, v in enumerate(clumps(rng, sizes))]
    rows += [(1000 + i, rng.normal(size=32).tolist(), 1) for i in range(200)]
    rows += [(2000 + i, [1.0, 2.0] * 16, 1) for i in range(300)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(docs).collect()}
    assert got == plain_vectors(rows)


def test_audit_of_small_groups(spark):
    """Missed links of small groups show beside a large one that is found whole."""
    rng = np.random.default_rng(9)
    rows = [(i, "32:1", v) for i, v in enumerate(clumps(rng, (120,)))]
    for g in range(40):
        rows += [(1000 + 2 * g + i, "32:1", v) for i, v in enumerate(clumps(rng, (2,)))]
    unit = [(i, c, (np.array(v) / np.linalg.norm(v)).tolist()) for i, c, v in rows]
    vectors = spark.createDataFrame(unit, "id long, cell string, v array<double>")
    found = spark.createDataFrame([(i, 0) for i in range(120)], "node long, component long")
    assert audit(found, vectors, 0.93) < 0.1
    whole = found.union(spark.createDataFrame([(i, i - i % 2) for i in range(1000, 1080)], "node long, component long"))
    assert audit(whole, vectors, 0.93) == 1.0


def test_audit_without_links_knows_nothing(spark, monkeypatch):
    """Few links among many vectors: queries are drawn until some are seen, and none seen is no pass."""
    rng = np.random.default_rng(10)
    rows = [(i, "32:1", v / np.linalg.norm(v)) for i, v in enumerate(rng.normal(size=(900, 32)))]
    for g in range(5):
        rows += [(2000 + 2 * g + i, "32:1", np.array(v) / np.linalg.norm(v)) for i, v in enumerate(clumps(rng, (2,)))]
    vectors = spark.createDataFrame([(i, c, v.tolist()) for i, c, v in rows], "id long, cell string, v array<double>")
    nothing = spark.createDataFrame([], "node long, component long")
    assert audit(nothing, vectors, 0.93, queries=20) == 0.0
    alone = vectors.filter("id < 2000")
    assert audit(nothing, alone, 0.93, queries=20) == 1.0  # all were asked
    monkeypatch.setattr(embeddings, "MOST_QUERIES", 50)
    assert audit(nothing, alone, 0.93, queries=20) is None


def test_links_between(spark):
    """All components that have a link between them are joined, by whatever shape they have."""
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(30, 8))
    rows = [(i, "8:1", centres[i % 30] + rng.normal(size=8) * 0.3) for i in range(900)]
    rows = [(i, c, (v / np.linalg.norm(v)).tolist()) for i, c, v in rows]
    m = np.array([v for _, _, v in rows])
    nodes = spark.createDataFrame(rows, "id long, cell string, v array<double>")
    found = spark.createDataFrame([(i, i % 45) for i in range(900)], "node long, component long")
    want = {tuple(sorted((int(i) % 45, int(j) % 45))) for i, j in zip(*np.nonzero(m @ m.T >= 0.93)) if i % 45 != j % 45}
    got = {tuple(sorted((r.a % 45, r.b % 45))) for r in links_between(nodes, found, 0.93).collect()}
    assert got == want


def test_packing(spark):
    from tokenizers import Tokenizer

    rnd = random.Random(7)
    tokenizer = Tokenizer.from_file(vocabulary_path())
    rows = [(i, " ".join(rnd.choice(["Straße.", "the", "été,", "x9-", "don't", "a b", "3.5", "你好"]) for _ in range(rnd.randint(0, 900)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "word " * 9000), (5, "again"), (5, "again"), (None, "no id <|endoftext|> x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("clash") for c in ("row", "block", "length", "bins", "loose")})
    got = pack_documents(docs, with_ids=True).collect()
    want = {}
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at : at + 4096]
            want.setdefault((i, piece), []).append((at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), own))
    found = {}
    for r in got:
        found.setdefault((r.doc_id, r.piece), []).append((r.start, r.length, r.ids_crc32, list(r.ids)))
    assert found == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= math.ceil(sum(r.length for r in got) / 4096) + 1


def test_packing_empty(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("low,high", [(1, 4095), (1200, 1500), (800, 2600), (2100, 4000)])
def test_local_search(low, high):
    lengths = np.random.default_rng(low).integers(low, high, 700)
    start = best_fit(lengths, 4096)
    bins = local_search(lengths, start, 4096)
    fill = np.bincount(bins, weights=lengths)
    assert fill.max() <= 4096 and fill.sum() == lengths.sum()
    assert least_bins(lengths, 4096) <= (fill > 0).sum() <= len(set(start))
