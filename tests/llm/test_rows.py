"""Stages decide per row: identical rows, null ids, and one id with two texts."""

from collections import Counter

import numpy as np
import pytest

from plotwise.llm.exact import drop_exact_copies
from plotwise.llm.minhash import bands, densified, drop_near_copies, near_duplicates, registers
from plotwise.llm.mixing import mix_sources, mixed_documents

KINDS = "doc_id long, text string, source string, _digest string, _kept_id int, _rows int, _drawn_id int, _copies int, _copy int, _size int"
LONG = " ".join(f"w{i}" for i in range(60))


def docs(spark, rows, parts=3):
    made = [(i, t, s, "clash", 1, 1, 1, 1, 1, 1) for i, t, s in rows]
    return spark.createDataFrame(made, KINDS).repartition(parts)


ROWS = [
    (5, "same text", "a"), (5, "same text", "a"), (9, "Same Text", "b"), (5, "other words", "a"), (9, "other words", "a"),
    (None, "lone", "a"), (None, "LONE", "a"), (None, None, "a"), (3, "", None), (7, LONG, "b"), (7, LONG + " more", "b"),
    (2, LONG.upper(), "a"), (8, "unlike anything else here", "a"), (8, "unlike anything else here", "a"),
]


@pytest.mark.parametrize("parts", [1, 4])
def test_no_exact_copy_is_left(spark, parts):
    out = drop_exact_copies(docs(spark, ROWS, parts))
    assert out.columns == docs(spark, []).columns
    got = Counter((r.doc_id, (r.text or "").lower()) for r in out.collect())
    want = {}
    for i, t, _ in ROWS:
        t = (t or "").lower()
        want[t] = max((x for x in (want.get(t), i) if x is not None), default=None)
    assert got == Counter({(i, t): 1 for t, i in want.items()})


def test_near_copies_do_not_depend_on_the_partitioning(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, a, "s"), (4, b, "s"), (4, a + " x", "s"), (6, b + " y", "s"), (6, "short", "s"), (9, "short", "s"), (None, a, "s"), (3, "", "s")]
    results = []
    for parts in (1, 4):
        found = near_duplicates(docs(spark, rows, parts))
        results.append(Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()))
        kept = Counter(r.doc_id for r in drop_near_copies(docs(spark, rows, parts)).collect())
        assert kept == Counter({1: 1, 3: 1, None: 1})
    # id 4 is near 1 by one text and near 6 by the other, 6 near 9 by its other text
    assert results[0] == results[1] and {r[0]: r[2] for r in results[0]} == {1: 1, 4: 1, 6: 1, 9: 1, 3: 3, None: None}


@pytest.mark.parametrize("parts", [1, 4])
def test_the_mix_takes_what_it_says(spark, parts):
    rows = ROWS * 3 + [(100 + i, "some words " * (i % 9), "ab"[i % 2]) for i in range(60)]
    df = docs(spark, rows, parts)
    out = mixed_documents(df)
    assert out.columns == df.columns
    want = Counter()
    for r in mix_sources(df).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    got = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in out.collect())
    assert got == +want


def test_empty_tables(spark):
    for stage in (drop_exact_copies, drop_near_copies, mixed_documents):
        assert stage(docs(spark, [])).collect() == []


def test_bands_of_short_texts_say_several_things():
    """Two sets that share one shingle of eight share few bands; without filling up they shared many."""
    rng = np.random.default_rng(1)
    shared = []
    for _ in range(200):
        values = np.unique(rng.integers(0, 2**63, 15, dtype=np.uint64))
        one, two = np.sort(values[:8]), np.sort(values[7:])
        assert (densified(registers(one)) > 0).all()
        shared.append(len(set(bands(registers(one)).tolist()) & set(bands(registers(two)).tolist())))
    assert np.mean(np.array(shared) > 0) < 0.01


def test_close_sets_share_a_band():
    """At 0.8 no pair of any size is missed."""
    rng = np.random.default_rng(2)
    for size in (4, 9, 20, 90, 400, 3000):
        for _ in range(120):
            values = rng.integers(0, 2**63, size + size // 4, dtype=np.uint64)
            one, two = np.unique(values[:size]), np.unique(np.concatenate([values[: size - size // 10], values[size : size + size // 10]]))
            if 100 * len(np.intersect1d(one, two)) >= 80 * len(np.union1d(one, two)):
                assert set(bands(registers(one)).tolist()) & set(bands(registers(two)).tolist())
