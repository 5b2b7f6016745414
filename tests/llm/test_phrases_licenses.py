"""Phrases and license scans against plain versions, on small tables with every awkward row."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from plotwise.llm import licenses, phrases


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower(text))]


def plain_phrases(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase of every text."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        for words in plain_pieces(text):
            n[lang or "und"] += len(words)
            for k in (1, 2, 3, 4):
                f.update((lang or "und", *words[i : i + k]) for i in range(len(words) - k + 1))
    frequent = {g: c for g, c in f.items() if c >= least}
    out = {}
    for (lang, *g), a in frequent.items():
        if len(g) < 2:
            continue
        cuts = [(2000000 * a // (f[lang, *g[:k]] + f[lang, *g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        inside = any(
            len(h) - 1 > len(g) and h[0] == lang and any(list(h[1 + i : 1 + i + len(g)]) == g for i in range(len(h) - len(g)))
            and 100 * c >= 80 * a
            for h, c in frequent.items()
        )
        if not inside:
            out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, *g[:k]], f[lang, *g[k:]]))
    return {
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)
    }


def spoken(draw, n):
    """Texts of few words, so that phrases repeat; breaks, blanks and capitals among them."""
    words = ["a", "B", "c", "the", "The", "é", "x\x01", "d-e", "\xa0"]
    parts = [draw.choice(words) for _ in range(n)]
    return "".join(w + draw.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "]) for w in parts)


def test_collocations(spark):
    draw = random.Random(3)
    rows = [(draw.choice(["en", "en", "en", "de", None]), spoken(draw, draw.randint(0, 60))) for _ in range(120)]
    rows += [("en", None), ("fr", ""), ("fr", "one two"), ("en", " \n.;"), ("en", "the same line of words. " * 400)]
    rows += [("long", "w" * 100_000 + " a b " * 40)] + [("de", rows[0][1])] * 3
    kinds = "lang string, text string, word string, id int, f int, n int, shard int"
    docs = spark.createDataFrame([(*r, "clash", 1, 1, 1, 1) for r in rows], kinds).repartition(7)
    for least, top in ((8, 2000), (30, 5)):
        got = {tuple(r) for r in phrases.collocations(docs, least=least, top=top).collect()}
        assert got == plain_phrases(rows, least, top)
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_many_small_shards_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_BYTES", 100)
    draw = random.Random(4)
    rows = [(draw.choice(["en", "de"]), spoken(draw, 50)) for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = {tuple(r) for r in phrases.collocations(docs, least=10).collect()}
    assert got == plain_phrases(rows, 10, 2000)


@pytest.mark.parametrize("seed", range(6))
def test_index_extends_to_both_sides(seed):
    draw = random.Random(seed)
    codes = np.array([0] + [draw.randint(0, 5) for _ in range(draw.choice([0, 1, 7, 400]))] + [0])
    index = phrases.Index.of(codes, 5)
    want = {k: Counter(tuple(codes[i : i + k]) for i in range(len(codes) - k + 1) if codes[i : i + k].all()) for k in (1, 2, 3, 4)}
    runs = index.single(np.flatnonzero(index.counts()[1:]) + 1)
    for length in (1, 2, 3, 4):
        assert dict(zip(map(tuple, runs.words.tolist()), runs.size.tolist())) == want[length]
        sides = [draw.random() < 0.5 for _ in range(3)]
        runs = index.extended(runs, left=sides[length % 3])


def test_wide_keys_are_ordered_too():
    keys = np.array([5, 2**61, 3, 5, 0])
    assert phrases.ordered(keys, 2**62).tolist() == np.argsort(keys, kind="stable").tolist()


def plain_licenses(text, templates, least):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    spots, base = [], set()
    for phrase, label in licenses.PHRASES:
        own = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        spots += found
        base |= {label} if found else set()
    best, labels = 0.0, set(base)
    for b in range(0, len(words), licenses.STEP):
        block = set(words[b : b + 2 * licenses.STEP])
        for label, template in templates:
            own = set(template.split())
            share = len(own & block) / len(own)
            if share >= least:
                labels.add(label)
                best = max(best, share)
    ends = (min(spots), max(spots)) if spots else (None, None)
    return (len(words), len(spots), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if spots else best)


def licensed():
    draw = random.Random(9)
    texts = [None, "", " -- ", "mit", "Under the MIT License", "under-the/MIT. license! under the mit license", "cc by nc cc by nc", "CC BY-NC 4.0"]
    filler = [f"word{i}" for i in range(300)] + ["the", "license", "under", "and", "or", "é", "is"]
    for _, template in licenses.TEMPLATES:
        own = template.split()
        for missing in range(4):
            kept = [w for i, w in enumerate(own) if i >= missing]
            draw.shuffle(kept)
            for before in (0, 25, 31, 32, 70):
                texts.append(" ".join(draw.choices(filler, k=before) + kept + draw.choices(filler, k=draw.choice([0, 40]))))
        spread = " ".join(w + " " + " ".join(draw.choices(filler, k=12)) for w in own)
        texts.append(spread)
    texts.append(" ".join(draw.choices(filler, k=30_000)) + " licensed under the Apache license, version 2.0")
    return texts


@pytest.mark.parametrize("least", [0.9, 0.6, 1.0])
def test_license_scan(spark, least):
    texts = licensed()
    texts += texts[:12]
    kinds = "doc_id long, text string, key int, block int, tokens string, label string, score string, found string"
    rows = [(i if i % 9 else None, t, 1, 1, "clash", "clash", "clash", "clash") for i, t in enumerate(texts)]
    got = Counter(tuple(r) for r in licenses.scan_licenses(spark.createDataFrame(rows, kinds).repartition(5), least=least).collect())
    assert got == Counter((r[0], *plain_licenses(r[1], licenses.TEMPLATES, least)) for r in rows)


def test_license_scan_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan_licenses(empty).collect() == []
    assert "Python" not in licenses.scan_licenses(empty)._jdf.queryExecution().toString()


def test_filters_pass_over_blocks(spark):
    """Blocks without a rare token of a template are never counted in full."""
    texts = ["the license is under the terms of the work " * 30] * 20 + ["licensed under cc by nc 4 0"]
    rows = licenses.read_documents(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", licenses.PHRASES,
        sorted({t for _, text in licenses.TEMPLATES for t in text.split()}),
    )
    rank, ordered = licenses.ordered_templates(rows, licenses.TEMPLATES, licenses.LEAST)
    assert rank["the"] > rank["cc"] and all(own == sorted(own) for _, own, _ in ordered)
    found = licenses.matching_blocks(rows, licenses.TEMPLATES).collect()
    assert [(r.label, r.score) for r in found] == [("cc-by-nc", 1.0)]
