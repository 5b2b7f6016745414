"""License scans: an exact set-similarity join of text blocks with templates, in DataFrame functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from plotwise.llm.spark import ascii_lower, stored

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases of the base scan, and the license notices looked for, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
)
LEAST = 0.9  # share of a template's tokens that a block must hold
STEP = 32  # words between blocks; a block is two steps long, so a notice of one step lies in one block


def _spaces(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit(" ")))).cast("long")


def _places(padded: Column, n_words: Column, phrase: str) -> Column:
    """n, first, last: the places where the phrase's words stand, as word numbers."""
    size = len(phrase.split())
    parts = F.split(padded, f" {phrase}(?= )", -1)
    first = _spaces(F.get(parts, F.lit(0)))
    last = n_words - (_spaces(F.element_at(parts, -1)) - 1) - size
    found = F.struct((F.size(parts) - 1).cast("long").alias("n"), first.alias("first"), last.alias("last"))
    none = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(None).cast("long").alias(n) for n in ("first", "last")])
    return F.when(F.contains(padded, F.lit(f" {phrase} ")), found).otherwise(none)


def read_documents(docs: DataFrame, id_col: str, text_col: str, phrases, tokens: list[str]) -> DataFrame:
    """A stored row per document: its base places, and where tokens of the templates stand."""
    lower = ascii_lower(F.coalesce(text_col, F.lit("")))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.concat(F.lit(" "), F.trim(F.regexp_replace(lower, NOT_WORD, " ")), F.lit(" ")).alias("padded"),
    )
    n_words = F.when(F.col("padded") == "  ", 0).otherwise(_spaces(F.col("padded")) - 1).cast("long")
    rows = rows.select("doc_id", "padded", n_words.alias("n_words"))
    base = [_places(F.col("padded"), F.col("n_words"), p).alias(f"base{i}") for i, (p, _) in enumerate(phrases)]
    words = F.split(F.col("padded"), " ")  # an empty one before the first word
    placed = F.transform(words, lambda w, i: F.struct((i - 1).alias("place"), w.alias("token")))
    hits = F.filter(placed, lambda h: h["token"].isin(tokens))
    rows = rows.select(F.monotonically_increasing_id().alias("key"), "doc_id", "n_words", *base, hits.alias("hits"))
    return stored(rows, "license-tokens")


def ordered_templates(rows: DataFrame, templates, least: float) -> tuple[dict[str, int], list]:
    """Ranks of tokens from rare to frequent over all documents, and templates as sorted ranks.

    One row per token of the templates comes to the driver.
    """
    tokens = sorted({t for _, text in templates for t in text.split()})
    found = rows.select(F.explode(F.array_distinct("hits.token")).alias("token")).groupBy("token").count().collect()
    often = {r["token"]: r["count"] for r in found}
    rank = {t: i for i, t in enumerate(sorted(tokens, key=lambda t: (often.get(t, 0), t)))}
    made = []
    for label, text in templates:
        own = sorted(rank[t] for t in set(text.split()))
        made.append((label, own, math.ceil(round(least * len(own), 9))))
    return rank, made


def matching_blocks(rows: DataFrame, templates, least: float = LEAST) -> DataFrame:
    """key, block, label, score of every block that holds the share of a template's tokens.

    A template of n tokens that must share m has a prefix of its n - m + 1 rarest tokens, one
    of which every such block holds. Documents without any are left out; the others' blocks meet
    templates by prefix token. A block with fewer than m tokens (length filter) and one in
    which too few tokens are left behind the matching ones (positional filter) are passed
    over; the rest is counted in full. Nothing that reaches the share is missed.
    """
    spark = rows.sparkSession
    rank, ordered = ordered_templates(rows, templates, least)
    prefixes = [own[: len(own) - most + 1] for _, own, most in ordered]
    by_rank = F.create_map(*[x for t, r in rank.items() for x in (F.lit(t), F.lit(r))])
    rare = [t for t, r in rank.items() if any(r in p for p in prefixes)]
    near = rows.filter(F.exists("hits", lambda h: h["token"].isin(rare)))
    hit = near.select("key", F.explode("hits").alias("hit"))
    hit = hit.select(
        "key",
        by_rank[F.col("hit.token")].alias("token"),
        F.explode(F.sequence(F.greatest(F.floor(F.col("hit.place") / STEP) - 1, F.lit(0)), F.floor(F.col("hit.place") / STEP))).alias("block"),
    )
    blocks = hit.groupBy("key", "block").agg(F.sort_array(F.collect_set("token")).alias("tokens"))
    probes = [
        (i, label, own, most, place, token)
        for i, ((label, own, most), prefix) in enumerate(zip(ordered, prefixes))
        for place, token in enumerate(prefix)
    ]
    kinds = "template int, label string, own array<int>, most int, place int, probe int"
    probes = F.broadcast(spark.createDataFrame(probes, kinds))  # a row per prefix token of the given templates
    held = blocks.select("*", F.posexplode("tokens").alias("at", "probe")).join(probes, "probe")
    size, n = F.size("tokens"), F.size("own")
    held = held.filter(size >= F.col("most"))
    held = held.filter(1 + F.least(n - F.col("place") - 1, size - F.col("at") - 1) >= F.col("most"))
    held = held.withColumn("shared", F.size(F.array_intersect("own", "tokens"))).filter("shared >= most")
    return held.select("key", "block", "label", (F.col("shared") / n).alias("score"))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases=PHRASES,
    templates=TEMPLATES,
    least: float = LEAST,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of letters (A-Z lower-cased), digits and characters beyond ASCII. Base
    places are those where a phrase's words stand consecutively. Labels are those of the base
    and of every template that a block of 64 words, one starting every 32, holds to the
    `least` share of its distinct tokens; score is 1 with a base place, else the highest
    share found, else 0. Templates of up to 33 words lie whole in some block.

    Every row is its own document: rows with null or repeated ids are kept apart. A null text
    counts as empty (0 words, null places, empty labels, score 0). Texts are read whole;
    a long one is many blocks, which are grouped by row and block. Further columns are ignored. An
    empty table gives an empty result.
    """
    tokens = sorted({t for _, text in templates for t in text.split()})
    rows = read_documents(docs, id_col, text_col, phrases, tokens)
    found = matching_blocks(rows, templates, least).groupBy("key").agg(
        F.collect_set("label").alias("found"), F.max("score").alias("best")
    )
    places = [F.col(f"base{i}") for i in range(len(phrases))]
    base = F.array_compact(F.array(*[F.when(p["n"] > 0, label) for p, (_, label) in zip(places, phrases)]))
    n_base = sum((p["n"] for p in places[1:]), places[0]["n"])
    out = rows.drop("hits").join(found, "key", "left")
    every = F.array_union(base, F.coalesce("found", F.array().cast("array<string>")))

    def said(labels: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(labels)), ",")

    return out.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.array_min(F.array(*[p["first"] for p in places])).alias("first_word"),
        F.array_max(F.array(*[p["last"] for p in places])).alias("last_word"),
        said(base).alias("base_labels"),
        said(every).alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
