"""Exact duplicates by skew-safe combining."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from plotwise.llm.spark import ascii_lower, one_row_each, stored, unused

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per document: id, digest, keep_id, group_size, kept.

    Texts are equal when their normalised forms are; a null text counts as empty. Of equal
    texts the largest id stays. Three merges, each grouping by the digest and by the full
    normalised text, so two texts that share a digest never merge:

    1. within each input task (the partial aggregate): copies leave a task as one row;
    2. by digest and salt, the salt being the input task's number, so that a group of any
       size is merged by up to `salts` tasks;
    3. the salts' winners by digest.

    Only digests travel to bring the result back to the rows. Should one digest hold
    several texts, those rows are joined by their full text.

    A null id is never kept unless all ids of its group are null; rows repeating id and
    text are one document and all carry its result. Other columns are ignored, so their
    names cannot clash. An empty table gives an empty result.
    """
    norm = F.coalesce(normalise(F.col(text_col)), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm")).withColumn("digest", digest(F.col("norm")))
    local = (
        rows.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("digest", "salt", "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    merged = local.groupBy("digest", "norm").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    winners = stored(
        merged.groupBy("digest").agg(
            F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        ),
        "exact-winners",
    )
    names = ["doc_id", "digest", "keep_id", "group_size"]
    out = rows.select("doc_id", "digest").join(winners.filter("texts = 1"), "digest").select(*names)
    if not winners.filter("texts > 1").isEmpty():
        shared = merged.join(winners.filter("texts > 1").select("digest"), "digest", "left_semi")
        out = out.unionByName(rows.join(shared, ["digest", "norm"]).select(*names))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, all their columns unchanged: one row of every group of equal texts.

    A row stays by its id and its text: another text of a kept id goes if its own group keeps
    another row. Of rows that repeat both one stays, also where all ids of a group are null.
    Clashing column names do no harm; an empty table gives an empty result.
    """
    kept = exact_groups(docs, id_col, text_col).filter("kept").groupBy("doc_id", "digest").agg(F.count("*").alias("rows"))
    kept = stored(kept, "exact-kept")
    mark, digest, rows, own = (unused(docs, n) for n in ("_kept_id", "_digest", "_rows", "_own"))
    marked = docs.withColumn(own, sha256(F.coalesce(ascii_lower(F.col(text_col)), F.lit(""))))
    kept = kept.select(F.col("doc_id").alias(mark), F.col("digest").alias(digest), F.col("rows").alias(rows))
    same = F.col(id_col).eqNullSafe(F.col(mark)) & (F.col(own) == F.col(digest))
    once = marked.join(kept.filter(F.col(rows) == 1), same, "left_semi").select(*docs.columns)
    often = kept.filter(F.col(rows) > 1)
    if often.isEmpty():
        return once
    repeated = one_row_each(marked.join(often.drop(rows), same, "left_semi"), [own])
    return once.unionByName(repeated.select(*docs.columns))
