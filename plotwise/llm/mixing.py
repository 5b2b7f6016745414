"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plotwise.llm.spark import WORD, stored, unused

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
BUCKETS = 256


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the values only; any engine with md5 agrees."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES
) -> DataFrame:
    """Source, its size, and the target that water-filling gives it.

    `sizes` has columns source and size. Sources by code point, null last, take the weights
    in turn and share `share` times all sizes; a target stops at `most` times its source's
    size and what is over is shared again by weight. Sources fill up in the order of limit
    over weight, so one pass over one row per source finds the level. That table is the
    mix's own specification (a weight each), not corpus data.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = per_source.withColumn(
        "weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ).withColumn("most", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    leveled = weighted.withColumn("level", level)
    full = F.col("most") <= F.col("level") * F.col("weight")
    # all full sources come first; from the first that is not full on, levels only sink
    final = F.max(F.when(~full, F.col("level"))).over(everything)
    target = F.when(full, F.col("most")).otherwise(final * F.col("weight"))
    return leveled.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_COPIES,
    seed: int = 7,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    Every document of a source expects target / source_size copies, `most` at the most. The
    expected copies are summed in the order (size class, bucket, size, id), one random
    offset per source is added, and a document is emitted once for each whole number its
    step crosses. As the expectation is one number per source, the prefix sum is rank times
    that number, exact and equal on every run. Long and short documents are spread evenly,
    so the words taken come near the target.

    No task ranks a source: blocks of (source, size class, bucket of the id's hash) are
    counted, their counts are summed along the buckets of a class and the classes of a
    source (at most 256 and a few hundred rows), and rows are ranked in their own block.

    Null text: size 0. Null source: a source of its own. Null ids are ranked among
    themselves; rows that are equal in all that counts share copies in any order. Sources
    without words have target 0 and take nothing. An empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")).alias("key"),  # of a null source: empty
        size.alias("size"),
    )
    rows = rows.select(
        "*",
        F.floor(F.log2(F.col("size") + 1) * 16).cast("int").alias("class"),
        F.floor(_unit(F.lit(seed), F.col("doc_id")) * BUCKETS).cast("int").alias("bucket"),
    )
    rows = stored(rows, "mixing-sizes")  # texts are read once, for their sizes
    source = F.when(F.col("key") != "", F.expr("substring(key, 2)"))
    blocks = rows.groupBy("key", "class", "bucket").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    targets = source_targets(blocks.select(source.alias("source"), "size"), weights, share, most).withColumn(
        "key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    )
    in_class = Window.partitionBy("key", "class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    in_source = Window.partitionBy("key").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    classes = (
        blocks.groupBy("key", "class")
        .agg(F.sum("n").alias("n"))
        .select("key", "class", F.coalesce(F.sum("n").over(in_source), F.lit(0)).alias("ahead"))
    )
    offsets = (
        blocks.withColumn("before", F.coalesce(F.sum("n").over(in_class), F.lit(0)))
        .join(classes, ["key", "class"])
        .join(targets, "key")
        .select(
            "key", "class", "bucket", "source", (F.col("ahead") + F.col("before")).alias("ahead"), "source_size", "target"
        )
    )
    in_block = Window.partitionBy("key", "class", "bucket").orderBy("size", F.col("doc_id").asc_nulls_last())
    rank, rate = F.col("ahead") + F.col("place"), F.col("rate")
    return (
        rows.withColumn("place", F.row_number().over(in_block))
        .join(offsets, ["key", "class", "bucket"])
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("offset", _unit(F.lit(seed), F.lit("offset"), F.col("source")))
        .withColumn(
            "copies", F.floor(rank * rate + F.col("offset")) - F.floor((rank - 1) * rate + F.col("offset"))
        )
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mix itself: every row as often as it is taken, with its columns unchanged.

    Rows whose id is their own take what the mix says of it. Rows that share an id, null ids among
    them, are told apart by source and size; those equal in these are ranked by a hash and take
    the copies of that id, source and size in turn, so the mix as a whole is as drawn.
    Clashing column names do no harm; an empty table gives an empty result.
    """
    mix = stored(mix_sources(docs, id_col, text_col, source_col, **options).select("doc_id", "source", "size", "copies"), "mix")
    ids = mix.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("copies").alias("copies"))
    name, copies, copy, rows, nth = (unused(docs, n) for n in ("_drawn_id", "_copies", "_copy", "_rows", "_nth"))
    drawn = ids.select(F.col("doc_id").alias(name), F.col("copies").alias(copies), F.col("rows").alias(rows))
    by_id = F.col(id_col).eqNullSafe(F.col(name))

    def repeated(taken: DataFrame) -> DataFrame:
        each = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))
        return taken.filter(F.col(copies) > 0).withColumn(copy, each).select(*docs.columns)

    once = repeated(docs.join(drawn.filter((F.col(rows) == 1) & (F.col(copies) > 0)), by_id))
    shared = drawn.filter((F.col(rows) > 1) & (F.col(copies) > 0)).select(name)
    if shared.isEmpty():
        return once
    own = docs.join(shared, by_id, "left_semi")
    size, source = (unused(docs, n) for n in ("_size", "_source"))
    own = own.withColumn(size, F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"))
    by_hash = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in docs.columns])
    own = own.withColumn(nth, F.row_number().over(Window.partitionBy(id_col, source_col, size).orderBy(by_hash)))
    in_turn = Window.partitionBy("doc_id", "source", "size").orderBy(F.desc("copies"))
    turns = mix.withColumn("nth", F.row_number().over(in_turn)).select(
        F.col("doc_id").alias(name), F.col("source").alias(source), F.col("size").alias(f"{size}_"),
        F.col("nth").alias(f"{nth}_"), F.col("copies").alias(copies),
    )
    same = by_id & F.col(source_col).eqNullSafe(F.col(source)) & (F.col(size) == F.col(f"{size}_")) & (F.col(nth) == F.col(f"{nth}_"))
    return once.unionByName(repeated(own.join(turns, same)))
