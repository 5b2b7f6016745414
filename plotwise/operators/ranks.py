"""Ranks and medians of groups of any size.

A window over a whole group would put the group into one task. Here a group is cut
into many small ranges first; only counts per range are combined. One path serves all sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plotwise.session import cut_lineage

SPAN = 10_000  # page numbers per range
FEW_BOUNDS = 20_000  # rows, two a group, that are sent to every task
BINS = 1024  # parts of a group's values that one pass tells apart


def rank_within(
    df: DataFrame, groups: list[str], step: str, order: list[Column], name: str, top: int | None = None
) -> DataFrame:
    """1-based rank in (step, order) within each group; step is a whole number >= 0.

    Three levels, each a small window: ranges of steps, steps in a range, rows of a
    step. With `top`, rows ranked below it are dropped before the last level.
    """
    span = F.floor(F.col(step) / SPAN)
    counts = (
        df.groupBy(*groups, F.col(step).alias("_step"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_span", F.floor(F.col("_step") / SPAN))
    )
    totals = counts.groupBy(*groups, "_span").agg(F.sum("_n").alias("_total"))
    before_span = F.sum("_total").over(
        W.partitionBy(*groups).orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    )
    spans = totals.select(*groups, "_span", F.coalesce(before_span, F.lit(0)).alias("_above"))
    before_step = F.sum("_n").over(
        W.partitionBy(*groups, "_span").orderBy("_step").rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = (
        counts.join(spans, [*groups, "_span"])
        .withColumn("_offset", F.col("_above") + F.coalesce(before_step, F.lit(0)))
        .select(*groups, "_step", "_offset")
    )
    if top is not None:
        offsets = offsets.where(F.col("_offset") < top)
    rows = df.withColumn("_step", F.col(step)).join(offsets, [*groups, "_step"])
    within = F.row_number().over(W.partitionBy(*groups, "_step").orderBy(*order))
    ranked = rows.withColumn(name, F.col("_offset") + within).drop("_step", "_offset")
    ranked = ranked.select(*df.columns, name)
    return ranked if top is None else ranked.where(F.col(name) <= top)


def exact_median(df: DataFrame, value: str, groups: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """groups, n, median: the exact middle value (mean of two) of each group.

    weight is a column that says how many values a row stands for.

    The values between a group's bounds are counted in 1024 equal parts; the part that
    holds the middle rank gives the next bounds, its own smallest and largest value, until
    both are one value. A group that got there takes part in no further pass. Counts fold
    before they are shuffled, so a group of any size is at most 1024 rows per task, and
    each pass drops at least one value and mostly all but a thousandth. NULL values and
    groups do not count.

    Runs at once; the two columns and the bounds are checkpointed.
    """
    groups = list(groups or [])
    times = F.lit(1) if weight is None else F.col(weight)
    rows = df.select(*groups, F.col(value).cast("double").alias("v"), times.cast("long").alias("w")).dropna()
    return _median(cut_lineage(rows.withColumn("_all", F.lit(0))), [*groups, "_all"]).drop("_all")


def _median(rows: DataFrame, groups: list[str]) -> DataFrame:
    n = F.col("n")
    sizes = rows.groupBy(*groups).agg(F.sum("w").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    middles = F.array(F.floor((n - 1) / 2), F.floor(n / 2))  # ranks from 0
    state = sizes.select(*groups, "n", F.posexplode(middles).alias("which", "k"), "lo", "hi")
    columns = [*groups, "n", "which", "k", "lo", "hi"]
    state = cut_lineage(state.select(*columns))
    while left := state.where("lo < hi").count():
        # halves cannot overflow; the bounds themselves are always told apart
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        part = F.least(F.floor(F.nanvl(share, F.lit(0.0)) * BINS), F.lit(BINS - 1))
        # with few groups a shuffle by group would put all rows into as few tasks
        bounds = state.where("lo < hi")
        parts = (
            rows.join(F.broadcast(bounds) if left <= FEW_BOUNDS else bounds, groups)
            .where(F.col("v").between(F.col("lo"), F.col("hi")))
            .withColumn("part", F.when(F.col("v") == F.col("hi"), BINS).otherwise(part))
            .groupBy(*groups, "n", "which", "k", "part")
            .agg(F.sum("w").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        )
        upto = F.sum("c").over(W.partitionBy(*groups, "which").orderBy("part"))
        chosen = (
            parts.withColumn("before", upto - F.col("c"))
            .where((F.col("before") <= F.col("k")) & (F.col("k") < F.col("before") + F.col("c")))
            .withColumn("k", F.col("k") - F.col("before"))
        )
        state = cut_lineage(state.where("lo = hi").unionByName(chosen.select(*columns)))
    ends = state.groupBy(*groups, "n").agg(F.min("lo").alias("a"), F.max("lo").alias("b"))
    return ends.select(*groups, "n", (F.col("a") + (F.col("b") - F.col("a")) * 0.5).alias("median"))


def page_of(df: DataFrame, step: str, order: list[Column], first: int, last: int, name: str) -> DataFrame:
    """Rows of rank first < rank <= last in (step, order), with their rank; order is total.

    Steps that end before the page or start after it are dropped by their counts, rows are
    not ranked for that. What is left of a step of any size is dealt into ranges of the order;
    ranges beside the page are dropped by their counts as well, and each window is one range.
    """
    all_, n = "_all", F.col("_n")
    counts = df.groupBy(F.col(step).alias("_step")).agg(F.count("*").alias("_n"))
    counts = counts.withColumns({"_span": F.floor(F.col("_step") / SPAN), all_: F.lit(0)})
    totals = counts.groupBy(all_, "_span").agg(F.sum("_n").alias("_total"))
    before = W.partitionBy(all_).orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    spans = totals.select("_span", "_total", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_above"))
    spans = spans.where((F.col("_above") < last) & (F.col("_above") + F.col("_total") > first))
    inside = W.partitionBy("_span").orderBy("_step").rowsBetween(W.unboundedPreceding, -1)
    steps = counts.join(spans, "_span").withColumn("_offset", F.col("_above") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    steps = cut_lineage(steps.where((F.col("_offset") < last) & (F.col("_offset") + n > first)).select("_step", "_offset"))
    base = steps.agg(F.coalesce(F.min("_offset"), F.lit(0)).alias("base")).first()["base"]

    rows = df.withColumn("_step", F.col(step)).join(steps.select("_step"), "_step", "left_semi")
    ranged = rows.repartitionByRange(F.col("_step"), *order).withColumn("_part", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    parts = ranged.groupBy("_part").agg(F.count("*").alias("_n")).withColumn(all_, F.lit(0))
    ahead = F.sum("_n").over(W.partitionBy(all_).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.withColumn("_before", F.lit(base) + F.coalesce(ahead, F.lit(0)))  # a row per range
    parts = parts.where((F.col("_before") < last) & (F.col("_before") + n > first)).select("_part", "_before")
    place = F.row_number().over(W.partitionBy("_part").orderBy("_step", *order))
    ranked = ranged.join(parts, "_part").withColumn(name, F.col("_before") + place)
    return ranked.where((F.col(name) > first) & (F.col(name) <= last)).select(*df.columns, name)
