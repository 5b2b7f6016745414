"""One row per key. Both forms fold rows before the shuffle, so a hot key travels as
at most one row per input task and never becomes one large group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plotwise.operators.ranks import rank_within


def _columns(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def row_hash(df: DataFrame, but=()) -> Column:
    """A number for the whole row, so that rows equal in all else order the same on every run."""
    unhashed = (T.MapType, T.VariantType)
    parts = [
        F.to_json(F.struct(F.col(f.name))) if "variant" in (kind := f.dataType.simpleString()) or "map<" in kind
        or isinstance(f.dataType, unhashed) else F.col(f.name)
        for f in df.schema.fields
        if f.name not in but
    ]
    return F.xxhash64(*parts)


def argmax_rows(df: DataFrame, keys: list[str], order, tie: Column | None = None, keep=None) -> DataFrame:
    """The row of each key with the largest order columns (NULL is smallest).

    Where these are equal a hash of the row decides (or `tie`): the same row however the input lies. Of the
    columns beside the keys, only those of `keep` travel and come back, where it is given.
    """
    tie = row_hash(df) if tie is None else tie
    rest = [c for c in (df.columns if keep is None else keep) if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*_columns(order), tie)).alias("_row"))
    return picked.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns if c in (*keys, *rest)])


def argmin_rows(df: DataFrame, keys: list[str], order) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*_columns(order), row_hash(df))).alias("_row")
    )
    return picked.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def keep_latest(
    df: DataFrame,
    key: str = "url",
    time: str = "scraped_at",
    ties=(),
    prefer_known_time: bool = False,
) -> DataFrame:
    """Last observation per key. A row without a time counts as the newest, as in the
    stored tables, unless prefer_known_time. ties stand in for the input order (a file's
    path and the place in it, see staged.POSITION); without them a hash of the row decides."""
    unknown = F.col(time).isNotNull() if prefer_known_time else F.col(time).isNull()
    return argmax_rows(df, [key], [unknown, F.col(time), *_columns(ties)])


def first_discovered(links: DataFrame, portal: str = "portal", url: str = "url") -> DataFrame:
    """First sighting of each URL of a portal, in page order then link order."""
    return argmin_rows(links, [portal, url], ["page_no", "pos"])


def cap_discovered(
    links: DataFrame, cap: int, portal: str = "portal", url: str = "url"
) -> DataFrame:
    """The first `cap` URLs of each portal in discovery order; 0 keeps all."""
    if not cap:
        return links
    ranked = rank_within(links, [portal], "page_no", [F.col("pos"), F.col(url)], "_rank", top=cap)
    return ranked.drop("_rank")
