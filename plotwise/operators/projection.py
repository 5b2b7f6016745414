"""Column lists: keep, prefer, allow, rename."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def keep_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly these columns, cast; a column the input lacks is NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def prefer_columns(df: DataFrame, preferred) -> DataFrame:
    """Preferred columns first, in that order, then all others in theirs."""
    first = [c for c in preferred if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def allow_columns(df: DataFrame, allowed) -> DataFrame:
    """Only known columns, in the table's order: new fields in the input are dropped."""
    return df.select(*[c for c in df.columns if c in allowed and c != "id"])


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)
