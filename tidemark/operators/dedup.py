"""Which of several rows with one key stays.

All of them are ``row_number() <= n`` filters, which Spark runs as a
``WindowGroupLimit``: every map task first cuts its share of each key down to n
rows, so a key holding a third of the data never meets in one task. Spark does
so up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000 unless set);
for a larger ``n`` the answer is the same, but a hot key meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def keep_latest(
    df: DataFrame, keys: list[str], version: str, tie: list[Column] | None = None
) -> DataFrame:
    """Newest row per key; a missing version counts as newest.

    Rows of one file share their version, so the remaining columns break the
    tie: the same input always gives the same survivor.
    """
    if tie is None:
        rest = [c for c in df.columns if c not in keys and c != version]
        tie = [F.col(c).asc_nulls_first() for c in rest]
    return first_n(df, keys, [F.col(version).desc_nulls_first(), *tie])


def keep_first(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """First row per key in document order."""
    return first_n(df, keys, [F.col(c).asc_nulls_first() for c in position])


def keep_first_across(
    df: DataFrame, keys: list[str], season: str, seasons: list[str], position: list[str]
) -> DataFrame:
    """First row per key over an ordered list of seasons; other seasons are not looked at."""
    ordinal = F.array_position(F.array(*[F.lit(s) for s in seasons]), F.col(season))
    listed = df.filter(F.col(season).isin(seasons))
    return first_n(listed, keys, [ordinal.asc(), *[F.col(c).asc_nulls_first() for c in position]])


def top_n(df: DataFrame, groups: list[str], position: list[str], n: int) -> DataFrame:
    """The first n rows of each group in discovery order."""
    return first_n(df, groups, [F.col(c).asc_nulls_first() for c in position], n)
