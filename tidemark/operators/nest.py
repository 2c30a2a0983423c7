"""Rows into nested documents and back."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def nest_rows(
    df: DataFrame, keys: list[str], position: str, columns: list[str], into: str,
    rows_per_part: int | None = None,
) -> DataFrame:
    """One document per key with its rows as an ordered array.

    ``position`` numbers the rows of a document from 0. With ``rows_per_part``, for documents that no
    task should hold whole, a document comes as parts (``part_no``) cut by that number; where positions
    repeat, a part may still be too full: such parts are found by a count over the keys and cut further
    (``piece_no``). Whatever the cuts, ``flatten_rows`` gives all rows back.
    """
    if rows_per_part is None:
        row = F.struct(F.col(position).alias("_pos"), *[F.col(c) for c in columns])
        whole = df.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias(into))
        return whole.withColumn(into, F.transform(into, lambda row: F.struct(*[row[c].alias(c) for c in columns])))
    part = F.floor(F.col(position) / F.lit(rows_per_part)).cast("bigint")
    parted = df.select(
        *keys, part.alias("part_no"),
        F.struct(F.col(position).alias("_pos"), *[F.col(c) for c in columns]).alias("_doc_row"),
    )
    by = [*keys, "part_no"]
    overfull = (
        df.select(*keys, part.alias("part_no")).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_part)
        .select(*by, F.ceil(F.col("_n") / F.lit(rows_per_part)).cast("bigint").alias("_pieces"))
    )
    copies = _cut_pieces(parted.join(overfull, by, "left"), by, rows_per_part)
    nested = copies.groupBy(*by, "piece_no").agg(
        F.flatten(F.collect_list(F.array_repeat("_doc_row", F.col("_copies")))).alias(into)
    )
    fields = F.transform(
        F.array_sort(into), lambda row: F.struct(*[row[c].alias(c) for c in columns])
    )
    return nested.withColumn(into, fields)


def _cut_pieces(rows: DataFrame, by: list[str], size: int) -> DataFrame:
    """Rows with piece_no and a number of copies of at most ``size``.

    Different rows of a part go to pieces by their contents, so a repeated task
    cuts alike; equal rows, which no hash can part, are counted before the
    shuffle and dealt out as numbers.
    """
    pieces = F.coalesce(F.col("_pieces"), F.lit(1).cast("bigint"))
    dealt = rows.select(
        *by, pieces.alias("_pieces"), F.pmod(F.xxhash64("_doc_row"), pieces).alias("_piece"),
        "_doc_row",
    )
    counted = dealt.groupBy(*by, "_pieces", "_piece", "_doc_row").agg(
        F.count(F.lit(1)).alias("_all")
    )
    rounds = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_all") - 1) / F.lit(size)))
    return counted.select("*", F.explode(rounds).alias("_round")).select(
        *by,
        (F.col("_piece") + F.col("_round") * F.col("_pieces")).alias("piece_no"),
        "_doc_row",
        F.least(F.lit(size).cast("bigint"), F.col("_all") - F.col("_round") * size)
        .cast("int").alias("_copies"),
    )


def each_row(df: DataFrame, rows: str, keep: list, position: str = "_at") -> DataFrame:
    """One line per array element: ``keep``, ``position`` (from 0) and ``_row``.

    The outer form, then a filter: for the inner form Spark infers a filter on
    the array's size and pushes it, with the whole expression that builds the
    array, below the projection, so a computed array would be built again.
    """
    listed = df.select(*keep, F.posexplode_outer(rows).alias(position, "_row"))
    return listed.filter(F.col(position).isNotNull())


def flatten_rows(documents: DataFrame, rows: str, keep: list | None = None) -> DataFrame:
    """Rows of every document; an empty array gives none."""
    names = [c.name for c in documents.select(*(keep or [])).schema.fields] if keep else []
    return each_row(documents, rows, keep or []).select(*names, "_row.*")


def map_rows(documents: DataFrame, rows: str, change: Callable[[Column], Column]) -> DataFrame:
    """Change the nested rows in place, array in and array out."""
    return documents.withColumn(rows, F.transform(rows, change))
