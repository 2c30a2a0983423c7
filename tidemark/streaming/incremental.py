"""Load each new file once, with a file stream that stops when it has caught up."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedup import keep_latest
from tidemark.operators.upsert import overwrite_partitions, upsert_table
from tidemark.schemas import HISTORY_ROW, NATURAL_KEY, SLICE


def load_new_files(
    spark: SparkSession, folder: str, schema: T.StructType, checkpoint: str,
    each: Callable[[DataFrame, int], None], file_format: str = "parquet",
    options: dict[str, object] | None = None, files_per_batch: int | None = None,
) -> None:
    """Hand every file not seen before to ``each``, then return.

    The checkpoint lists the files already taken; it must lie on storage that
    outlives the cluster. A batch that was cut off is handed over again under
    the same number, so ``each`` must be able to repeat itself.
    """
    reader = spark.readStream.schema(schema).format(file_format).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.load(folder)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_batch(path: str, by: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """Staging append that a repeated batch replaces instead of doubling.

    Rows land below ``load_batch=<number>``, and only that number is overwritten.
    """

    def each(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn("load_batch", F.lit(number).cast("bigint"))
        overwrite_partitions(numbered, path, ["load_batch", *(by or [])])

    return each


def upsert_batch(
    path: str, ingested_at: Column | None = None, keys: list[str] = NATURAL_KEY,
    version: str = "transformed_at", by: list[str] = SLICE, schema: T.StructType = HISTORY_ROW,
    newer_wins: bool = False,
) -> Callable[[DataFrame, int], None]:
    """Dedup and upsert of each batch.

    Within a batch the newest version of a key wins. Between batches the later batch does, whatever its
    versions; with ``newer_wins`` a row that is older than the table's stays out, so a file that comes
    late changes nothing that is newer.
    """

    def each(batch: DataFrame, number: int) -> None:
        newest = keep_latest(batch, keys, version)
        if ingested_at is not None:
            newest = newest.withColumn("ingested_at", ingested_at)
        upsert_table(
            batch.sparkSession, path, newest.select(*schema.fieldNames()), keys, by, schema,
            version if newer_wins else None,
        )

    return each
