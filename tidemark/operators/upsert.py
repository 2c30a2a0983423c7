"""Upsert into a history table of plain Parquet partitions."""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import HISTORY_ROW, NATURAL_KEY, SLICE
from tidemark.session import workspace


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def upsert(target: DataFrame, source: DataFrame, keys: list[str] = NATURAL_KEY) -> DataFrame:
    """Target rows the source has no key for, and all source rows (one per key).

    A key with a null part equals nothing: such target rows stay and such source
    rows are added again. They would all hash to the same place in the join, so
    they get a spread value that no source key has; beyond the broadcast size
    the join then stays even, whatever share of the keys is null.
    """
    rest = [F.col(c) for c in target.columns if c not in keys]
    spread = F.when(_any_null(keys), F.xxhash64(*rest)).otherwise(F.lit(0).cast("bigint"))
    matched = (
        source.select(*keys).filter(~_any_null(keys)).withColumn("_spread", F.lit(0).cast("bigint"))
    )
    kept = target.withColumn("_spread", spread).join(matched, [*keys, "_spread"], "left_anti")
    return kept.drop("_spread").select(*target.columns).unionByName(source)


def merge_metrics(target: DataFrame, source: DataFrame, keys: list[str] = NATURAL_KEY) -> DataFrame:
    """How many source rows update a target row and how many are new, from one pass over each."""
    known = target.select(*keys).filter(~_any_null(keys)).distinct().withColumn("_hit", F.lit(1))
    marked = source.select(*keys).join(known, keys, "left")
    updated = F.count("_hit")
    total = F.count(F.lit(1))
    return marked.agg(
        (total - updated).alias("rows_inserted"),
        updated.alias("rows_updated"),
        total.alias("rows_merged"),
    )


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table by path; a table never written is empty.

    The schema is given, so partition values such as a season stay text.
    """
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace exactly the partitions present in ``df``.

    ``rebalance`` gathers each partition into files of the advisory size and
    splits a hot one over many tasks.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


# --- the history table ------------------------------------------------------------------
#
# path/data/load=<id>/<slice>/…   one folder per load and slice
# path/slices/<id>/               Parquet: which load holds each slice
# path/versions/<number>          names one of those; the largest number counts
# path/running/<id>               loads under way
#
# A load writes its folders, then a list of slices, and last the version's file, which nobody may
# have written yet. Until then, readers see the table as it was.

LOAD = "load"
#: A load that has been under way for longer is taken for lost.
LEASE_HOURS = 48


class ChangedMeanwhile(RuntimeError):
    """Another load has replaced a slice that this one has read."""


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, files = _folder(spark, path)
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in _names(spark, f"{path}/versions") if name.isdigit())


class Slice(NamedTuple):
    """One folder of the table, or of a load."""

    values: tuple
    rows: int
    load: str = ""


def _list_schema(by: list[str]) -> T.StructType:
    texts = [T.StructField(c, T.StringType()) for c in [*by, "folder", LOAD]]
    return T.StructType([*texts, T.StructField("rows", T.LongType()), T.StructField("gone", T.BooleanType())])


def _listed(spark: SparkSession, path: str, number: int, by: list[str]) -> DataFrame:
    """``by``, folder, load and rows of every slice of a version, and of those that it has replaced (``gone``)."""
    file, files = _folder(spark, f"{path}/versions/{number}")
    stream = files.open(file)
    try:
        name = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return spark.read.schema(_list_schema(by)).parquet(f"{path}/slices/{name}")


def _slices(spark: SparkSession, path: str, number: int | None, by: list[str]) -> tuple[dict[str, Slice], list[str]]:
    """Slices of a version by folder, and the paths of those that it has replaced."""
    found, gone = {}, []
    for r in _listed(spark, path, number, by).collect() if number else []:
        if r.gone:
            gone.append(f"{LOAD}={r[LOAD]}/{r.folder}")
        else:
            found[r.folder] = Slice(tuple(r[c] for c in by), r.rows, r[LOAD])
    return found, gone


def _mark(spark: SparkSession, path: str, text: str = "") -> None:
    file, files = _folder(spark, path)
    stream = files.create(file, True)
    stream.write(text.encode())
    stream.close()


def _new_version(spark: SparkSession, path: str, number: int, name: str) -> bool:
    """Write the version's file unless there is one: a rename that overwrites nothing."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    draft = f"{path}/versions/.{uuid.uuid4().hex}"
    _mark(spark, draft, name)
    source, files = _folder(spark, draft)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plainly = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(source, _folder(spark, f"{path}/versions/{number}")[0], plainly)
    except Py4JJavaError as error:
        files.delete(source, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def _switch(
    spark: SparkSession, path: str, fresh: dict[str, Slice], read: dict[str, Slice], seen: int | None,
    slices: dict[str, Slice], by: list[str],
) -> int:
    """A new version with the fresh slices; ``slices`` are those of the version ``seen``.

    If other loads came first, theirs count too; a slice of ours that they replaced is a conflict.
    """
    while True:
        numbers = _versions(spark, path)
        number = numbers[-1] if numbers else None
        if number != seen:
            slices, _ = _slices(spark, path, number, by)
            if {f: s for f, s in slices.items() if f in fresh} != read:
                raise ChangedMeanwhile(path)
        name = uuid.uuid4().hex
        rows = [(*s.values, f, s.load, s.rows, False) for f, s in {**slices, **fresh}.items()]
        rows += [(*s.values, f, s.load, s.rows, True) for f, s in read.items()]
        _small(spark, rows, _list_schema(by)).coalesce(1).write.parquet(f"{path}/slices/{name}")
        if _new_version(spark, path, (number or 0) + 1, name):
            return (number or 0) + 1
        seen = 0


def _small(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A table of few rows, without a Python worker."""
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
    columns = {f.name: pa.array([r[k] for r in rows], kinds[f.dataType.simpleString()]) for k, f in enumerate(schema.fields)}
    return spark.createDataFrame(pa.table(columns), schema)


def _counted(spark: SparkSession, root: str, by: list[str], schema: T.StructType, load: str = "") -> dict[str, Slice]:
    """The slices below a folder, one entry each; no column is read but those of the path."""
    values = [F.col(c).cast("string").alias(c) for c in by]
    files = read_table(spark, root, schema).select(*values, F.col("_metadata.file_path").alias("file"))
    files = files.groupBy(*by, "file").agg(F.count(F.lit(1)).alias("rows"))
    place = F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(place, "/((?:[^/]+/){%d})[^/]+$" % len(by), 1)
    counted = files.groupBy(*by, F.rtrim(folder, F.lit("/")).alias("folder")).agg(F.sum("rows").alias("rows")).collect()
    return {r.folder: Slice(tuple(r[c] for c in by), r.rows, load) for r in counted}


def _read_slices(spark: SparkSession, path: str, slices: dict[str, str], schema: T.StructType) -> DataFrame:
    if not slices:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/{LOAD}={load}/{name}" for name, load in sorted(slices.items())]
    with_load = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
    rows = spark.read.schema(with_load).option("basePath", f"{path}/data").parquet(*folders)
    return rows.select(*schema.fieldNames())


def read_history(
    spark: SparkSession, path: str, schema: T.StructType = HISTORY_ROW, slices: DataFrame | None = None,
    by: list[str] = SLICE,
) -> DataFrame:
    """The table as the last finished load left it; a table never written is empty.

    A filter on the partition columns prunes folders. With ``slices`` (a table with the ``by`` columns)
    only those: the list of slices is joined with the folders' values, which prunes them while the query
    runs, so neither the plan nor the driver grows with the number of slices.
    """
    numbers = _versions(spark, path)
    if not numbers:
        return spark.createDataFrame([], schema)
    if slices is None:
        return _read_slices(spark, path, {f: s.load for f, s in _slices(spark, path, numbers[-1], by)[0].items()}, schema)
    listed = _listed(spark, path, numbers[-1], by).filter(~F.col("gone") & (F.col("rows") > 0))
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    wanted = listed.join(slices.select(*[value(c).alias(f"_{c}") for c in by]), [value(c) == F.col(f"_{c}") for c in by], "left_semi")
    wanted = wanted.select(*[value(c).alias(f"_{c}") for c in by], F.col(LOAD).alias("_load"))
    with_load = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
    rows = spark.read.schema(with_load).parquet(f"{path}/data")
    same = [value(c) == F.col(f"_{c}") for c in by] + [F.col(LOAD) == F.col("_load")]
    return rows.join(wanted, same, "left_semi").select(*schema.fieldNames())


def _drop_unused(spark: SparkSession, path: str, gone: list[str], live: set[str], version: int) -> None:
    """Remove what neither this version nor the one before it names.

    Readers that began before the last switch still find their files. What goes are the slices that the
    version before had replaced, and folders of loads, listed one level deep, that no kept version names
    and that are no longer under way.
    """
    _, files = _folder(spark, path)
    drop = lambda name: files.delete(_folder(spark, f"{path}/{name}")[0], True)
    for name in gone:
        drop(f"data/{name}")
    for number in _versions(spark, path):
        if number < version - 1:
            drop(f"versions/{number}")
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    running, held = _folder(spark, f"{path}/running")[0], set()
    for status in files.listStatus(running) if files.exists(running) else []:
        if now - status.getModificationTime() < LEASE_HOURS * 3_600_000:
            held.add(status.getPath().getName())
    for name in _names(spark, f"{path}/data"):
        if name.startswith(f"{LOAD}=") and name.removeprefix(f"{LOAD}=") not in live | held:
            drop(f"data/{name}")


def upsert_table(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str] = NATURAL_KEY,
    by: list[str] = SLICE, schema: T.StructType = HISTORY_ROW, newer_wins: str | None = None,
) -> DataFrame:
    """Upsert into the table, reading and writing only the slices the source touches.

    The source is first written out beside the other work tables, by slice: its deduplication runs
    once, and its folders say which slices of the table to read. The new slices are written into
    folders of their own; the switch to them is one file. A load lost before it leaves the table as
    it was, and running a load again changes nothing (for keys without nulls). Loads may run at the
    same time: those that touch different slices both count, and one that finds a slice replaced
    merges again. With ``newer_wins``, a column, a source row that is older than the table's stays out.

    Returns ``by`` and rows_inserted, rows_updated, rows_merged of every slice touched.
    """
    names = schema.fieldNames()
    landing = workspace(spark, "landing")
    overwrite_partitions(source.select(*names), landing, by)
    landed = read_table(spark, landing, schema).select(*names)
    arrived = _counted(spark, landing, by, schema)
    while True:
        load = uuid.uuid4().hex
        _mark(spark, f"{path}/running/{load}")
        try:
            numbers = _versions(spark, path)
            seen = numbers[-1] if numbers else None
            slices, gone = _slices(spark, path, seen, by)
            read = {f: slices[f] for f in arrived if f in slices}
            before = _read_slices(spark, path, {f: s.load for f, s in read.items()}, schema)
            rows, came = landed, arrived
            if newer_wins is not None:
                overwrite_partitions(not_older(before, landed, keys, newer_wins), f"{landing}-newer", by)
                rows, came = read_table(spark, f"{landing}-newer", schema), _counted(spark, f"{landing}-newer", by, schema)
            fresh = f"{path}/data/{LOAD}={load}"
            overwrite_partitions(upsert(before, rows.select(*names), keys), fresh, by)
            written = _counted(spark, fresh, by, schema, load)
            version = _switch(spark, path, written, read, seen, slices, by)
            break
        except ChangedMeanwhile:
            continue
        finally:
            marker, files = _folder(spark, f"{path}/running/{load}")
            files.delete(marker, False)
    live = {s.load for s in [*slices.values(), *written.values()]}
    if version == (seen or 0) + 1:
        _drop_unused(spark, path, gone, live, version)
    for folder in (landing, f"{landing}-newer"):
        name, files = _folder(spark, folder)
        files.delete(name, True)
    # keys are unique in the table, so what is missing in the sum was replaced
    kinds = {f.name: f.dataType for f in schema.fields}
    counts = []
    for folder, of in came.items():
        updated = (read[folder].rows if folder in read else 0) + of.rows - written[folder].rows
        counts.append((*of.values, of.rows - updated, updated, of.rows))
    totals = ["rows_inserted", "rows_updated", "rows_merged"]
    result = T.StructType([*[T.StructField(c, T.StringType()) for c in by], *[T.StructField(c, T.LongType()) for c in totals]])
    return _small(spark, counts, result).select(*[F.col(c).cast(kinds[c]).alias(c) for c in by], *totals)


def not_older(target: DataFrame, source: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Source rows without those whose key the target has in a newer version (a missing one is the newest)."""
    newest = target.filter(~_any_null(keys)).groupBy(*keys).agg(F.max(F.struct(F.col(version).isNull(), F.col(version))).alias("_newest"))
    own = F.struct(F.col(version).isNull(), F.col(version))
    joined = source.join(newest, keys, "left")
    return joined.filter(F.col("_newest").isNull() | (own >= F.col("_newest"))).select(*source.columns)
