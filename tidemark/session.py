"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE does the run-time half of the skew story: it splits hot join partitions,
# splits hot output partitions behind a ``rebalance`` hint and merges small ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Rows of ``spread`` for one task: seconds of work, so that a slow or lost executor holds up little of it.
ROWS_PER_TASK = 20_000


def spread(df: DataFrame) -> DataFrame:
    """Rows that cost far more to work on than to move, dealt evenly over the cores.

    The tasks grow in number with the rows, not in length; of a file's rows only the footers are counted.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // ROWS_PER_TASK)))


@functools.cache
def _one_machine_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    A machine-local folder is only acceptable when the whole "cluster" is this
    one machine, so anything but a local master must name the shared folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _one_machine_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
