"""Shared execution helpers: stored intermediate tables, exact ranks, session settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def local_session(app: str = "labelscope", cores: str = "*") -> SparkSession:
    """Session for tests and local runs; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.labelscope.scanPartitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own machine: on a cluster
    such a table would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="labelscope-"))
    return context.getCheckpointDir()


#: Paths given out so far, by application.
_given: dict[str, list[str]] = {}


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the intermediate tables made inside when it ends; frames that read them must be used up by then."""
    given = _given.setdefault(spark.sparkContext.applicationId, [])
    start = len(given)
    try:
        yield
    finally:
        dropped(spark, given[start:])
        del given[start:]


def dropped(spark: SparkSession, paths: Sequence[str]) -> None:
    """Deletes tables of the shared folder."""
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(settings).delete(path, True)


def written(df: DataFrame, name: str) -> str:
    """Write ``df`` once as a table in the shared folder; returns its path."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back.

    Cuts the lineage, survives lost executors, and gives the optimizer the true size:
    a table below ``spark.sql.autoBroadcastJoinThreshold`` is broadcast in later joins,
    a larger one takes the shuffle join with AQE skew splitting.
    """
    return df.sparkSession.read.schema(df.schema).parquet(written(df, name))


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Exact 1-based row number within each group; no group has to fit in one task.

    Rows are range-partitioned by (group, order), so a group with a third of all rows
    spreads over a third of the partitions. Each row keeps its place inside its
    partition; a small table of (group, partition) counts supplies the offset. ``order``
    must be total (end it with an id) and group columns must not be null.
    """
    keys = [F.col(g) for g in group]
    laid_out = stored(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_slot", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()),
        "ranked",
    )
    counts = laid_out.groupBy(*group, "_slot").agg(
        F.min("_place").alias("_first"), F.count("*").alias("_n")
    )
    before = (
        Window.partitionBy(*group)
        .orderBy("_slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        *group,
        "_slot",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    return (
        laid_out.join(stored(offsets, "rank-offsets"), [*group, "_slot"])
        .withColumn(name, F.col("_place") + F.col("_shift"))
        .drop("_slot", "_place", "_shift")
    )
