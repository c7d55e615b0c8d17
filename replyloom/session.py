"""Session settings and written intermediate results."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Number of a row of a written frame, see :func:`number_rows`.
ROW = "_row"

# Settings that may be changed in a running session.
RUNTIME_SETTINGS = {
    # Split skewed join partitions and coalesce small ones at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A repeated JSON key takes its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Prompts are long: keep Arrow batches on their way to the model small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_SETTINGS`. Speculation has to be off where models are called,
    which only the cluster's own configuration can do: a second attempt calls them twice."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where everything runs on this machine the session's warehouse does as well; on a cluster
    its default is a folder of the driver's own, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    local = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    if not root and not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path under :func:`shared_dir` that no one else uses."""
    return f"{shared_dir(spark)}/replyloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` as parquet under :func:`shared_dir`, with the writer's ``options``, and read it back.

    Used after model calls: the calls are not repeated when several results are derived
    or an executor is lost, and later reads prune columns.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of an action are removed when it ends, not when the driver happens to collect
    its garbage: for jobs whose steps are written, see :func:`materialize`."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def number_rows(df: DataFrame, label: str) -> DataFrame:
    """:func:`materialize` with a number for each row, :data:`ROW`, that stays what it is.

    Groupings then carry this number instead of texts, and fetch the texts of the rows that they
    picked with a join. Frames that have it already are taken as they are.
    """
    if ROW in df.columns:
        return df
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), label)


def file_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, in whatever store it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def one_row(spark: SparkSession, schema: Any, values: Mapping[str, Any]) -> DataFrame:
    """A frame of one row from driver values."""
    columns = [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*columns)


class Counters:
    """Aggregates over a frame that are gathered by the job that uses it.

    ``watch`` returns the frame to go on with; after an action on it, ``row`` has the values.
    They are exact where no shuffle lies between the watched frame and that action: tasks of a
    last stage count once, those of earlier stages again when an executor is lost. The first
    action counts.
    """

    def __init__(self, **metrics: Column):
        self.metrics = [column.alias(name) for name, column in metrics.items()]
        self.seen = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        self.spark, self.schema = df.sparkSession, df.agg(*self.metrics).schema
        return df.observe(self.seen, *self.metrics)

    def values(self) -> dict[str, Any]:
        return dict(self.seen.get)

    def row(self) -> DataFrame:
        return one_row(self.spark, self.schema, self.values())


def materialize_counted(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, DataFrame]:
    """:func:`materialize`, and one row of ``metrics`` over ``df`` that the writing job gathers."""
    counters = Counters(**metrics)
    return materialize(counters.watch(df), label), counters.row()
