"""Which keys are done, over many runs.

A :class:`KeyLedger` is a bucketed table of keys that each run appends to. Resuming and merging
join new rows with it instead of with all earlier output: the ledger is narrow, and as it is
bucketed and sorted by key only the new rows are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import file_exists
from .matching import keep_one, succeeded

BUCKETS = 64


class KeyLedger:
    """Keys of completed work under ``path``, with the run that added them.

    ``schema`` names the key columns, such as ``id string``. It and the number of buckets are
    fixed when the ledger is made; whoever opens it later takes them from the folder. A key
    stands in it once. Null keys are never in it, so their rows always count as new.

    Every step takes the name of its run, and what that run has added itself does not count
    for it: a run that broke off may be repeated under its name, and finds and adds the same.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str = "id string", buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        about = f"{self.path}/_about"
        if not file_exists(spark, f"{about}/_SUCCESS"):
            fields = T.StructType.fromDDL(schema).simpleString()
            row = spark.range(1).select(F.lit(fields).alias("fields"), F.lit(buckets).alias("buckets"))
            row.write.mode("overwrite").json(about)
        made = spark.read.schema("fields string, buckets int").json(about).first()
        fields = T._parse_datatype_string(made.fields)
        if fields != T.StructType.fromDDL(schema):
            raise ValueError(f"{self.path} holds keys of another kind: {made.fields}")
        self.keys, self.buckets = fields.fieldNames(), made.buckets
        self.table = f"replyloom_ledger_{hashlib.md5(self.path.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        by = ", ".join(f"`{k}`" for k in self.keys)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, run string) USING parquet "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        spark.catalog.refreshTable(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def pending(self, df: DataFrame, run: str | None = None) -> DataFrame:
        """Rows of ``df`` whose key no other run has added."""
        done = self.rows() if run is None else self.rows().where(F.col("run") != run)
        return df.join(done.select(*self.keys).hint("merge"), self.keys, "left_anti")

    def append(self, df: DataFrame, run: str, retry_failed: bool = True) -> None:
        """Add the keys of ``df`` that are not there yet; those of failed rows
        (see :func:`~replyloom.operators.matching.succeeded`) only if told to."""
        done = succeeded(df) if retry_failed else df
        keys = done.select(*self.keys).dropna().distinct()
        new = keys.join(self.rows().select(*self.keys).hint("merge"), self.keys, "left_anti")
        # One file per bucket and run.
        dealt = new.withColumn("run", F.lit(run)).repartition(self.buckets, *self.keys)
        dealt.write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def merge(self, rows: DataFrame, run: str, path: str, order_by: Sequence[str]) -> DataFrame:
        """Rows with new keys, the first of each in ``order_by``, written to ``path``; then their
        keys are added. Over all runs the first row of a key wins. Rows without a key, null or
        empty, all stay."""
        (key,) = self.keys
        new = keep_one(self.pending(rows, run), key, order_by)
        new.write.mode("overwrite").parquet(path)
        written = self.spark.read.schema(new.schema).parquet(path)
        self.append(written.where(F.col(key).cast("string") != ""), run)
        return written
