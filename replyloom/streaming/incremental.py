"""Incremental model runs: answer whatever JSONL has arrived since the last run.

The batch way to resume is :func:`replyloom.operators.matching.pending`, an anti-join
on ids. Where new rows only ever arrive in new files, a stream does the same without
reading old input or output again: its checkpoint records which files are done.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import fixed_values as fixed
from ..operators.inference import Backend, batch_infer
from ..sources.jsonl import parse_lines
from ..sources.sinks import json_line


def stream_infer(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    schema: str,
    backend: Backend,
    params: Mapping[str, Any] | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files_per_trigger: int | None = None,
    **options: Any,
) -> StreamingQuery:
    """Start a query that answers the JSONL files of ``source`` into ``sink`` and then ends.

    Lines are parsed as :func:`~replyloom.sources.jsonl.parse_lines` does; those that are
    no object are left to :func:`stream_bad_lines`. ``prepare`` is a row-wise step (such as
    ``prepare_stage1``) ahead of the model. Files of a micro-batch that failed are answered
    again, those that were committed are not.
    """
    rows, _ = _parsed(spark, source, schema, max_files_per_trigger)
    answered = batch_infer(prepare(rows), backend, params, **options)
    return _started(answered, sink, checkpoint)


def stream_bad_lines(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    schema: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start a query that puts the undecodable lines of ``source`` into ``sink``, with their
    file and error, and then ends. It keeps its own account of files."""
    _, bad = _parsed(spark, source, schema, max_files_per_trigger)
    failed = bad.select(F.col("file").alias("source_file"), "value", F.lit(fixed.BAD_LINE).alias("error"))
    return _started(failed, sink, checkpoint)


def _parsed(
    spark: SparkSession, source: str, schema: str, max_files: int | None
) -> tuple[DataFrame, DataFrame]:
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_lines(reader.text(source).select("value", F.col("_metadata.file_path").alias("file")), schema)


def _started(rows: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.select(json_line(rows).alias("value"))
        .writeStream.format("text")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )
