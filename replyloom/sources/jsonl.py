"""JSONL scans with strict parsing, open schema and physical line numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import fixed_values as fixed
from ..functions.scores import json_envelope, open_envelope
from ..functions.text import py_strip

def scan_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Physical lines with the file they come from: ``value, file, block, row``.

    ``block`` is the offset of the file split a line was read in; ``row`` grows with the
    lines of a split. (file, block, row) orders lines as they are in the files.
    """
    reader = spark.read
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _first_lines(lines: DataFrame) -> DataFrame:
    """One row per file block: its lowest ``row``, line count and first line number."""
    blocks = lines.groupBy("file", "block").agg(
        F.min("row").alias("first_row"), F.count(F.lit(1)).alias("rows")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("first_line", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def number_lines(lines: DataFrame) -> DataFrame:
    """Add the 0-based ``line`` within each file to :func:`scan_lines`.

    A first, narrow scan counts lines per block; lines find their block's four numbers by
    an equi-join, for which Spark chooses the way from the size of the block table. The two
    scans have to cut the files alike: a row outside its block's counted range fails the
    job rather than getting a wrong number.
    """
    blocks = _first_lines(lines.select("file", "block", "row"))
    offset = F.col("row") - F.col("first_row")
    error = F.raise_error(F.lit("files were split differently while numbering lines"))
    line = F.when(
        offset.between(0, F.col("rows") - 1), F.col("first_line") + offset
    ).otherwise(error.cast("bigint"))
    return lines.join(blocks, ["file", "block"], "left").select("value", "file", line.alias("line"))


def _typed(parsed: Column, schema: T.StructType) -> dict[str, Column]:
    return {
        f.name: F.try_variant_get(parsed, f"$['{f.name}']", f.dataType.simpleString())
        for f in schema.fields
    }


def parse_lines(lines: DataFrame, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """Parse column ``value`` of lines into ``(rows, bad)``.

    ``rows`` has the schema's fields, ``extra`` (a map of all other fields, carried through
    to :func:`~replyloom.sources.write_jsonl`) and the other columns of ``lines``, which
    say where a row was read. A field whose value is not of its type is null and in
    ``extra`` as it is. ``bad`` has the non-blank lines that are not one JSON object.
    Blank lines are skipped.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    where = [c for c in lines.columns if c != "value"]
    filled = lines.where(py_strip(F.col("value")) != "")
    opened = filled.withColumn("_envelope", json_envelope(F.col("value"))).withColumn(
        "_parsed", open_envelope(F.col("_envelope"))
    )
    fields = opened.withColumn("_fields", F.try_variant_get("_parsed", "$", "map<string,variant>"))
    typed = _typed(F.col("_parsed"), schema)
    # Fields that their column holds whole; a JSON null is a null column.
    held = [
        F.when(
            column.isNotNull() | F.coalesce(F.is_variant_null(F.try_element_at("_fields", F.lit(name))), F.lit(True)),
            F.lit(name),
        )
        for name, column in typed.items()
    ]
    known = F.array_compact(F.array(*held)) if held else F.array().cast("array<string>")
    rows = fields.where(F.col("_fields").isNotNull()).select(
        *[column.alias(name) for name, column in typed.items()],
        F.map_filter("_fields", lambda k, v: ~F.array_contains(known, k)).alias("extra"),
        *where,
    )
    bad = fields.where(F.col("_fields").isNull()).select(*where, "value")
    return rows, bad


def as_bad_lines(bad: DataFrame) -> DataFrame:
    """Undecodable lines as failed records: 1-based line, file, error."""
    numbered = [(F.col("line") + 1).alias("line")] if "line" in bad.columns else []
    return bad.select(*numbered, "file", F.lit(fixed.BAD_LINE).alias("error"))


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    numbered: bool = False,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scan JSONL into ``(rows, bad)`` with ``file`` and ``position``, see :func:`parse_lines`.

    ``position`` orders the lines of a file. ``numbered=True`` gives ``line`` instead, for
    rows without ids, and reads the files a second time to count lines. ``partitions``
    spreads the lines by a shuffle: compressed files are read by one task each.
    """
    return _read(scan_lines(spark, path), schema, numbered, partitions)


def read_jsonl_dir(
    spark: SparkSession,
    path: str,
    glob: str,
    schema: T.StructType | str,
    numbered: bool = False,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scan the files of a folder whose name matches ``glob``; (file, position) is their order."""
    return _read(scan_lines(spark, path, glob), schema, numbered, partitions)


def _read(
    lines: DataFrame, schema: T.StructType | str, numbered: bool, partitions: int | None
) -> tuple[DataFrame, DataFrame]:
    if numbered:
        placed = number_lines(lines)
    else:
        placed = lines.select("value", "file", F.struct("block", "row").alias("position"))
    return parse_lines(placed if partitions is None else placed.repartition(partitions), schema)
