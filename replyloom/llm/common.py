"""What several operators share: words, row keys, and texts handed to Python as bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but the six ASCII whitespace characters. Python's
#: ``bytes.split()`` splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
OTHER_SPACES = r"[\x09-\x0D]"
SPACE_BYTES = b" \t\n\r\x0b\f"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; of a null, none. Where blanks are the only whitespace, no regular
    expression is needed to split."""
    whole = F.coalesce(text, F.lit(""))
    parts = F.when(whole.rlike(OTHER_SPACES), F.split(whole, SPACES)).otherwise(F.split(whole, " "))
    return F.array_remove(parts, "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; of a null, those of the empty text."""
    return F.md5(F.coalesce(text, F.lit("")))


def mix64(x: np.ndarray) -> np.ndarray:
    """64 bits that depend on all bits of each number (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def join64(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64 bits that stand for pairs of such."""
    return mix64(left * np.uint64(0x9E3779B97F4A7C15) + right)


def map_rows(
    df: DataFrame, function: Callable[[Iterator[dict]], Iterable[tuple]], schema: str
) -> DataFrame:
    """``function`` over the rows of each partition, as dicts; it yields tuples of ``schema``.

    Strings that should arrive as bytes are cast to binary before. Rows stream through in
    Arrow batches both ways, so that a task holds a few batches and no partition.
    """
    empty = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(empty)

        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(0, batch.num_rows, 64):
                    yield from batch.slice(i, 64).to_pylist()

        held: list[tuple] = []
        size = 0
        for out in function(rows()):
            held.append(out)
            size += 1 + sum(len(x) for x in out if isinstance(x, (str, bytes, list))) // 64
            if size >= 4096:
                yield _batch(held, arrow)
                held, size = [], 0
        if held:
            yield _batch(held, arrow)

    return df.mapInArrow(run, empty)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
