"""JSONL, shard, CSV, statistics and quarantine sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators import scoring
from ..operators.analysis import explode_scores
from ..session import ROW, Counters
from .jsonl import read_jsonl

# Where a row was read is not part of the row.
_POSITION = ("file", "line", "position")


def json_line(df: DataFrame) -> Column:
    """A row as one JSON object: null fields left out, ``extra`` fields put back in."""
    names = [c for c in df.columns if c not in (*_POSITION, "extra", ROW)]
    return json_object([F.col(c) for c in names], "extra" in df.columns)


def json_object(columns: Sequence[Column], extra: bool = False) -> Column:
    own = F.to_json(F.struct(*columns)) if columns else F.lit("{}")
    if not extra:
        return own
    joined = F.concat(
        F.left(own, F.length(own) - 1),
        F.when(own == "{}", F.lit("")).otherwise(F.lit(",")),
        F.substr(F.to_json("extra"), F.lit(2)),
    )
    return F.when(F.size("extra") > 0, joined).otherwise(own)


def write_jsonl(
    df: DataFrame, path: str, mode: str = "errorifexists", order_by: Sequence[str] = ()
) -> None:
    """One JSON object per line, UTF-8, characters unescaped.

    ``order_by`` sorts the whole output over its files (a range shuffle), which is only
    worth it where someone reads them in order.
    """
    ordered = df.orderBy(*order_by) if order_by else df
    ordered.select(json_line(df).alias("value")).write.mode(mode).text(path)


def write_shards(
    df: DataFrame, path: str, shard: Column, shards: int, mode: str = "errorifexists"
) -> DataFrame:
    """One folder per shard number below ``shards``; returns their manifest :data:`MANIFEST`.

    ``rebalance`` lets the adaptive plan split a shard that holds much of the data over
    several tasks (and files) instead of sending it to one. ``df`` is evaluated once: rows are
    counted by the job that writes them, files and bytes are read off what it committed. The
    manifest is kept with the shards, for :func:`check_shards`.
    """
    lines = df.select(json_line(df).alias("value"), shard.cast("int").alias("shard"))
    counts = {f"n{i}": F.count_if(F.col("shard") == i) for i in range(shards)}
    counters = Counters(total=F.count(F.lit(1)), **counts)
    dealt = counters.watch(lines.hint("rebalance", F.col("shard")))
    dealt.write.mode(mode).partitionBy("shard").text(path)
    seen = counters.values()
    if sum(seen[name] for name in counts) != seen["total"]:
        raise ValueError(f"rows without a shard from 0 to {shards - 1} in {path}")
    spark = df.sparkSession
    rows = [F.struct(F.lit(i).alias("shard"), F.lit(seen[f"n{i}"]).cast("bigint").alias("rows")) for i in range(shards)]
    rows = spark.range(1).select(F.inline(F.array(*rows))).where("rows > 0")
    committed = _committed(spark, path)
    rows.join(committed, "shard", "left").write.mode("overwrite").json(f"{path}/_manifest")
    return read_manifest(spark, path)


#: A shard's rows, and the files and bytes that hold them.
MANIFEST = "shard int, rows bigint, files bigint, bytes bigint"


def _committed(spark: SparkSession, path: str) -> DataFrame:
    """``shard, files, bytes`` of the shard files under ``path``; their content is not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    if "shard" not in listed.columns:
        return spark.createDataFrame([], "shard int, files bigint, bytes bigint")
    return listed.groupBy(F.col("shard").cast("int").alias("shard")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{path}/_manifest")


def check_shards(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of shards whose files are still those that were written. One that lost or
    gained a file or a byte fails, with its number, before any row of it is used."""
    listed = _committed(spark, path).select("shard", F.col("files").alias("_files"), F.col("bytes").alias("_bytes"))
    both = read_manifest(spark, path).join(listed, "shard", "full")
    same = F.col("files").eqNullSafe(F.col("_files")) & F.col("bytes").eqNullSafe(F.col("_bytes"))
    wrong = [r.shard for r in both.where(~same).select("shard").orderBy("shard").limit(20).collect()]
    if wrong:
        raise ValueError(f"shards {wrong} of {path} differ from their manifest")
    return read_manifest(spark, path)


def read_shards(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """:func:`~replyloom.sources.read_jsonl` of shards that :func:`check_shards` has passed."""
    check_shards(spark, path)
    return read_jsonl(spark, path, schema)


def shard_counts(shards: DataFrame) -> DataFrame:
    return shards.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))


def split_report(rows: DataFrame, bad: DataFrame) -> DataFrame:
    """One row: lines read, rows written to shards, undecodable lines."""
    status = rows.select(F.lit(True).alias("ok")).unionAll(bad.select(F.lit(False).alias("ok")))
    return status.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("ok").alias("written"),
        F.count_if(~F.col("ok")).alias("invalid_json"),
    )


def score_rows(aggregated: DataFrame) -> DataFrame:
    """One row per (sample, output) with the columns of the CSV export."""
    exploded = explode_scores(aggregated).withColumn("sample_idx", F.col("original_idx"))
    return exploded.select(*fixed.CSV_COLUMNS)


def scores_to_csv(aggregated: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header; quotes are doubled, line breaks stay inside quotes."""
    score_rows(aggregated).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_stats(stats: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A statistics frame (a few rows by construction) as one JSON file."""
    stats.coalesce(1).write.mode(mode).json(path)


def write_split(
    scored: DataFrame, path: str, mode: str = "errorifexists", response: str = "response"
) -> DataFrame:
    """Scored and quarantined rows in one write, to the folders ``outcome=ok`` and
    ``outcome=failed``; returns :func:`~replyloom.operators.scoring.run_report` of them.

    ``scored`` is evaluated once, whatever it costs: each row becomes the JSON object of its
    outcome (see :func:`~replyloom.operators.scoring.ok_rows` and ``failed_rows``) and the job that
    writes also counts. :func:`read_split` reads one of the two.
    """
    hidden = {"extracted", "error", "prompt", "extra", ROW, response, *_POSITION}
    good = json_object([F.col(c) for c in scored.columns if c not in hidden], "extra" in scored.columns)
    bad = json_object(scoring.failed_columns(scored, response))
    counters = Counters(**scoring.outcome_counts())
    ok = F.col("error").isNull()
    lines = counters.watch(scored).select(
        F.when(ok, good).otherwise(bad).alias("value"), F.when(ok, OUTCOMES[0]).otherwise(OUTCOMES[1]).alias("outcome")
    )
    lines.write.mode(mode).partitionBy("outcome").text(path)
    return scoring.report_of(counters.row())


OUTCOMES = ("ok", "failed")


def read_split(spark: SparkSession, path: str, schema: str, outcome: str) -> DataFrame:
    """Rows of one outcome; reads its folder only, and nothing where there is none."""
    if outcome not in OUTCOMES:
        raise ValueError(f"unknown outcome: {outcome}")
    rows = spark.read.schema(f"{schema}, outcome string").json(path)
    return rows.where(F.col("outcome") == outcome).drop("outcome")
