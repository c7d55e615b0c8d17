"""Joins and deduplication by key. All joins are equi-joins.

Text is never broadcast on request: Spark decides from sizes. A key that holds much of
one side is split by the adaptive skew join, since nothing after these joins asks for
the join's partitioning; null keys are spread on purpose.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import conversations as C
from ..functions import fixed_values as fixed
from ..functions.prompts import is_short
from ..functions.text import py_strip, strip_think_tokens
from ..session import ROW, Counters, materialize, number_rows
from .records import compute_once, optional, with_original_idx

NULL_KEY_SPREAD = 1024


def keep_one(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    last: bool = False,
    empty_is_key: bool = False,
) -> DataFrame:
    """The first (or last) row of each key; rows without a key all stay, unless the empty key
    is one like any other.

    ``order_by`` identifies a row. Only keys and positions are aggregated, with partial
    aggregation, so a key may have any number of copies; the rows are then matched by key
    *and* position, which no two rows share. A position may be null, which is the lowest;
    rows that agree in key and position stay together.
    """
    position = F.struct(*order_by)
    keyed = F.coalesce(F.col(key).cast("string"), F.lit(""))
    narrow = df.select(keyed.alias("_key"), position.alias("_position"))
    solo = F.when((F.col("_key") == "") & F.lit(not empty_is_key), F.col("_position"))
    pick = F.max if last else F.min
    kept = (
        narrow.groupBy("_key", solo.alias("_solo")).agg(pick("_position").alias("_position")).drop("_solo")
    )
    rows = df.withColumn("_key", keyed).withColumn("_position", position)
    return rows.join(kept, ["_key", "_position"], "left_semi").select(*df.columns)


def merge_shards(
    df: DataFrame, order_by: Sequence[str] = ("file", "line"), dedup: bool = True
) -> DataFrame:
    """Union of shard rows; of rows with the same ``id`` the first in file and line order stays."""
    return keep_one(df, "id", order_by) if dedup else df


def merge_report(df: DataFrame, bad: DataFrame | None = None) -> DataFrame:
    """One row: written, duplicate and undecodable rows of :func:`merge_shards`."""
    key = F.coalesce(F.col("id"), F.lit(""))
    per_id = df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    written = F.sum(F.when(F.col("_key") == "", F.col("n")).otherwise(1))
    counted = per_id.agg(
        F.coalesce(written, F.lit(0)).alias("written"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.coalesce(written, F.lit(0))).alias("duplicate"),
    )
    bad_rows = bad.agg(F.count(F.lit(1))).scalar() if bad is not None else F.lit(0).cast("bigint")
    return counted.withColumn("bad_json", bad_rows)


POSITIONS = (("file", "line"), ("file", "position"), ("line",))


def one_per_key(df: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """The last row of each key, the empty one included.

    The order is ``order_by``, else where the rows were read. Rows that do not know where
    they were read are ordered by their hash, and of equal rows one stays; they are written
    once with their hash and number, so that both are decided on these alone.
    """
    known = next((p for p in POSITIONS if set(p) <= set(df.columns)), None)
    if order_by or known:
        return keep_one(df, key, order_by or known, last=True, empty_is_key=True)
    hashable = [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    placed = number_rows(df.withColumn("_hash", F.xxhash64(*hashable)), "sources")
    keyed = F.coalesce(F.col(key).cast("string"), F.lit(""))
    last = placed.groupBy(keyed.alias("_key")).agg(F.max(F.struct("_hash", ROW)).alias("_last"))
    kept = last.select(F.col(f"_last.{ROW}").alias(ROW))
    return placed.join(kept, ROW, "left_semi").select(*df.columns)


def _answers(output: DataFrame, clean: Callable[[Column], Column]) -> DataFrame:
    """``id, _response``: cleaned responses, empty where there is nothing left."""
    cleaned = F.coalesce(clean(F.col("response")), F.lit(""))
    return compute_once(output.select("id", "response"), _response=cleaned).select("id", "_response")


def _answered() -> Column:
    return F.col("_response") != ""


def merge_stage1(
    source: DataFrame, output: DataFrame, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Put each non-empty response into its source row; output without a source stays.

    Where an id is repeated, the empty one included, its last source wins, in the order
    that :func:`one_per_key` describes: there are as many rows as responses.
    """
    merged = _merged_stage1(source, output, order_by).where(_answered())
    return merged.drop("_response")


def _merged_stage1(source: DataFrame, output: DataFrame, order_by: Sequence[str] | None) -> DataFrame:
    answers = _answers(output, py_strip)
    carried = [c for c in source.columns if c not in ("id", "question")]
    merged = answers.join(one_per_key(source, "id", order_by).select("id", *carried), "id", "left")
    return merged.withColumn(
        "conversations", C.replace_last_assistant(F.col("conversations"), F.col("_response"))
    ).select("id", *carried, "_response")


def merge_stage2(
    source: DataFrame,
    output: DataFrame,
    ratio: float = fixed.MIN_LENGTH_RATIO,
    floor: int = fixed.MIN_LENGTH_FLOOR,
    fallback: bool = True,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Delivery rows ``id, conversations, replaced_short`` from responses and their sources.

    Responses lose their think markup; one that comes out too short is replaced by the
    cleaned source text. Sources with one id are taken as in :func:`merge_stage1`.
    """
    merged = _merged_stage2(source, output, ratio, floor, fallback, order_by).where(_answered())
    return merged.drop("_response")


def _merged_stage2(
    source: DataFrame, output: DataFrame, ratio: float, floor: int, fallback: bool, order_by: Sequence[str] | None
) -> DataFrame:
    answers = _answers(output, strip_think_tokens)
    text = F.coalesce(strip_think_tokens(optional(source, "thinking_answer_text")), F.lit(""))
    texts = one_per_key(source, "id", order_by).select("id", "conversations", text.alias("_source"))
    merged = answers.join(texts, "id", "left").withColumn(
        "_source", F.coalesce("_source", F.lit(""))
    )
    short = is_short(F.col("_response"), F.col("_source"), ratio, floor) & F.lit(fallback)
    gated = merged.withColumn("replaced_short", short)
    answer = F.when(F.col("replaced_short"), F.col("_source")).otherwise(F.col("_response"))
    return gated.select(
        "id",
        C.delivery_conversations(F.col("conversations"), answer).alias("conversations"),
        "replaced_short",
        "_response",
    )


def merge_stage1_counted(
    source: DataFrame, output: DataFrame, order_by: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """:func:`merge_stage1` written once, and its :func:`merge_stage_report` from the same job."""
    return _written_merge(_merged_stage1(source, output, order_by))


def merge_stage2_counted(
    source: DataFrame,
    output: DataFrame,
    ratio: float = fixed.MIN_LENGTH_RATIO,
    floor: int = fixed.MIN_LENGTH_FLOOR,
    fallback: bool = True,
    order_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """:func:`merge_stage2` written once, and its :func:`merge_stage_report` from the same job."""
    merged = _merged_stage2(source, output, ratio, floor, fallback, order_by)
    return _written_merge(merged, short_replaced=F.count_if(F.col("replaced_short") & _answered()))


def _written_merge(merged: DataFrame, **more: Column) -> tuple[DataFrame, DataFrame]:
    # Skipped responses come along to the writing stage, where they are counted.
    counters = Counters(written=F.count_if(_answered()), skipped_empty=F.count_if(~_answered()), **more)
    written = materialize(counters.watch(merged).where(_answered()).drop("_response"), "merged")
    return written, counters.row()


def merge_stage_report(output: DataFrame, merged: DataFrame, think: bool = False) -> DataFrame:
    """One row: responses, those skipped as empty, those replaced as too short."""
    clean = strip_think_tokens if think else py_strip
    empty = F.coalesce(clean(F.col("response")), F.lit("")) == ""
    marked = compute_once(output.select("response"), empty=empty)
    counted = marked.agg(
        F.count_if(~F.col("empty")).alias("written"),
        F.count_if(F.col("empty")).alias("skipped_empty"),
    )
    if "replaced_short" not in merged.columns:
        return counted
    short = merged.agg(F.count_if(F.col("replaced_short"))).scalar()
    return counted.withColumn("short_replaced", short)


def join_responses(
    prepared: DataFrame,
    responses: DataFrame,
    keys: Sequence[str] = ("original_idx", "output_idx"),
) -> DataFrame:
    """Prepared rows with their response, matched by key."""
    return prepared.join(responses.select(*keys, "response"), list(keys))


def _join_key(key: Column, spread: Column) -> Column:
    return F.struct(key.alias("key"), spread.cast("bigint").alias("spread"))


def enrich_with_conversations(scores: DataFrame, original: DataFrame) -> DataFrame:
    """Add ``conversations`` by ``original_idx``; rows without a match or key stay as they are.

    ``original`` has ``original_idx`` (or ``line``) and ``conversations``; of repeated keys the
    last row counts. A row without a key matches nothing wherever it is sent, so the join's key holds a hash of the row
    for it, which spreads such rows evenly.
    """
    key = F.col("original_idx")
    usable = with_original_idx(original).where((F.size("conversations") > 0) & key.isNotNull())
    texts = one_per_key(usable, "original_idx").select(_join_key(key, F.lit(0)).alias("_join"), "conversations")
    kept = scores.drop("conversations")
    hashable = [c for c, t in kept.dtypes if "map<" not in t and "variant" not in t]
    row_hash = F.pmod(F.xxhash64(*hashable), F.lit(NULL_KEY_SPREAD))
    number = F.col("original_idx").cast("bigint")
    spread = F.when(number.isNull(), row_hash).otherwise(0)
    keyed = kept.withColumn("_join", _join_key(number, spread))
    return keyed.join(texts, "_join", "left").drop("_join")


def enrich_report(enriched: DataFrame) -> DataFrame:
    """One row: enriched and missing rows among those with a key, rate in percent."""
    keyed = enriched.where(F.col("original_idx").isNotNull())
    counted = keyed.agg(
        F.count_if(F.col("conversations").isNotNull()).alias("enriched"),
        F.count_if(F.col("conversations").isNull()).alias("missing"),
    )
    total = F.col("enriched") + F.col("missing")
    return counted.withColumn("rate", F.try_divide(F.col("enriched") * 100.0, total))


def succeeded(done: DataFrame) -> DataFrame:
    """Rows of an earlier run without those that are to be tried again."""
    return done.where(F.col("_status") == "success") if "_status" in done.columns else done


def pending(
    df: DataFrame, done: DataFrame, keys: Sequence[str] = ("id",), retry_failed: bool = True
) -> DataFrame:
    """Rows whose key is not done yet. Failed rows count as not done unless told otherwise.

    Null keys never match, so rows without a key are always pending.
    """
    if retry_failed:
        done = succeeded(done)
    # distinct: copies of a key are merged before they are sent, in the join's own shuffle.
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")
