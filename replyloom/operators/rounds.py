"""Multi-turn runs in rounds: one written frame per turn, made by one job.

All conversations that go on are asked together, and a turn's replies, callback state and next
prompts are written before the next turn begins. A lost executor repeats calls of one turn, a run
that breaks off begins again with the turn it was at. The frontier shrinks: a turn reads only
conversations that the turn before left open.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import envelopes
from ..session import ROW, file_exists, new_path
from .inference import Backend, RetryPolicy, TurnCallback, _kept, _pooled, _requests, replies_columns, reply_text

_TURN = "replies array<string>, state string, next string, error string"


def multi_turn_rounds(
    df: DataFrame,
    backend: Backend,
    callback: TurnCallback,
    max_turns: int = 10,
    params: Mapping[str, Any] | None = None,
    *,
    policy: RetryPolicy = RetryPolicy(),
    concurrency: int = 64,
    partitions: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """:func:`~replyloom.operators.inference.multi_turn_infer`, turn by turn.

    ``callback``'s state is kept as JSON between turns, so it has to be a value that JSON can
    hold. ``folder`` names where the turns are written; what an earlier run over the same input
    has completed there is read instead of made again. Conversations of which a call failed are
    left out.
    """
    spark = df.sparkSession
    folder = folder or new_path(spark, "turns")
    ready, (prompt, _, sent) = _requests(df, params, "", partitions)
    asked = ready.select(*_kept(df), prompt.alias("_prompt"), sent.alias("_sent"), F.monotonically_increasing_id().alias(ROW))
    source = _written(spark, asked, f"{folder}/source")

    nothing = F.array().cast("array<string>")
    open_rows = source.select(ROW, "_sent", F.col("_prompt").alias("_next"), nothing.alias("_replies"), F.lit("{}").alias("_state"))
    turn = _turn_column(backend, callback, policy, concurrency)
    finished: DataFrame | None = None
    for number in range(max_turns):
        called = open_rows.withColumn("_turn", turn("_next", "_sent", "_replies", "_state"))
        step = called.select(
            ROW, "_sent", *[F.col(f"_turn.{c}").alias(f"_{c}") for c in ("replies", "state", "next", "error")]
        )
        step = _written(spark, step, f"{folder}/turn-{number:05d}")
        open_rows = step.where("_error is null and _next is not null").drop("_error")
        ended = step.where("_error is null" + ("" if number == max_turns - 1 else " and _next is null"))
        ended = ended.select(ROW, "_replies")
        finished = ended if finished is None else finished.unionAll(ended)
        if open_rows.isEmpty():
            break
    if finished is None:
        finished = open_rows.where("false").select(ROW, "_replies")
    joined = source.drop("_prompt", "_sent").join(finished, ROW)
    parsed = joined.withColumn("_replies", F.transform("_replies", envelopes.read_reply))
    return parsed.select(*_kept(df), *replies_columns())


def _written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """``df`` as it stands in ``path``, written there unless an earlier run has done so."""
    if not file_exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _turn_column(backend: Backend, callback: TurnCallback, policy: RetryPolicy, concurrency: int):
    """Nondeterministic Arrow UDF that makes one call per row and asks ``callback`` what follows."""

    @F.pandas_udf(_TURN)
    def turns(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from _pooled(batches, backend, concurrency, submit, results)

    def submit(pool, batch):
        return [pool.submit(one, *row) for row in zip(*batch)]

    def results(calls):
        return pd.DataFrame([call.result() for call in calls], columns=["replies", "state", "next", "error"])

    def one(prompt: str | None, sent: str | None, before: Any, state: str) -> dict:
        try:
            reply = policy.run(lambda p: backend.generate(prompt or "", None, p), json.loads(sent or "{}"))
            replies = [*before, json.dumps(reply, ensure_ascii=False)]
            texts = [reply_text(json.loads(r)) for r in replies]
            go_on, following, state = callback(texts, json.loads(state))
            return {"replies": replies, "state": json.dumps(state), "next": following if go_on else None, "error": None}
        except Exception as error:  # a failing row must not fail the turn
            return {"replies": list(before), "state": state, "next": None, "error": str(error)}

    return turns.asNondeterministic()
