"""Judge runs: candidates to scores, responses to best and worst answers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.prompts import Template
from ..operators import analysis, inference, matching, records, scoring
from ..session import ROW, materialize, materialize_counted
from ..sources.jsonl import as_bad_lines

JUDGE_KEYS = ("original_idx", "output_idx")


def infer_pending(
    prepared: DataFrame,
    backend: inference.Backend,
    params: Mapping[str, Any],
    keys: Sequence[str],
    done: DataFrame | None = None,
    **options: Any,
) -> DataFrame:
    """Written ``keys, response, _status, _error`` for the prepared rows that ``done`` lacks, plus
    those of ``done`` that are not tried again. Failed calls have an error and no response.

    The model sees only keys and prompt. The new responses are written once, so that
    nothing derived from them calls the model again.
    """
    columns = [*keys, "response", "_status", "_error"]
    todo = prepared.select(*keys, "prompt")
    if done is not None:
        todo = matching.pending(todo, done, keys)
    asked = inference.batch_infer(todo, backend, params, on_error="keep", **options)
    fresh = materialize(asked.select(*columns), "responses")
    if done is None:
        return fresh
    return earlier(done, keys).unionByName(fresh)


def earlier(done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Responses of an earlier run that count as done, in the columns of a new one."""
    return matching.succeeded(done).select(
        *keys, "response", F.lit("success").alias("_status"), F.lit(None).cast("string").alias("_error")
    )


def run_judge(
    df: DataFrame,
    backend: inference.Backend,
    *,
    n_examples: int = 8,
    prefix: str = "output_",
    template: Template = None,
    params: Mapping[str, Any] = fixed.JUDGE_PARAMS,
    prepared: DataFrame | None = None,
    done: DataFrame | None = None,
    merge_only: bool = False,
    **options: Any,
) -> tuple[DataFrame, DataFrame]:
    """Prepare, judge, extract strictly: ``(scores per question, failed rows)``.

    Of rows that share an ``original_idx`` the last counts, see
    :func:`~replyloom.operators.matching.one_per_key`. ``prepared`` reuses written prompts, one
    per key; ``done`` holds responses of an earlier run, of which one per key counts, and with
    ``merge_only`` no others are asked for. Calls that failed are failed rows, with the error of
    the call.
    """
    given = prepared
    # Of rows that share an original_idx one is prepared, judged and reported.
    source = matching.one_per_key(records.with_original_idx(df), "original_idx")
    if done is not None:
        done = matching.succeeded(done).groupBy(*JUDGE_KEYS).agg(F.max("response").alias("response"))
    if prepared is None:
        prepared = records.prepare_judge(source, n_examples, prefix, template)
    if merge_only:
        responses = earlier(done, JUDGE_KEYS)
    else:
        responses = infer_pending(prepared, backend, params, JUDGE_KEYS, done, **options)
    if done is not None:
        # New responses are to prepared rows by construction, earlier ones are matched by key.
        responses = responses.join(prepared.select(*JUDGE_KEYS), list(JUDGE_KEYS), "left_semi")

    def of_failed(failed: DataFrame) -> DataFrame:
        # Prompts are the largest texts here: render them for failed rows only.
        concerned = source.join(failed.select("original_idx").distinct(), "original_idx", "left_semi")
        return records.prepare_judge(concerned, n_examples, prefix, template)

    return judge_results(source, given if given is not None else of_failed, responses, prefix)


def judge_results(
    source: DataFrame,
    prepared: DataFrame | Callable[[DataFrame], DataFrame],
    responses: DataFrame,
    prefix: str = "output_",
) -> tuple[DataFrame, DataFrame]:
    """``(scores per question, failed rows)`` from responses with their call's ``_error``.

    Scores need no texts of the prepared rows: each question's own come once from the source,
    not once per candidate. ``prepared`` may be a function of the failed rows.
    """
    called = responses.select(*JUDGE_KEYS, "response", F.col("_error").alias("_call_error"))
    scored = scoring.score_responses(called, "strict")
    scored = scored.withColumn("error", F.coalesce("_call_error", "error")).drop("_call_error")
    known = scored.where(F.col("error").isNull()).select(*JUDGE_KEYS, "scores")
    scores = analysis.aggregate_scores(known, prefix, context=records.judge_context(source))
    failed = scoring.failed_prepared(scored)
    if callable(prepared):
        prepared = prepared(failed)
    return scores, failed.join(prepared, list(JUDGE_KEYS))


@dataclass(frozen=True)
class PreferenceResult:
    """Frames over one written set of scored responses."""

    scored: DataFrame
    failed: DataFrame
    best_worst: DataFrame
    summary: DataFrame
    histogram: DataFrame
    report: DataFrame


def run_preference(
    responses: DataFrame,
    order_by: Sequence[str] = ("output_idx",),
    bad: DataFrame | None = None,
    write: bool = True,
) -> PreferenceResult:
    """Responses to scores, failed rows, best and worst answers and their report.

    ``bad`` holds the undecodable lines of the same files, which join the failed rows. The
    parsed frame is written once, as five frames are read from it, and counted by the job that
    writes; ``write=False`` parses again for each.
    """
    scored = scoring.score_responses(responses, "robust").drop("prompt")
    if write:
        # Only failed rows need what was searched again.
        bad_row = F.col("error").isNotNull()
        seen = {c: F.when(bad_row, F.col(c)) for c in ("response", "extracted")}
        numbered = scored.withColumns(seen).withColumn(ROW, F.monotonically_increasing_id())
        scored, counts = materialize_counted(numbered, "scored", **scoring.outcome_counts())
        report = scoring.report_of(counts, bad)
    else:
        report = scoring.run_report(scored, bad)
    ok, failed = scoring.split_ok_failed(scored)
    if bad is not None:
        failed = failed.unionByName(as_bad_lines(bad), allowMissingColumns=True)
    return PreferenceResult(
        scored=ok.drop(ROW),
        failed=failed,
        best_worst=analysis.best_worst(ok, order_by),
        summary=analysis.best_worst_summary(ok),
        histogram=analysis.score_histogram(ok),
        report=report,
    )
