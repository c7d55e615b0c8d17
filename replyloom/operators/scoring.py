"""Judge responses to validated scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import scores as S
from ..functions.text import drop_to_last_blank_line, remove_blocks
from .records import compute_once


def score_responses(df: DataFrame, mode: str = "robust", response: str = "response") -> DataFrame:
    """Add ``extracted`` (VARIANT), ``error`` (null if fine) and ``scores`` (null if not).

    Each step is a projection of its own, so that a text is searched and parsed once
    however many columns are read from the result.
    """
    if mode not in ("robust", "strict"):
        raise ValueError(f"unknown mode: {mode}")
    found = _strict(df, F.col(response)) if mode == "strict" else _robust(df, F.col(response))
    extracted, raw = F.col("extracted"), S.score_fields(F.col("extracted"))
    values = {name: F.col(f"_{name}") for name in raw}
    numbers = {name: F.col(f"_{name}_number") for name in raw}
    fields = found.withColumns({f"_{name}": value for name, value in raw.items()})
    fields = fields.withColumns({f"_{name}_number": S.numeric(v) for name, v in values.items()})
    error = S.first_error(extracted, values, numbers, mode == "strict")
    checked = fields.withColumn("_error", error)
    good = F.when(F.col("_error").isNull(), S.score_struct(extracted, numbers))
    scored = compute_once(checked, error=F.col("_error"), scores=good)
    return scored.drop("_error", *[c for name in raw for c in (f"_{name}", f"_{name}_number")])


def _strict(df: DataFrame, text: Column) -> DataFrame:
    tagged = F.col("_tagged")
    steps = df.withColumn("_tagged", S.strict_tag(text))
    steps = steps.withColumn("_tagged", F.when(tagged != "", tagged).otherwise(S.strict_bare(text)))
    steps = steps.withColumn("_tagged", S.json_envelope(tagged))
    return steps.withColumn("extracted", S.open_envelope(tagged)).drop("_tagged")


def _robust(df: DataFrame, text: Column) -> DataFrame:
    tagged, clean, braced = F.col("_tagged"), F.col("_clean"), F.col("_braced")
    steps = df.withColumn("_tagged", S.tag_candidate(text))
    for step in (S.json_envelope, S.open_envelope):
        steps = steps.withColumn("_tagged", step(tagged))
    # Nothing else is searched where the tagged object is good.
    steps = steps.withColumn("_clean", F.when(tagged.isNull(), text))
    for marks in zip(fixed.THINK_BLOCKS, fixed.THINK_OPENINGS, fixed.THINK_CLOSINGS):
        steps = steps.withColumn("_clean", remove_blocks(clean, *marks))
    steps = steps.withColumn("_clean", drop_to_last_blank_line(clean))
    steps = steps.withColumn("_braced", S.brace_candidate(clean))
    for step in (S.json_envelope, S.open_envelope):
        steps = steps.withColumn("_braced", step(braced))
    found = S.robust_object(tagged, braced, clean)
    return steps.withColumn("extracted", found).drop("_clean", "_tagged", "_braced")


def ok_rows(scored: DataFrame) -> DataFrame:
    """Rows of :func:`score_responses` with valid scores, without the response text."""
    return scored.where(F.col("error").isNull()).drop("extracted", "error", "response", "prompt")


def failed_rows(scored: DataFrame, response: str = "response") -> DataFrame:
    """Quarantine: where a row came from, why it failed, what was seen.

    Every row keeps its whole response. A row without a score object also has a preview of
    it, a row with a bad one has the object. Lines are counted from 1 here, as in an editor.
    """
    return scored.where(F.col("error").isNotNull()).select(*failed_columns(scored, response))


def failed_columns(scored: DataFrame, response: str = "response") -> list[Column]:
    absent = F.col("extracted").isNull()
    position = [F.col(c) for c in ("file", "original_idx", "output_idx") if c in scored.columns]
    if "line" in scored.columns:
        position.insert(0, (F.col("line") + 1).alias("line"))
    preview = F.substring(F.coalesce(response, F.lit("")), 1, fixed.PREVIEW_CHARS)
    return [
        *position,
        F.col("error"),
        F.when(absent, preview).alias("response_preview"),
        F.to_json("extracted").alias("extracted_score"),
        F.col(response).alias("raw_response"),
    ]


def failed_prepared(scored: DataFrame, response: str = "response") -> DataFrame:
    """Quarantine of the strict path: the prepared row, the raw response, the error."""
    failed = scored.where(F.col("error").isNotNull())
    return failed.withColumn("extracted_scores", F.to_json("extracted")).withColumnRenamed(
        response, "raw_response"
    ).drop("extracted", "scores")


def split_ok_failed(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(ok, failed)`` of one scored frame; write or cache it first if both are used."""
    return ok_rows(scored), failed_rows(scored)


def run_report(scored: DataFrame, bad: DataFrame | None = None) -> DataFrame:
    """One row: total, success, failed, success_rate in percent (null when empty).

    Undecodable lines in ``bad`` count as failed.
    """
    return report_of(scored.agg(*[c.alias(name) for name, c in outcome_counts().items()]), bad)


def outcome_counts() -> dict[str, Column]:
    """``total, success, failed`` of a scored frame, for an aggregation or for
    :class:`~replyloom.session.Counters` of the job that writes it."""
    failed = F.col("error").isNotNull()
    return {"total": F.count(F.lit(1)), "success": F.count_if(~failed), "failed": F.count_if(failed)}


def report_of(counts: DataFrame, bad: DataFrame | None = None) -> DataFrame:
    """:func:`run_report` from :func:`outcome_counts`; only ``bad`` is read."""
    if bad is not None:
        lines = bad.agg(F.count(F.lit(1))).scalar()
        counts = counts.withColumns({"total": F.col("total") + lines, "failed": F.col("failed") + lines})
    return counts.withColumn("success_rate", F.try_divide(F.col("success") * 100.0, F.col("total")))
