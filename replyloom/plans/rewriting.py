"""The two answer stages: ask a thinking model, then have its answers rewritten."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from ..functions import fixed_values as fixed
from ..functions.prompts import Template
from ..operators import inference, matching, records
from .judging import infer_pending


def run_stage1(
    df: DataFrame,
    backend: inference.Backend,
    *,
    template: Template = None,
    params: Mapping[str, Any] = fixed.STAGE1_PARAMS,
    prepared: DataFrame | None = None,
    done: DataFrame | None = None,
    merge_only: bool = False,
    order_by: Sequence[str] | None = None,
    **options: Any,
) -> DataFrame:
    """Questions to answered conversations ``id, conversations``.

    ``prepared``, ``done`` and ``merge_only`` reuse what an earlier run has written.
    """
    source = records.with_row_id(records.normalize_stage1(df))
    if prepared is None:
        prepared = records.prepare_stage1(source, template)
    responses = done if merge_only else infer_pending(prepared, backend, params, ["id"], done, **options)
    return matching.merge_stage1(source, responses, order_by)


def run_stage2(
    stage1: DataFrame,
    backend: inference.Backend,
    *,
    template: Template = None,
    params: Mapping[str, Any] = fixed.STAGE2_PARAMS,
    ratio: float = fixed.MIN_LENGTH_RATIO,
    floor: int = fixed.MIN_LENGTH_FLOOR,
    fallback: bool = True,
    prepared: DataFrame | None = None,
    done: DataFrame | None = None,
    merge_only: bool = False,
    merge_by: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    **options: Any,
) -> DataFrame:
    """Answered conversations to delivery rows ``id, conversations, replaced_short``.

    ``merge_by`` names the columns that order repeated ids of several stage-1 shards (the
    first wins); of sources that still share an id the last in ``order_by`` counts, see
    :func:`~replyloom.operators.matching.one_per_key`. Drop ``id`` and ``replaced_short`` at the sink.
    """
    merged = matching.merge_shards(stage1, merge_by) if merge_by else stage1
    source = records.normalize_stage2(merged)
    if prepared is None:
        prepared = records.prepare_stage2(source, template)
    responses = done if merge_only else infer_pending(prepared, backend, params, ["id"], done, **options)
    return matching.merge_stage2(source, responses, ratio, floor, fallback, order_by)
