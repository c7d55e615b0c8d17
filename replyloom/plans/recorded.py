"""Runs that know what they have done.

A :class:`RunLedger` holds the outputs of stages with a fingerprint of what they were made from:
inputs, parameters and the stages before. A stage whose fingerprint is there is read, any other is
run; nobody has to say what may be reused.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.prompts import Template
from ..operators import inference, matching, records
from ..session import file_exists
from .judging import JUDGE_KEYS, infer_pending, judge_results

ENTRY = "stage string, fingerprint string, path string, schema string, at timestamp"


def content_fingerprint(df: DataFrame) -> str:
    """A text that stands for the rows of ``df`` in any order: their number and two sums of
    hashes, from one pass without a shuffle of rows."""
    plain = [F.to_json(F.struct(c)) if "map<" in t or "variant" in t else F.col(f"`{c}`") for c, t in df.dtypes]
    hashed = df.select(F.xxhash64(*plain).alias("h"), F.xxhash64(F.lit(1), *plain).alias("g"))
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).cast("string") for c in ("h", "g")]
    row = hashed.agg(F.count(F.lit(1)).cast("string"), *sums).first()
    return _digest([df.dtypes, list(row)])


def _digest(value: Any) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True).encode()).hexdigest()


@dataclass(frozen=True)
class Stage:
    """The written output of a stage and the fingerprint of what it was made from."""

    df: DataFrame
    fingerprint: str
    reused: bool


class RunLedger:
    """Stage outputs and their entries under ``path``.

    An output counts from the moment its entry is written, after the output; what a broken off
    run left without an entry is never read. Entries are rows of a JSON table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        if not file_exists(self.spark, f"{self.path}/entries"):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).json(f"{self.path}/entries")

    def find(self, name: str, fingerprint: str) -> DataFrame | None:
        """The newest output of a stage with this fingerprint."""
        match = (F.col("stage") == name) & (F.col("fingerprint") == fingerprint)
        entry = self.entries().where(match).orderBy(F.desc("at")).first()
        return entry and self.spark.read.schema(entry.schema).parquet(entry.path)

    def record(self, name: str, fingerprint: str, df: DataFrame) -> DataFrame:
        """Write an output, then its entry."""
        path = f"{self.path}/{name}/{fingerprint[:16]}-{uuid4().hex}"
        df.write.parquet(path)
        schema = df.schema.toDDL()
        values = {"stage": name, "fingerprint": fingerprint, "path": path, "schema": schema}
        entry = self.spark.range(1).select(
            *[F.lit(v).alias(k) for k, v in values.items()], F.current_timestamp().alias("at")
        )
        entry.write.mode("append").json(f"{self.path}/entries")
        return self.spark.read.schema(schema).parquet(path)

    def stage(
        self,
        name: str,
        build: Callable[[], DataFrame],
        inputs: Sequence[DataFrame | Stage] = (),
        params: Mapping[str, Any] | None = None,
        again: Callable[[DataFrame], DataFrame | None] = lambda found: None,
    ) -> Stage:
        """The output of ``build`` from ``inputs`` and ``params``, which JSON has to hold.

        ``again`` may complete an output that was found (calls that failed): it gets that output
        and returns a new one, or None if nothing is open.
        """
        marks = [i.fingerprint if isinstance(i, Stage) else content_fingerprint(i) for i in inputs]
        fingerprint = _digest([name, marks, dict(params or {})])
        found = self.find(name, fingerprint)
        more = build() if found is None else again(found)
        if more is None:
            return Stage(found, fingerprint, True)
        return Stage(self.record(name, fingerprint, more), fingerprint, False)


def _responses(
    ledger: RunLedger,
    name: str,
    prepared: Stage,
    backend: inference.Backend,
    model: str,
    params: Mapping[str, Any],
    keys: Sequence[str],
    options: Mapping[str, Any],
) -> Stage:
    """Replies to prepared rows; rows whose calls failed in an earlier run are asked again."""

    def ask(done: DataFrame | None = None) -> DataFrame:
        return infer_pending(prepared.df, backend, params, keys, done, **options)

    def failed_again(found: DataFrame) -> DataFrame | None:
        return None if matching.succeeded(found).count() == found.count() else ask(found)

    return ledger.stage(name, ask, [prepared], {"model": model, "params": dict(params)}, failed_again)


def record_stage1(
    ledger: RunLedger,
    df: DataFrame,
    backend: inference.Backend,
    model: str,
    *,
    template: Template = None,
    params: Mapping[str, Any] = fixed.STAGE1_PARAMS,
    order_by: Sequence[str] | None = None,
    **options: Any,
) -> Stage:
    """:func:`~replyloom.plans.rewriting.run_stage1` by the ledger. ``model`` names the backend;
    a template has to be a pair of texts."""
    source = ledger.stage("stage1-source", lambda: records.with_row_id(records.normalize_stage1(df)), [df])
    prepared = ledger.stage(
        "stage1-prepared", lambda: records.prepare_stage1(source.df, template), [source], {"template": template}
    )
    responses = _responses(ledger, "stage1-responses", prepared, backend, model, params, ["id"], options)
    return ledger.stage(
        "stage1-merged",
        lambda: matching.merge_stage1(source.df, responses.df, order_by),
        [source, _versioned(responses)],
        {"order_by": order_by and list(order_by)},
    )


def record_stage2(
    ledger: RunLedger,
    stage1: DataFrame | Stage,
    backend: inference.Backend,
    model: str,
    *,
    template: Template = None,
    params: Mapping[str, Any] = fixed.STAGE2_PARAMS,
    ratio: float = fixed.MIN_LENGTH_RATIO,
    floor: int = fixed.MIN_LENGTH_FLOOR,
    fallback: bool = True,
    order_by: Sequence[str] | None = None,
    **options: Any,
) -> Stage:
    """:func:`~replyloom.plans.rewriting.run_stage2` by the ledger: another length gate merges
    again, another template or model asks again."""
    rows = stage1.df if isinstance(stage1, Stage) else stage1
    source = ledger.stage("stage2-source", lambda: records.normalize_stage2(rows), [stage1])
    prepared = ledger.stage(
        "stage2-prepared", lambda: records.prepare_stage2(source.df, template), [source], {"template": template}
    )
    responses = _responses(ledger, "stage2-responses", prepared, backend, model, params, ["id"], options)
    return ledger.stage(
        "stage2-merged",
        lambda: matching.merge_stage2(source.df, responses.df, ratio, floor, fallback, order_by),
        [source, _versioned(responses)],
        {"ratio": ratio, "floor": floor, "fallback": fallback, "order_by": order_by and list(order_by)},
    )


def record_judge(
    ledger: RunLedger,
    df: DataFrame,
    backend: inference.Backend,
    model: str,
    *,
    n_examples: int = 8,
    prefix: str = "output_",
    template: Template = None,
    params: Mapping[str, Any] = fixed.JUDGE_PARAMS,
    **options: Any,
) -> tuple[DataFrame, DataFrame]:
    """:func:`~replyloom.plans.judging.run_judge` by the ledger."""
    source = ledger.stage("judge-source", lambda: matching.one_per_key(records.with_original_idx(df), "original_idx"), [df])
    shape = {"n_examples": n_examples, "prefix": prefix, "template": template}
    prepared = ledger.stage(
        "judge-prepared", lambda: records.prepare_judge(source.df, n_examples, prefix, template), [source], shape
    )
    responses = _responses(ledger, "judge-responses", prepared, backend, model, params, JUDGE_KEYS, options)
    return judge_results(source.df, prepared.df, responses.df, prefix)


def _versioned(responses: Stage) -> Stage:
    """Responses that were completed later are another input for what is merged from them."""
    failed = responses.df.count() - matching.succeeded(responses.df).count()
    return Stage(responses.df, _digest([responses.fingerprint, failed]), responses.reused)
