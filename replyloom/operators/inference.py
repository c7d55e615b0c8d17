"""Model calls as a table operator.

Spark partitions the rows, retries lost tasks and carries all other columns past Python:
only prompt, messages and parameters cross to the worker, as Arrow batches. The model is
a :class:`Backend`. Filter and select before these operators; write the result
(:func:`replyloom.session.materialize`) before using it more than once.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections import deque
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import envelopes
from ..functions import fixed_values as fixed
from .records import merge_sampling_params, optional, with_messages


class BackendError(Exception):
    """A failed call; ``status`` is the HTTP status where there is one."""

    def __init__(self, text: str, status: int | None = None):
        super().__init__(text)
        self.status = status


class Backend:
    """A model. One instance is opened per partition, in the worker that uses it.

    ``generate`` returns the raw reply: ``{"text": …, "meta_info": …}`` or a chat reply
    ``{"choices": …, "usage": …}``. It may be called from several threads.
    """

    def open(self) -> None: ...

    def close(self) -> None: ...

    def generate(self, prompt: str, messages: list | None, params: dict) -> dict:
        raise NotImplementedError

    def generate_many(
        self, prompts: list[str], messages: list[list | None], params: dict
    ) -> list[dict | Exception]:
        """Replies to several requests with the same parameters, in their order.

        A model that answers batches overrides this. An exception among the replies fails that
        request alone; one that is raised fails the call, which is then tried in halves.
        """
        return [self.generate(p, m, params) for p, m in zip(prompts, messages, strict=True)]


class ChatBackend(Backend):
    """A ``/chat/completions`` endpoint. ``send`` can be replaced, for instance in tests."""

    def __init__(
        self,
        base_url: str,
        model: str,
        api_key: str = "",
        timeout: float = 6000,
        send: Callable[[str, dict, dict, float], dict] | None = None,
    ):
        self.url = f"{base_url}/chat/completions"
        self.model, self.api_key, self.timeout = model, api_key, timeout
        self.send = send or post_json

    def generate(self, prompt: str, messages: list | None, params: dict) -> dict:
        headers = {"Authorization": f"Bearer {self.api_key}", "Content-Type": "application/json"}
        body = {
            "model": self.model,
            "messages": messages or [{"role": "user", "content": prompt}],
            **params,
        }
        return self.send(self.url, headers, body, self.timeout)


def post_json(url: str, headers: dict, body: dict, timeout: float) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode("utf-8"), headers)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return json.load(reply)
    except urllib.error.HTTPError as error:
        raise BackendError(f"the endpoint answered {error.code}: {error.read().decode()}", error.code) from error


@dataclass(frozen=True)
class RetryPolicy:
    """Which errors are tried again, how often and after what delay.

    Transient errors (``retry_on`` statuses, connection errors, time-outs) are repeated
    with a delay that doubles up to ``max_delay``. A call that still fails is made once
    more without the ``drop_keys`` parameters, if it had any.
    """

    max_retries: int = fixed.MAX_RETRIES
    base_delay: float = 1.0
    max_delay: float = 60.0
    retry_on: tuple[int, ...] = fixed.RETRY_STATUSES
    drop_keys: tuple[str, ...] = fixed.OPTIONAL_PARAMS
    sleep: Callable[[float], None] = field(default=time.sleep)

    def run(self, call: Callable[[dict], dict], params: dict) -> dict:
        try:
            return self._repeat(call, params)
        except Exception:
            reduced = {k: v for k, v in params.items() if k not in self.drop_keys}
            if reduced == params:
                raise
        return call(reduced)

    def _repeat(self, call: Callable[[dict], dict], params: dict) -> dict:
        delay = self.base_delay
        for attempt in range(self.max_retries + 1):
            try:
                return call(params)
            except (BackendError, OSError) as error:
                if isinstance(error, BackendError) and error.status not in self.retry_on:
                    raise
                if attempt == self.max_retries:
                    raise RuntimeError(f"given up after {attempt} more tries: {error}") from error
            self.sleep(delay)
            delay = min(delay * 2, self.max_delay)
        raise AssertionError("unreachable")


TurnCallback = Callable[[list[str], Any], tuple[bool, str | None, Any]]


def _pooled(
    batches: Iterator[Any],
    backend: Backend,
    concurrency: int,
    submit: Callable[[ThreadPoolExecutor, Any], Any],
    results: Callable[[Any], pd.DataFrame],
) -> Iterator[pd.DataFrame]:
    """Results of each Arrow batch, whose calls are made by ``concurrency`` threads."""
    backend.open()
    try:
        with ThreadPoolExecutor(concurrency) as pool:
            waiting: deque[Any] = deque()
            for batch in batches:
                waiting.append(submit(pool, batch))
                # One batch ahead, so that a slow row does not leave the threads idle.
                if len(waiting) > 1:
                    yield results(waiting.popleft())
            while waiting:
                yield results(waiting.popleft())
    finally:
        backend.close()


def _call_column(
    one: Callable[[Backend, str, list | None, dict], dict],
    result: str,
    backend: Backend,
    concurrency: int,
) -> Callable[..., Column]:
    """Nondeterministic Arrow UDF running ``one`` per row, ``concurrency`` rows at a time."""

    @F.pandas_udf(result)
    def calls(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from _pooled(batches, backend, concurrency, submit, results)

    def submit(pool: ThreadPoolExecutor, batch: tuple[pd.Series, ...]) -> list[Future]:
        return [pool.submit(guarded, *row) for row in zip(*batch)]

    def results(calls: list[Future]) -> pd.DataFrame:
        return pd.DataFrame([call.result() for call in calls])

    def guarded(prompt: str | None, messages: str | None, params: str | None) -> dict:
        start = time.perf_counter()
        try:
            turns = json.loads(messages) if messages else None
            done = one(backend, prompt or "", turns, json.loads(params or "{}"))
            return {**done, "error": None, "latency": time.perf_counter() - start}
        except Exception as error:  # a failing row must not fail the partition
            return {**_EMPTY[result], "error": str(error), "latency": time.perf_counter() - start}

    return calls.asNondeterministic()


def _batched_column(
    backend: Backend, policy: RetryPolicy, concurrency: int, batch_size: int
) -> Callable[..., Column]:
    """As :func:`_call_column`, with up to ``batch_size`` rows of equal parameters in a call."""

    @F.pandas_udf(_ONE_REPLY)
    def calls(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from _pooled(batches, backend, concurrency, submit, results)

    def submit(pool: ThreadPoolExecutor, batch: tuple[pd.Series, ...]) -> tuple[int, list]:
        rows = list(zip(*batch))
        groups: dict[str, list[int]] = {}
        for i, (_, _, sent) in enumerate(rows):
            groups.setdefault(sent or "{}", []).append(i)
        submitted = []
        for sent, places in groups.items():
            for start in range(0, len(places), batch_size):
                part = places[start : start + batch_size]
                submitted.append((part, pool.submit(many, [rows[i][:2] for i in part], json.loads(sent))))
        return len(rows), submitted

    def results(batch: tuple[int, list]) -> pd.DataFrame:
        size, submitted = batch
        found: list[dict | None] = [None] * size
        for places, call in submitted:
            for i, row in zip(places, call.result(), strict=True):
                found[i] = row
        return pd.DataFrame(found, columns=["reply", "error", "latency"])

    def many(requests: list[tuple[str | None, str | None]], params: dict) -> list[dict]:
        start = time.perf_counter()
        try:
            prompts = [prompt or "" for prompt, _ in requests]
            turns = [json.loads(m) if m else None for _, m in requests]
            replies = policy.run(lambda p: _counted_replies(backend, prompts, turns, p), params)
        except Exception as error:  # a bad request must not fail the others
            if len(requests) == 1:
                replies = [error]
            else:
                half = len(requests) // 2
                return many(requests[:half], params) + many(requests[half:], params)
        latency = time.perf_counter() - start
        return [
            {"reply": None, "error": str(r), "latency": latency}
            if isinstance(r, Exception)
            else {"reply": json.dumps(r, ensure_ascii=False), "error": None, "latency": latency}
            for r in replies
        ]

    return calls.asNondeterministic()


def _counted_replies(backend: Backend, prompts: list[str], messages: list[list | None], params: dict) -> list:
    replies = backend.generate_many(prompts, messages, params)
    if len(replies) != len(prompts):
        raise RuntimeError(f"{len(replies)} replies to {len(prompts)} requests")
    return replies


_ONE_REPLY = "reply string, error string, latency double"
_MANY_REPLIES = "replies array<string>, error string, latency double"
_EMPTY = {_ONE_REPLY: {"reply": None}, _MANY_REPLIES: {"replies": None}}


def _requests(
    df: DataFrame, params: Mapping[str, Any] | None, system_prompt: str, partitions: int | None
) -> tuple[DataFrame, list[Column]]:
    params = dict(params or {})
    system_prompt = system_prompt or params.pop("__system_prompt", "")
    params.pop("__system_prompt", None)
    ready = df if partitions is None else df.repartition(partitions)
    ready = merge_sampling_params(ready, params)
    if system_prompt or "messages" in df.columns:
        ready = with_messages(ready, system_prompt)
        messages = F.to_json("messages")
    else:
        messages = F.lit(None).cast("string")
    no_params = not ready.schema["sampling_params"].dataType.fieldNames()
    sent = F.lit("{}") if no_params else F.to_json("sampling_params")
    return ready, [optional(ready, "prompt"), messages, sent]


def batch_infer(
    df: DataFrame,
    backend: Backend,
    params: Mapping[str, Any] | None = None,
    on_error: str = "drop",
    *,
    system_prompt: str = "",
    policy: RetryPolicy = RetryPolicy(),
    concurrency: int = 64,
    partitions: int | None = None,
    usage: bool = False,
    batch_size: int | None = None,
) -> DataFrame:
    """Add ``response`` to every row.

    ``on_error='drop'`` leaves failing rows out, so that a later run finds them pending.
    ``on_error='keep'`` keeps them and adds ``thinking``, ``usage``, ``_latency``,
    ``_status`` and ``_error``. Calls in flight: ``concurrency`` times running tasks;
    ``partitions`` sets the number of tasks at the price of a shuffle. With ``batch_size`` up
    to so many rows of an Arrow batch that have the same parameters go to
    :meth:`Backend.generate_many` together; a batch that fails is tried in halves, so that
    one bad row fails alone, and ``_latency`` is that of the batch.
    """
    if on_error not in ("drop", "keep"):
        raise ValueError(f"unknown on_error: {on_error}")

    def one(model: Backend, prompt: str, messages: list | None, sent: dict) -> dict:
        reply = policy.run(lambda p: model.generate(prompt, messages, p), sent)
        return {"reply": json.dumps(reply, ensure_ascii=False)}

    ready, request = _requests(df, params, system_prompt, partitions)
    if batch_size is None:
        call = _call_column(one, _ONE_REPLY, backend, concurrency)
    else:
        call = _batched_column(backend, policy, concurrency, batch_size)
    called = ready.withColumn("_call", call(*request))
    if on_error == "drop":
        called = called.where(F.col("_call.error").isNull())
    parsed = called.withColumn("_reply", envelopes.read_reply(F.col("_call.reply"))).withColumn(
        "_chat", envelopes.parse_envelope(F.col("_reply"))
    )
    ok = F.col("_call.error").isNull()
    response = F.when(ok, F.coalesce("_reply.text", "_chat.response"))
    added = [response.alias("response")]
    if on_error == "keep" or usage:
        added.append(F.when(ok, envelopes.token_stats(F.col("_reply"))).alias("usage"))
    if on_error == "keep":
        added += [
            F.col("_chat.thinking").alias("thinking"),
            F.round("_call.latency", 3).alias("_latency"),
            F.when(ok, F.lit("success")).otherwise(F.lit("failed")).alias("_status"),
            F.col("_call.error").alias("_error"),
        ]
    return parsed.select(*_kept(df), *added)


def _kept(df: DataFrame) -> list[str]:
    new = {"response", "responses", "usage", "thinking", "_latency", "_status", "_error"}
    return [c for c in df.columns if c not in new]


def multi_turn_infer(
    df: DataFrame,
    backend: Backend,
    callback: TurnCallback,
    max_turns: int = 10,
    params: Mapping[str, Any] | None = None,
    *,
    policy: RetryPolicy = RetryPolicy(),
    concurrency: int = 64,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``responses ARRAY<STRING>`` and ``usage`` (summed); failing rows are left out.

    ``callback(responses so far, state)`` returns (continue?, next prompt, state).
    """

    def one(model: Backend, prompt: str, messages: list | None, sent: dict) -> dict:
        texts: list[str] = []
        replies: list[str] = []
        state: Any = {}
        for _ in range(max_turns):
            turn = prompt
            reply = policy.run(lambda p: model.generate(turn, None, p), sent)
            replies.append(json.dumps(reply, ensure_ascii=False))
            texts.append(reply_text(reply))
            go_on, following, state = callback(texts, state)
            if not go_on or following is None:
                break
            prompt = following
        return {"replies": replies}

    ready, request = _requests(df, params, "", partitions)
    called = ready.withColumn(
        "_call", _call_column(one, _MANY_REPLIES, backend, concurrency)(*request)
    ).where(F.col("_call.error").isNull())
    parsed = called.withColumn("_replies", F.transform("_call.replies", envelopes.read_reply))
    return parsed.select(*_kept(df), *replies_columns())


def replies_columns() -> list[Column]:
    """``responses`` and summed ``usage`` of ``_replies``, the parsed replies of a conversation."""
    texts = F.transform(
        "_replies", lambda r: F.coalesce(r["text"], envelopes.parse_envelope(r)["response"])
    )
    stats = F.transform("_replies", envelopes.token_stats)

    def summed(name: str) -> Column:
        zero = F.lit(0).cast("bigint")
        return F.aggregate(stats, zero, lambda total, s: total + s[name]).alias(name)

    usage = F.struct(summed("prompt"), summed("completion"), summed("total"))
    return [texts.alias("responses"), usage.alias("usage")]


def reply_text(reply: Mapping[str, Any]) -> str:
    """Text of a raw reply, for turn callbacks."""
    if "text" in reply:
        return reply["text"]
    choices = reply.get("choices") or [{}]
    return (choices[0].get("message") or {}).get("content") or ""


def usage_totals(df: DataFrame) -> DataFrame:
    """One row: token counts over all rows with a ``usage`` struct."""
    return df.agg(*[c.alias(n) for n, c in usage_sums().items()])


def usage_sums() -> dict[str, Column]:
    """The sums of :func:`usage_totals`, for :class:`~replyloom.session.Counters` of the job that
    writes the replies."""
    return {n: F.coalesce(F.sum(f"usage.{n}"), F.lit(0)) for n in ("prompt", "completion", "total")}
