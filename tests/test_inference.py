import hashlib
import json
import time

import pytest
from pyspark.sql import functions as F

from catalog import models
from replyloom.operators import inference as I
from replyloom.operators import records


class Recording(I.Backend):
    """Answers with what it was sent; fails on demand."""

    def open(self):
        self.opened = True

    def generate(self, prompt, messages, params):
        assert self.opened
        if prompt == "boom":
            raise ValueError("no such prompt")
        if prompt == "picky" and "stop" in params:
            raise ValueError("stop is not supported")
        return {"text": json.dumps([prompt, messages, params]), "meta_info": {"prompt_tokens": 2, "completion_tokens": 3}}


def responses(df):
    return {r.id: json.loads(r.response) for r in df.collect()}


def test_drop_leaves_failing_rows_out(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "boom", "y"), (3, None, "z")], "id int, prompt string, other string")
    out = I.batch_infer(df, Recording(), {"temperature": 0.5})
    assert out.columns == ["id", "prompt", "other", "response"]
    assert responses(out) == {1: ["a", None, {"temperature": 0.5}], 3: ["", None, {"temperature": 0.5}]}


def test_keep_reports_failing_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "boom")], "id int, prompt string")
    ok, bad = I.batch_infer(df, Recording(), on_error="keep").orderBy("id").collect()
    assert (ok._status, ok._error, ok.usage.total) == ("success", None, 5) and ok._latency >= 0
    assert (bad._status, bad._error, bad.response, bad.usage) == ("failed", "no such prompt", None, None)


def test_messages_and_row_parameters(spark):
    turns = [{"role": "user", "content": "hi"}]
    df = spark.createDataFrame(
        [(1, "p", turns, 0.1, None), (2, "p", [], None, ["x"]), (3, "p", None, None, None)],
        "id int, prompt string, messages array<struct<role:string,content:string>>, temperature double, stop array<string>",
    )
    params = {"temperature": 0.9, "seed": 7, "__system_prompt": "be kind"}
    out = responses(I.batch_infer(df, Recording(), params))
    built = [{"role": "system", "content": "be kind"}, {"role": "user", "content": "p"}]
    assert out[1] == ["p", turns, {"temperature": 0.1, "seed": 7}]
    assert out[2] == ["p", built, {"temperature": 0.9, "seed": 7, "stop": ["x"]}]
    assert out[3] == ["p", built, {"temperature": 0.9, "seed": 7}]


def test_reduced_parameters_are_tried(spark):
    df = spark.createDataFrame([(1, "picky")], "id int, prompt string")
    out = responses(I.batch_infer(df, Recording(), {"temperature": 0.5, "stop": "."}))
    assert out == {1: ["picky", None, {"temperature": 0.5}]}


def test_retry_policy():
    slept, calls = [], []
    policy = I.RetryPolicy(max_retries=6, base_delay=1, max_delay=5, sleep=slept.append)

    def flaky(params):
        calls.append(params)
        if len(calls) < 6:
            raise I.BackendError("busy", 503) if len(calls) % 2 else ConnectionError("gone")
        return {"text": "ok"}

    assert policy.run(flaky, {}) == {"text": "ok"}
    assert slept == [1, 2, 4, 5, 5]

    def refused(params):
        calls.append(params)
        raise I.BackendError("bad request", 400)

    calls.clear()
    slept.clear()
    with pytest.raises(I.BackendError):
        policy.run(refused, {"temperature": 1})
    assert len(calls) == 1 and not slept
    calls.clear()
    with pytest.raises(I.BackendError):
        policy.run(refused, {"temperature": 1, "stop": "x"})
    assert calls == [{"temperature": 1, "stop": "x"}, {"temperature": 1}]

    def never(params):
        raise TimeoutError("late")

    with pytest.raises(RuntimeError, match="given up after 6 more tries"):
        policy.run(never, {})


def test_chat_backend_builds_the_request(spark):
    def send(url, headers, body, timeout):
        seen = {"url": url, "auth": headers["Authorization"], "body": body}
        return {"choices": [{"message": {"content": json.dumps(seen), "reasoning_content": " why "}}], "usage": {"prompt_tokens": 4}}

    backend = I.ChatBackend("http://host/v1", "m", "key", send=send)
    df = spark.createDataFrame([(1, "p")], "id int, prompt string")
    (r,) = I.batch_infer(df, backend, {"temperature": 1.0}, on_error="keep", system_prompt="s").collect()
    assert r.thinking == "why" and r.usage.prompt == 4
    seen = json.loads(r.response)
    assert seen["url"] == "http://host/v1/chat/completions" and seen["auth"] == "Bearer key"
    assert seen["body"] == {
        "model": "m",
        "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "p"}],
        "temperature": 1.0,
    }
    plain = I.batch_infer(df, backend).first()
    assert json.loads(plain.response)["body"]["messages"] == [{"role": "user", "content": "p"}]


def test_multi_turn(spark):
    def until_three(texts, state):
        state = {"seen": state.get("seen", 0) + 1}
        return state["seen"] < 3, f"next {len(texts)}", state

    df = spark.createDataFrame([(1, "a", "kept"), (2, "boom", "lost")], "id int, prompt string, other string")
    (r,) = I.multi_turn_infer(df, Recording(), until_three).collect()
    assert [json.loads(t)[0] for t in r.responses] == ["a", "next 1", "next 2"]
    assert (r.usage.prompt, r.usage.completion, r.usage.total, r.other) == (6, 9, 15, "kept")
    (r,) = I.multi_turn_infer(df, Recording(), until_three, max_turns=2).collect()
    assert len(r.responses) == 2
    (r,) = I.multi_turn_infer(df, Recording(), lambda t, s: (True, None, s)).collect()
    assert len(r.responses) == 1


def test_usage_totals(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, prompt string")
    assert tuple(I.usage_totals(I.batch_infer(df, Recording(), usage=True)).first()) == (4, 6, 10)
    assert tuple(I.usage_totals(I.batch_infer(df.limit(0), Recording(), usage=True)).first()) == (0, 0, 0)


def test_only_the_request_crosses_to_python(spark):
    df = spark.range(10).select("id", F.col("id").cast("string").alias("prompt"), F.array("id").alias("big"))
    out = I.batch_infer(df, models.DigestBackend(), partitions=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    call = next(line for line in plan.splitlines() if "ArrowEvalPython" in line)
    assert "calls(prompt" in call and "big" not in call.split("],")[0]
    assert plan.count("ArrowEvalPython") == 1
    wanted = {str(i): "answer " + hashlib.md5(str(i).encode()).hexdigest() for i in range(10)}
    assert {r.prompt: r.response for r in out.collect()} == wanted


def test_rows_keep_their_replies_over_many_batches(spark):
    class Uneven(models.DigestBackend):
        def generate(self, prompt, messages, params):
            time.sleep(0.02 if int(prompt) % 50 == 0 else 0)
            return super().generate(prompt, messages, params)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        df = spark.range(2000).select(F.col("id").cast("string").alias("prompt"))
        out = I.batch_infer(df, Uneven(), concurrency=16).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert len(out) == 2000
    assert all(r.response == "answer " + hashlib.md5(r.prompt.encode()).hexdigest() for r in out)


def test_sampling_params_defaults(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert records.merge_sampling_params(df, {"a": None}).schema["sampling_params"].dataType.fieldNames() == []
