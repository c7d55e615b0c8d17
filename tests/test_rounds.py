"""Batched calls and multi-turn runs in rounds: what is called how often, and what survives a loss."""

import os

import pytest
from pyspark.sql import functions as F

from catalog import models
from replyloom.operators import inference, rounds
from replyloom.operators.inference import Backend, BackendError, RetryPolicy

QUICK = RetryPolicy(max_retries=1, sleep=lambda seconds: None)


class Batches(Backend):
    """Notes the sizes of its batches; refuses prompts that say so, with all of their batch."""

    def __init__(self, path, short=False):
        self.path, self.short = path, short

    def generate_many(self, prompts, messages, params):
        with open(self.path, "a") as f:
            f.write(f"{len(prompts)} {params.get('temperature')}\n")
        if "bad" in prompts:
            raise BackendError("refused", 400)
        replies = [BackendError("only this") if p == "odd" else {"text": f"{p} {params.get('temperature')}"} for p in prompts]
        return replies[1:] if self.short and len(replies) > 1 else replies


def prompts(spark, texts):
    rows = [(i, t, 0.5 if i % 2 else 0.1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id int, prompt string, temperature double").coalesce(1)


def test_equal_parameters_share_a_call(spark, tmp_path):
    path = str(tmp_path / "calls")
    found = inference.batch_infer(prompts(spark, [f"p{i}" for i in range(20)]), Batches(path), batch_size=4)
    found = sorted(found.collect(), key=lambda r: r.id)  # a sort in Spark would sample, and call again
    assert [r.response for r in found] == [f"p{i} {0.5 if i % 2 else 0.1}" for i in range(20)]
    sizes = sorted(open(path).read().split("\n")[:-1])
    assert sizes == ["2 0.1"] + ["2 0.5"] + ["4 0.1"] * 2 + ["4 0.5"] * 2


def test_a_bad_prompt_fails_alone(spark, tmp_path):
    path = str(tmp_path / "calls")
    texts = ["bad" if i == 5 else "odd" if i == 8 else None if i == 2 else f"p{i}" for i in range(32)]
    df = prompts(spark, texts).withColumn("temperature", F.lit(0.0))
    found = {r.id: r for r in inference.batch_infer(df, Batches(path), on_error="keep", policy=QUICK, batch_size=32).collect()}
    assert {i for i, r in found.items() if r._status == "failed"} == {5, 8}
    assert found[5]._error == "refused" and found[8]._error == "only this" and found[2].response == " 0.0"
    # halves around the bad prompt (32, 16, 8, 4, 2, 1, 1 with the rest) and parameters tried without temperature
    assert len(open(path).read().split("\n")) < 30
    kept = inference.batch_infer(df, Batches(path), policy=QUICK, batch_size=7)
    assert kept.count() == 30 and "_status" not in kept.columns


def test_missing_replies_are_no_replies(spark, tmp_path):
    found = inference.batch_infer(prompts(spark, ["a", "b", "c", "d"]), Batches(str(tmp_path / "c"), short=True), batch_size=4)
    assert sorted(r.response for r in found.collect()) == ["a 0.1", "b 0.5", "c 0.1", "d 0.5"]


def test_backends_without_batches_are_asked_one_by_one(spark):
    df = prompts(spark, ["a", "b"]).drop("temperature")
    one, many = (inference.batch_infer(df, models.DigestBackend(), batch_size=n) for n in (None, 8))
    assert one.exceptAll(many).count() == 0 and many.count() == 2


class Talker(Backend):
    """Answers with the prompt; notes each call; its worker dies at the third turn until told not to."""

    def __init__(self, folder):
        self.folder = folder

    def generate(self, prompt, messages, params):
        turn = prompt.count(">")
        with open(f"{self.folder}/calls-{turn}", "a") as f:
            f.write("x")
        if turn == 2 and not os.path.exists(f"{self.folder}/mended"):
            os._exit(1)
        if prompt.startswith("refused>"):
            raise BackendError("no", 400)
        return {"text": prompt, "meta_info": {"prompt_tokens": 1, "completion_tokens": 2}}


def four_turns(texts, state):
    turns = state.get("turns", 0) + 1
    last = texts[-1]
    return turns < (2 if last.startswith("short") else 4), last + ">", {"turns": turns, "seen": len(texts)}


def test_a_loss_repeats_one_turn(spark, tmp_path):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(["a", "b", "short", "refused"])], "id int, prompt string").repartition(2)
    folder = str(tmp_path / "turns")
    with pytest.raises(Exception):
        rounds.multi_turn_rounds(df, Talker(str(tmp_path)), four_turns, policy=QUICK, folder=folder)
    (tmp_path / "mended").touch()
    found = rounds.multi_turn_rounds(df, Talker(str(tmp_path)), four_turns, policy=QUICK, folder=folder).collect()
    got = {r.prompt: r.responses for r in found}
    assert got == {"a": ["a", "a>", "a>>", "a>>>"], "b": ["b", "b>", "b>>", "b>>>"], "short": ["short", "short>"]}
    assert {r.prompt: r.usage.completion for r in found} == {"a": 8, "b": 8, "short": 4}
    calls = {n: len((tmp_path / f"calls-{n}").read_text()) for n in range(4)}
    assert calls[0] == 4 and calls[1] == 4 and calls[3] == 2  # turns before and after the loss: once


def test_same_as_turns_within_a_task(spark):
    df = spark.createDataFrame([(i, f"q{i}") for i in range(60)], "id int, prompt string")
    whole = inference.multi_turn_infer(df, models.DigestBackend(), models.ask_again)
    rounds_of = rounds.multi_turn_rounds(df, models.DigestBackend(), models.ask_again)
    assert rounds_of.columns == whole.columns and rounds_of.exceptAll(whole).count() == 0 and rounds_of.count() == 60
    cut = rounds.multi_turn_rounds(df, models.DigestBackend(), lambda texts, state: (True, "more", state), max_turns=2)
    assert {len(r.responses) for r in cut.collect()} == {2}
    assert rounds.multi_turn_rounds(df.limit(0), models.DigestBackend(), models.ask_again).count() == 0
