import json

import pytest
from pyspark.sql import functions as F

from catalog.models import DigestJudge
from catalog import models
from replyloom import materialize, run_judge, run_preference, run_stage1, run_stage2
from replyloom.functions import conversations as C
from replyloom.operators import inference, records
from replyloom.session import shared_dir
from replyloom.sources import read_jsonl_dir, sinks
from replyloom.streaming import stream_bad_lines, stream_infer


class Unreachable(inference.Backend):
    """Fails on every call: whoever uses it must not need the model."""

    def generate(self, prompt, messages, params):
        raise AssertionError("the model was called")


@pytest.fixture(scope="module")
def wide(spark):
    rows = [(i, [("human", f"q{i}"), ("gpt", f"r{i}")], f"a{i}", f"b{i}" if i % 2 else "") for i in range(60)]
    return spark.createDataFrame(rows, f"original_idx bigint, conversations {C.CONVERSATION}, output_0 string, output_1 string")


def flat(df):
    return sorted(
        (r.original_idx, name, s.total_score) for r in df.collect() for name, s in r.scores.items()
    )


def test_judge_run_and_reuse(spark, wide):
    scores, failed = run_judge(wide, DigestJudge())
    whole = flat(scores)
    assert len(whole) + failed.count() == 90
    assert {r.error for r in failed.collect()} <= {"Unable to extract score JSON"}

    prepared = materialize(records.prepare_judge(wide), "prepared")
    done = materialize(inference.batch_infer(prepared, DigestJudge()), "done").select("original_idx", "output_idx", "response")
    again, _ = run_judge(wide, Unreachable(), prepared=prepared, done=done)
    assert flat(again) == whole
    merged, _ = run_judge(wide, Unreachable(), prepared=prepared, done=done, merge_only=True)
    assert flat(merged) == whole
    half = done.where("original_idx < 30")
    resumed, _ = run_judge(wide, DigestJudge(), done=half)
    assert flat(resumed) == whole
    partly, _ = run_judge(wide, Unreachable(), done=half)
    assert flat(partly) == [x for x in whole if x[0] < 30]


def test_model_is_called_once_per_row(spark, wide, tmp_path):
    class Counting(DigestJudge):
        def generate(self, prompt, messages, params):
            with open(tmp_path / "calls", "a") as f:
                f.write("x\n")
            return super().generate(prompt, messages, params)

    scores, failed = run_judge(wide, Counting())
    scores.count(), failed.count(), scores.collect()
    assert (tmp_path / "calls").read_text().count("x") == 90


def test_preference_run(spark, wide):
    prepared = records.prepare_judge(wide)
    responses = materialize(inference.batch_infer(prepared, DigestJudge()), "responses")
    for write in (True, False):
        result = run_preference(responses, write=write)
        report = result.report.first()
        assert report.total == 90 and report.failed == result.failed.count()
        assert result.scored.count() == report.success
        assert result.summary.first().total_questions == result.best_worst.count()
        assert sum(r.answers for r in result.histogram.collect()) == report.success


def test_preference_run_from_files(spark, tmp_path):
    """Shards with a broken line and an answer judged twice."""
    good = '{"correctness": 40, "logic": 20, "clarity": 10, "completeness": 8, "total_score": %d}'

    def line(question, output, total, answer):
        row = {"original_idx": question, "output_idx": output, "question": "q", "reference_answer": "r",
               "model_answer": answer, "response": good % total, "model": "m"}
        return json.dumps(row)

    (tmp_path / "response_0.jsonl").write_text(
        "\n".join([line(0, 0, 50, "a"), "{broken", "", line(0, 0, 50, "b"), line(0, 1, 101, "c")])
    )
    (tmp_path / "response_1.jsonl").write_text("\n".join([line(0, 1, 50, "d"), line(1, 0, 7, "e")]))
    (tmp_path / "notes.jsonl").write_text("{broken")
    schema = "original_idx bigint, output_idx int, question string, reference_answer string, model_answer string, response string"
    rows, bad = read_jsonl_dir(spark, str(tmp_path), "response_*.jsonl", schema, numbered=True)
    result = run_preference(rows, order_by=["output_idx", "file", "line"], bad=bad)
    best = {r.original_idx: (r.num_answers, r.best_answer.answer, r.worst_answer.answer) for r in result.best_worst.collect()}
    assert best == {0: (3, "a", "d"), 1: (1, "e", "e")}
    failed = sorted((r.line, r.error, r.original_idx) for r in result.failed.collect())
    assert failed == [(2, "JSON parse error", None), (5, "total_score out of range", 0)]
    assert tuple(result.report.first()) == (6, 4, 2, pytest.approx(400 / 6))
    sinks.write_jsonl(result.scored, str(tmp_path / "ok"))
    sinks.write_jsonl(result.failed, str(tmp_path / "bad"))
    written = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "ok")).collect()]
    assert len(written) == 4 and all(r["model"] == "m" and "file" not in r for r in written)


def test_stages(spark):
    rows = [(f"i{i}", [("system", "s"), ("user", f"q{i}")] if i % 3 else [("gpt", "no question")], 0) for i in range(30)]
    source = spark.createDataFrame(rows, f"id string, conversations {C.CONVERSATION}, line int")
    stage1 = run_stage1(source, models.DigestBackend())
    found = {r.id: [tuple(m) for m in r.conversations] for r in stage1.collect()}
    assert set(found) == {f"i{i}" for i in range(30) if i % 3}
    assert all(v[1][0] == "human" and v[2][0] == "gpt" and v[2][1].startswith("answer ") for v in found.values())

    twice = stage1.withColumn("file", F.lit("a")).unionByName(stage1.withColumn("file", F.lit("b"))).withColumn("line", F.lit(0))
    twice = twice.withColumn("line", F.monotonically_increasing_id())
    stage2 = run_stage2(materialize(twice, "stage1"), models.DigestBackend(""), merge_by=["file", "line"])
    delivered = stage2.collect()
    assert len(delivered) == 20
    # 32 digits are fewer than the floor of 120 characters: the source text is kept
    assert all(r.replaced_short and r.conversations[-1].value == found[r.id][2][1] for r in delivered)
    long = run_stage2(stage1, models.DigestBackend("x" * 120))
    assert not any(r.replaced_short for r in long.collect())
    done = materialize(stage1.select("id", F.lit("y" * 130).alias("response")), "done")
    merged = run_stage2(stage1, Unreachable(), done=done, merge_only=True)
    assert {r.conversations[-1].value for r in merged.collect()} == {"y" * 130}


def test_stream_resumes_with_new_files(spark, tmp_path):
    rows = spark.range(20).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("p"), "id").alias("prompt"))
    source, sink, state = (str(tmp_path / d) for d in ("in", "out", "state"))

    def run():
        stream_infer(spark, source, sink, state, "id string, prompt string", models.DigestBackend()).awaitTermination()
        return [r.id for r in spark.read.schema("id string, response string").json(sink).collect()]

    sinks.write_jsonl(rows.where("id < 8"), source)
    assert sorted(run(), key=int) == [str(i) for i in range(8)]
    sinks.write_jsonl(rows.where("id >= 8"), source, mode="append")
    assert sorted(run(), key=int) == [str(i) for i in range(20)]
    assert sorted(run(), key=int) == [str(i) for i in range(20)]


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_stream_reads_lines_as_the_batch_does(spark, tmp_path):
    """Broken and doubtful lines are no rows of the stream; other fields stay."""
    source, sink, bad, state = (str(tmp_path / d) for d in ("in", "out", "bad", "state"))
    lines = ['{"id": "a", "prompt": "p", "more": [1]}', "{broken", "{'id': 'b'} and text", '{"id": "c", "prompt": 7}', ""]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.jsonl").write_text("\n".join(lines))
    schema = "id string, prompt string"
    stream_infer(spark, source, sink, state + "1", schema, models.DigestBackend()).awaitTermination()
    stream_bad_lines(spark, source, bad, state + "2", schema).awaitTermination()
    good = {r["id"]: r for r in (json.loads(x.value) for x in spark.read.text(sink).collect())}
    assert set(good) == {"a", "c"} and good["a"]["more"] == [1] and good["c"]["prompt"] == "7"
    failed = [json.loads(x.value) for x in spark.read.text(bad).collect()]
    assert sorted(r["value"] for r in failed) == sorted(lines[1:3])
