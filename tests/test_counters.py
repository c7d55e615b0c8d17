"""Counters that come with a write: right, and without evaluating anything twice."""

import pytest
from pyspark.sql import functions as F

from replyloom.functions import conversations as C
from replyloom.functions import sharding
from replyloom.operators import matching, records, scoring
from replyloom.session import Counters, materialize_counted
from replyloom.sources import sinks

GOOD = '{"correctness": 40, "logic": 20, "clarity": 10, "completeness": 8, "total_score": 78, "brief_comment": "c"}'


@pytest.fixture
def calls(spark):
    """An expensive step (a Python function) and the number of rows it was called for."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def step(text):
        seen.add(1)
        return text

    return step.asNondeterministic(), seen


def answers(spark, n=60):
    rows = [(i // 3, i % 3, f"a{i}", GOOD if i % 4 else "no score") for i in range(n)]
    return spark.createDataFrame(rows, "original_idx bigint, output_idx int, model_answer string, response string").repartition(4)


def test_split_sink_searches_once(spark, tmp_path, calls):
    step, seen = calls
    scored = scoring.score_responses(answers(spark).withColumn("response", step("response")))
    path = str(tmp_path / "split")
    report = sinks.write_split(scored, path).first()
    assert seen.value == 60
    assert (report.total, report.success, report.failed, report.success_rate) == (60, 45, 15, 75.0)
    ok = sinks.read_split(spark, path, "original_idx bigint, output_idx int, model_answer string, scores struct<total_score:double>, response string", "ok").collect()
    failed = sinks.read_split(spark, path, "original_idx bigint, output_idx int, error string, raw_response string, scores string", "failed").collect()
    assert seen.value == 60
    assert len(ok) == 45 and {r.scores.total_score for r in ok} == {78.0} and {r.response for r in ok} == {None}
    assert len(failed) == 15 and {r.raw_response for r in failed} == {"no score"} and all(r.error for r in failed)
    assert {(r.original_idx, r.output_idx) for r in [*ok, *failed]} == {(i // 3, i % 3) for i in range(60)}
    same = scoring.failed_rows(scoring.score_responses(answers(spark))).select(F.to_json(F.struct("*")).alias("value"))
    assert sorted(r.value for r in same.collect()) == sorted(r.value for r in spark.read.text(f"{path}/outcome=failed").collect())


def test_split_of_one_outcome_and_of_nothing(spark, tmp_path):
    for name, rows in (("good", answers(spark).where("output_idx = 1 and original_idx % 4 <> 1")), ("none", answers(spark, 0))):
        report = sinks.write_split(scoring.score_responses(rows.withColumn("response", F.lit(GOOD))), str(tmp_path / name)).first()
        assert report.failed == 0 and report.total == rows.count()
        assert sinks.read_split(spark, str(tmp_path / name), "error string", "failed").count() == 0
    with pytest.raises(ValueError, match="unknown outcome"):
        sinks.read_split(spark, str(tmp_path / "good"), "error string", "bad")


def test_shards_are_evaluated_once_and_checked(spark, tmp_path, calls):
    step, seen = calls
    rows = spark.range(200).select(F.concat(F.lit("id"), "id").alias("id"), step(F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("text")).repartition(3)
    path = str(tmp_path / "shards")
    manifest = sinks.write_shards(rows, path, sharding.md5_shard(F.col("id"), 5), 5).collect()
    assert seen.value == 200 and sum(r.rows for r in manifest) == 200
    for r in manifest:
        parts = list((tmp_path / "shards" / f"shard={r.shard}").glob("part-*"))
        assert r.files == len(parts) and r.bytes == sum(p.stat().st_size for p in parts)
        assert r.rows == sum(len(p.read_text().splitlines()) for p in parts)
    read, bad = sinks.read_shards(spark, path, "id string, text string")
    assert read.count() == 200 and bad.count() == 0
    with parts[0].open("a") as f:
        f.write("{}")
    with pytest.raises(ValueError, match=rf"shards \[{manifest[-1].shard}\]"):
        sinks.read_shards(spark, path, "id string")


def test_shards_of_nothing_and_out_of_range(spark, tmp_path):
    assert sinks.write_shards(spark.createDataFrame([], "id string"), str(tmp_path / "none"), F.lit(0), 4).count() == 0
    assert sinks.check_shards(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError, match="without a shard"):
        sinks.write_shards(spark.range(5).withColumn("id", F.lit("a")), str(tmp_path / "far"), F.lit(4), 4)


def test_counters_need_no_second_evaluation(spark, calls):
    step, seen = calls
    rows, counts = materialize_counted(spark.range(50).select(step(F.col("id").cast("string")).alias("t")), "t", n=F.count(F.lit(1)), long=F.count_if(F.length("t") > 1))
    assert counts.first().asDict() == {"n": 50, "long": 40} and rows.count() == 50 and seen.value == 50
    assert counts.dtypes == [("n", "bigint"), ("long", "bigint")]
    empty = Counters(n=F.count(F.lit(1)), most=F.max("id"))
    empty.watch(spark.range(0)).collect()
    assert tuple(empty.row().first()) == (0, None)


def test_stage_reports_of_the_writing_job(spark, calls):
    step, seen = calls
    turns = f"id string, conversations {C.CONVERSATION}, thinking_answer_text string"
    source = spark.createDataFrame([(f"i{k}", [("human", "q")], "long " * 60) for k in range(8)], turns)
    output = spark.createDataFrame([(f"i{k}", ["", "  ", "short", "long " * 59][k % 4]) for k in range(8)] + [("x", None)], "id string, response string")
    for merge, wanted in ((matching.merge_stage1_counted, (4, 5)), (matching.merge_stage2_counted, (4, 5, 2))):
        before = seen.value
        merged, report = merge(source, output.withColumn("response", step("response")))
        assert seen.value - before == 9
        assert tuple(report.first()) == wanted and merged.count() == 4 and "_response" not in merged.columns
    rows = spark.createDataFrame([(1, [("human", "q")], "a", ""), (2, [("human", "q")], "", ""), (3, [("gpt", "q")], "a", "b"), (4, [("human", "q")], "a", "b")],
                                 f"original_idx bigint, conversations {C.CONVERSATION}, output_0 string, output_1 string")
    prepared, report = records.prepare_judge_counted(rows)
    assert tuple(report.first()) == (2, 3, 1.5) and prepared.exceptAll(records.prepare_judge(rows)).count() == 0
    kept, report = records.normalize_counted(rows.withColumn("id", F.col("original_idx")), 1)
    assert report.first().asDict() == {"total": 4, "kept": 3} and kept.count() == 3
