"""Ledgers of keys and of runs."""

import re

import pytest
from pyspark.sql import functions as F

from catalog import models
from replyloom import run_judge, run_stage1
from replyloom.functions import conversations as C
from replyloom.operators import inference
from replyloom.operators.ledgers import KeyLedger
from replyloom.plans import RunLedger, record_judge, record_stage1, record_stage2
from replyloom.plans.recorded import content_fingerprint


def keys(spark, *ids):
    return spark.createDataFrame([(i, f"text {i}") for i in ids], "id string, text string")


def test_pending_over_runs(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path / "l"), buckets=4)
    rows = keys(spark, "a", "b", "c", None, "")
    assert ledger.pending(rows).count() == 5
    ledger.append(keys(spark, "a", "a", None, ""), "one")
    assert sorted(r.id or "-" for r in ledger.pending(rows).collect()) == ["-", "b", "c"]
    # a repeated run does not see its own keys, and adds none twice
    assert ledger.pending(rows, "one").count() == 5
    ledger.append(keys(spark, "a", "b"), "one")
    assert sorted(tuple(r) for r in ledger.rows().collect()) == [("", "one"), ("a", "one"), ("b", "one")]
    status = keys(spark, "c", "d").withColumn("_status", F.when(F.col("id") == "c", "failed").otherwise("success"))
    ledger.append(status, "two")
    assert {r.id for r in ledger.rows().collect()} == {"", "a", "b", "d"}
    ledger.append(status, "two", retry_failed=False)
    assert "c" in {r.id for r in ledger.rows().collect()}


def test_ledger_is_found_again(spark, tmp_path):
    path = str(tmp_path / "l")
    first = KeyLedger(spark, path, "q bigint, o int", buckets=4)
    first.append(spark.createDataFrame([(1, 2), (1, None), (3, 4)], "q bigint, o int"), "one")
    spark.sql(f"DROP TABLE {first.table}")  # another session knows the folder only
    again = KeyLedger(spark, path, "q bigint, o int", buckets=99)
    assert again.buckets == 4 and sorted(tuple(r) for r in again.rows().collect()) == [(1, 2, "one"), (3, 4, "one")]
    assert again.pending(spark.createDataFrame([(1, 2), (1, 3)], "q bigint, o int")).count() == 1
    with pytest.raises(ValueError, match="another kind"):
        KeyLedger(spark, path, "id string")


def test_ledger_is_not_shuffled(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path / "l"), buckets=4)
    for run in "ab":
        ledger.append(keys(spark, *[f"{run}{i}" for i in range(50)]), run)
    todo = ledger.pending(spark.range(300).select(F.concat(F.lit("b"), F.col("id") % 100).alias("id")))
    assert todo.count() == 150
    plan = todo._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.rindex("SortMergeJoin") :]
    above = scan[: scan.index("FileScan parquet")]
    assert plan.count("Exchange hashpartitioning") - plan.count("ShuffleQueryStage") <= 1 and "BroadcastExchange" not in plan
    # the side of the ledger: from the join down to its scan there is a sort at most
    right = re.split(r"\n\s*[: ]*\+- ", above)[-3:]
    assert not any("Exchange" in line for line in right), plan
    assert "Bucketed: true" in plan or "bucketed" in plan.lower()


def test_first_run_wins(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path / "l"), buckets=4)
    rows = spark.createDataFrame([("a", 1), ("a", 0), ("", 2), (None, 3), ("b", 4)], "id string, n int")
    first = ledger.merge(rows, "one", str(tmp_path / "one"), ["n"])
    assert sorted(r.n for r in first.collect()) == [0, 2, 3, 4]
    later = spark.createDataFrame([("a", -5), ("c", 7), ("c", 6), ("", 8)], "id string, n int")
    assert sorted(r.n for r in ledger.merge(later, "two", str(tmp_path / "two"), ["n"]).collect()) == [6, 8]
    # the first run, repeated after it broke off
    assert sorted(r.n for r in ledger.merge(rows, "one", str(tmp_path / "one"), ["n"]).collect()) == [0, 2, 3, 4]
    assert sorted(r.id for r in ledger.rows().collect()) == ["a", "b", "c"]


class Counting(models.DigestBackend):
    """Notes every call; refuses prompts that hold a given text."""

    def __init__(self, path, refuses="\0", prefix="answer "):
        super().__init__(prefix)
        self.path, self.refuses = path, refuses

    def generate(self, prompt, messages, params):
        with open(self.path, "a") as f:
            f.write("x")
        if self.refuses in prompt:
            raise inference.BackendError("no", 400)
        return super().generate(prompt, messages, params)


@pytest.fixture
def counted(tmp_path):
    """A backend and the number of its calls since last asked."""
    path = tmp_path / "calls"

    def backend(**options):
        return Counting(str(path), **options)

    def calls():
        n = len(path.read_text()) if path.exists() else 0
        path.write_text("")
        return n

    return backend, calls


def conversations(spark, n=12, answer="a"):
    rows = [(f"i{k}", [("human", f"q{k}"), ("gpt", f"{answer} {k} " * 40)]) for k in range(n)]
    return spark.createDataFrame(rows, f"id string, conversations {C.CONVERSATION}")


def test_runs_are_reused_by_what_they_were_made_from(spark, tmp_path, counted):
    backend, calls = counted
    ledger, rows = RunLedger(spark, str(tmp_path / "runs")), conversations(spark)
    first = record_stage1(ledger, rows, backend(), "m")
    assert calls() == 12 and not first.reused
    assert first.df.exceptAll(run_stage1(rows, models.DigestBackend())).count() == 0 and first.df.count() == 12
    same = record_stage1(ledger, rows.repartition(5), backend(), "m")
    assert calls() == 0 and same.reused and same.fingerprint == first.fingerprint
    for change in ({"template": ("<", ">")}, {"params": {"temperature": 0.1}}, {"model": "other"}):
        record_stage1(ledger, rows, backend(), **{"model": "m", **change})
        assert calls() == 12
        record_stage1(ledger, rows, backend(), **{"model": "m", **change})
        assert calls() == 0
    record_stage1(ledger, conversations(spark, 13), backend(), "m")
    assert calls() == 13
    assert ledger.entries().where("stage = 'stage1-merged'").count() == 5


def test_another_gate_merges_again_only(spark, tmp_path, counted):
    backend, calls = counted
    ledger, rows = RunLedger(spark, str(tmp_path / "runs")), conversations(spark)
    strict = record_stage2(ledger, rows, backend(), "m")
    assert calls() == 12 and strict.df.where("replaced_short").count() == 12
    loose = record_stage2(ledger, rows, backend(), "m", ratio=0.0, floor=0)
    assert calls() == 0 and loose.df.where("replaced_short").count() == 0


def test_failed_calls_are_made_again(spark, tmp_path, counted):
    backend, calls = counted
    ledger, rows = RunLedger(spark, str(tmp_path / "runs")), conversations(spark)
    assert record_stage1(ledger, rows, backend(refuses="q1"), "m").df.count() == 9  # q1, q10 and q11 fail
    calls()
    whole = record_stage1(ledger, rows, backend(prefix="later "), "m")
    assert calls() == 3 and whole.df.count() == 12
    assert sum(r.conversations[-1].value.startswith("later ") for r in whole.df.collect()) == 3
    assert record_stage1(ledger, rows, backend(), "m").reused and calls() == 0


def test_an_output_without_entry_does_not_count(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "runs"))
    spark.range(3).write.parquet(f"{ledger.path}/s/left-over")
    assert ledger.stage("s", lambda: spark.range(5), [spark.range(2)]).df.count() == 5
    assert ledger.stage("s", lambda: spark.range(6), [spark.range(2)]).df.count() == 5
    assert ledger.stage("t", lambda: spark.range(6), [spark.range(2)]).df.count() == 6


def test_judge_by_the_ledger(spark, tmp_path):
    rows = [(i, [("human", f"q{i}"), ("gpt", f"r{i}")], f"a{i}", f"b{i}") for i in range(30)]
    wide = spark.createDataFrame(rows, f"original_idx bigint, conversations {C.CONVERSATION}, output_0 string, output_1 string")
    ledger = RunLedger(spark, str(tmp_path / "runs"))
    for backend in (models.DigestJudge(), models.RefusingJudge()):  # the second is never asked
        scores, failed = record_judge(ledger, wide, backend, "m")
        want, not_scored = run_judge(wide, models.DigestJudge())
        shown = ["original_idx", "question", F.to_json("scores")]
        assert scores.select(shown).exceptAll(want.select(shown)).count() == 0 and scores.count() == want.count()
        assert failed.select("prompt").exceptAll(not_scored.select("prompt")).count() == 0


def test_fingerprints(spark):
    df = spark.createDataFrame([(1, "a", {"k": "v"}), (2, None, None), (2, None, None)], "n int, t string, m map<string,string>")
    mark = content_fingerprint(df)
    assert mark == content_fingerprint(df.repartition(4))
    for other in (df.limit(2), df.withColumn("n", F.col("n") + 1), df.withColumnRenamed("n", "k"), df.distinct() if False else df.where("n = 2")):
        assert content_fingerprint(other) != mark
    assert content_fingerprint(df.limit(0)) == content_fingerprint(df.where("false"))
