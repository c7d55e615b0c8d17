from pyspark.sql import functions as F

from replyloom.functions import conversations as C
from replyloom.operators import records

SCHEMA = f"id string, index string, line bigint, conversations {C.CONVERSATION}"


def conv(*turns):
    return [{"from": r, "value": v} for r, v in turns]


CONVS = {
    "null": None,
    "empty": [],
    "plain": conv(("system", "s"), ("human", " q "), ("gpt", "a")),
    "no human": conv(("system", "s"), ("gpt", "a")),
    "last empty": conv(("human", "first"), ("gpt", "a"), ("human", "  ")),
    "answer first": conv(("gpt", "a"), ("human", "q")),
    "spelled": conv((" User ", "q"), ("ASSISTANT\t", " a "), ("tool", "t")),
    "no value": conv(("human", None), ("gpt", None)),
    "holes": [None, *conv(("human", "q")), None, *conv((None, "x"), ("gpt", "a"))],
    "two answers": conv(("human", "q"), ("gpt", "one"), ("human", "r"), ("assistant", "two"), ("human", "z")),
}


def run(spark, function):
    rows = spark.createDataFrame([(k, None, 0, v) for k, v in CONVS.items()], SCHEMA)
    return {r.id: r.out for r in rows.select("id", function(F.col("conversations")).alias("out")).collect()}


def pairs(value):
    return [(m["from"], m["value"]) for m in value]


def test_last_messages(spark):
    question = run(spark, C.last_question)
    assert question == {
        "null": "", "empty": "", "plain": "q", "no human": "", "last empty": "", "answer first": "q",
        "spelled": "q", "no value": "", "holes": "q", "two answers": "z",
    }
    answer = run(spark, C.last_answer)
    assert answer["spelled"] == "a" and answer["two answers"] == "two" and answer["empty"] == ""


def test_keep_prompt_roles(spark):
    kept = {k: pairs(v) for k, v in run(spark, C.keep_prompt_roles).items()}
    assert kept["null"] == [] and kept["plain"] == [("system", "s"), ("human", " q ")]
    assert kept["spelled"] == [("human", "q")]
    assert kept["holes"] == [("human", "q")]


def test_replace_last_assistant(spark):
    out = {k: pairs(v) for k, v in run(spark, lambda c: C.replace_last_assistant(c, F.lit("new"))).items()
           if k != "holes"}
    assert out["null"] == [("gpt", "new")] == out["empty"]
    assert out["plain"] == [("system", "s"), ("human", " q "), ("gpt", "new")]
    assert out["answer first"] == [("gpt", "new"), ("human", "q")]
    assert out["last empty"] == [("human", "first"), ("gpt", "new"), ("human", "  ")]
    assert out["spelled"] == [(" User ", "q"), ("ASSISTANT\t", "new"), ("tool", "t")]
    assert out["two answers"][3] == ("assistant", "new") and out["two answers"][1] == ("gpt", "one")


def test_delivery_conversations(spark):
    out = {k: pairs(v) for k, v in run(spark, lambda c: C.delivery_conversations(c, F.lit("new"))).items()}
    assert out["null"] == [("gpt", "new")]
    assert out["spelled"] == [("human", "q"), ("gpt", "new")]
    assert out["no value"] == [("human", ""), ("gpt", "new")]


def test_normalize(spark):
    rows = spark.createDataFrame(
        [("i", "7", 1, CONVS["plain"]), (None, "7", 2, CONVS["plain"]), (None, None, 3, CONVS["plain"]), ("x", None, 4, CONVS["no human"]), ("y", None, 5, CONVS["last empty"])],
        SCHEMA,
    ).withColumn("other", F.lit("kept"))
    stage1 = records.normalize_stage1(rows)
    assert [r.id for r in stage1.orderBy("line").collect()] == ["i", None, None]
    assert records.normalize_stage1(rows, keep_id=False).columns == ["conversations"]
    stage2 = records.normalize_stage2(rows).orderBy("line").collect()
    assert [(r.id, r.question, r.thinking_answer_text, r.other) for r in stage2] == [
        ("i", "q", "a", "kept"), ("7", "q", "a", "kept"), ("line-3", "q", "a", "kept"),
    ]


def test_judge_context_takes_exact_roles(spark):
    rows = spark.createDataFrame(
        [("a", None, 0, CONVS["plain"]), ("b", None, 1, CONVS["spelled"]), ("c", None, 2, CONVS["answer first"])], SCHEMA
    )
    found = {r.id: (r.question, r.reference_answer) for r in records.judge_context(rows).collect()}
    assert found == {"a": ("[System Context]\ns\n\n[Question]\n q ", "a"), "c": ("q", "a")}


def test_prepare_judge_skips_missing_and_fills_slots_once(spark):
    rows = spark.createDataFrame(
        [(5, CONVS["answer first"], "{question}", "", None), (6, None, "x", "y", "z")],
        f"original_idx bigint, conversations {C.CONVERSATION}, output_0 string, output_1 string, output_3 string",
    )
    (row,) = records.prepare_judge(rows, 8, "output_", ("<", ">")).collect()
    assert (row.original_idx, row.output_idx, row.model_answer) == (5, 0, "{question}")
    assert row.prompt.startswith("<### Role\n") and row.prompt.endswith("above format.\n>")
    assert "**Model Response:**\n{question}\n" in row.prompt
    assert "**Question:**\nq\n\n**Reference Answer:**\na\n" in row.prompt
    assert '<result>\n{\n  "correctness": <integer from 0-50>,' in row.prompt
    report = records.prepare_report(records.prepare_judge(rows, 1)).first()
    assert (report.inputs, report.tasks, report.tasks_per_input) == (1, 1, 1.0)


def test_prepare_stages(spark):
    rows = spark.createDataFrame(
        [("a", None, 0, CONVS["plain"]), (None, None, 1, CONVS["two answers"]), ("c", None, 2, CONVS["last empty"])], SCHEMA
    )
    assert sorted(records.prepare_stage1(rows).collect()) == [("a", "q"), ("line-1", "z")]
    text = spark.createDataFrame(
        [("a", " q ", "<think>x</think> a b "), ("b", "", "t"), ("c", "q", None), ("d", "q", "<think>x</think>")],
        "id string, question string, thinking_answer_text string",
    )
    found = {r.id: r.prompt for r in records.prepare_stage2(text, lambda p: F.concat(F.lit("*"), p)).collect()}
    assert set(found) == {"a", "d"}
    assert found["a"].startswith("*Rewrite the following") and "Question:\nq\n\nContent to rewrite:\na b\n" in found["a"]
    assert found["a"].count("source length is about 2 chars") == 2
    assert found["a"].count("must be around 2 chars") == 2
    assert "source length is about 0 chars" in found["d"]


def test_split_by_think(spark):
    rows = spark.createDataFrame(
        [("p", "a</think>b</think> c"), ("p", "plain"), ("p", None)], "prompt string, response string"
    )
    tagged, plain = records.split_by_think(rows)
    assert [pairs(r.conversations) for r in tagged.collect()] == [[("system", ""), ("human", "p"), ("gpt", " c")]]
    assert [pairs(r.conversations)[2] for r in plain.collect()] == [("gpt", "plain")]
