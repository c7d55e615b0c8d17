import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from replyloom.functions import fixed_values as fixed
from replyloom.functions import scores as S
from replyloom.functions.text import strip_think_tokens
from replyloom.operators import analysis, scoring

GOOD = '{"correctness": 40, "logic": 20, "clarity": 10, "completeness": 8, "total_score": 78}'


def with_value(name, value):
    return GOOD.replace(f'"{name}": {json.loads(GOOD)[name]}', f'"{name}": {value}')


def without(name):
    score = json.loads(GOOD)
    del score[name]
    return json.dumps(score)


@pytest.fixture(scope="module")
def scored(spark):
    def run(texts, mode):
        rows = spark.createDataFrame(list(enumerate(texts)), "original_idx bigint, response string")
        rows = rows.withColumn("output_idx", F.lit(0))
        found = scoring.score_responses(rows, mode).orderBy("original_idx").collect()
        return [r.error if r.error else r.scores.total_score for r in found]

    return run


def test_strict_json_agrees_with_python(column):
    texts = [
        GOOD, GOOD + " tail", GOOD + "}", GOOD + "}] }", GOOD + GOOD, GOOD + "," + GOOD, GOOD + ', "x"]',
        '{"a": 1, "a": 2}', GOOD[:-3], GOOD.replace('"', "'"), '{"a": 01}', '{"a": 1,}', "{}", "[1]", "3",
        '"s"', "null", "", " " + GOOD + "\n", '{"a": "x\ny"}', '{"a": "\\u4e2d"}', "{a: 1}", '{"a": .5}',
        '{"a": 1e3}', '{"a": -0}', "/* c */ {}", "{} // c", '{"a": [1, [2, {"b": null}]]}', " {}", "tru",
    ]

    def loads(text):
        try:
            return True if json.loads(text) is not None or text else False
        except json.JSONDecodeError:
            return False

    assert column(lambda c: S.strict_json(c).isNotNull(), texts) == [loads(t) for t in texts]
    last = column(lambda c: F.try_variant_get(S.strict_json(c), "$.a", "int"), ['{"a": 1, "a": 2}'])
    assert last == [2]


def test_strict_json_on_mutations(column):
    rng = random.Random(3)
    texts = []
    for _ in range(3000):
        chars = list(GOOD)
        for _ in range(rng.randint(0, 3)):
            spot = rng.randrange(len(chars))
            chars[spot : spot + rng.randint(0, 2)] = rng.choice(['"', "{", "}", ",", ":", "1", " ", "]", ""])
        texts.append("".join(chars))

    def loads(text):
        try:
            json.loads(text)
            return True
        except json.JSONDecodeError:
            return False

    assert column(lambda c: S.strict_json(c).isNotNull(), texts) == [loads(t) for t in texts]


STRICT, ROBUST = fixed.NO_SCORE_STRICT, fixed.NO_SCORE_ROBUST

# response, strict outcome, robust outcome
CASES = [
    (f"<result>{GOOD}</result>", 78.0, 78.0),
    (f"<result> \n{GOOD} 　</result>", 78.0, 78.0),
    (GOOD, 78.0, 78.0),
    (f"<think>x {{y}}</think>\n\n<result>{GOOD}</result>", 78.0, 78.0),
    ("no score at all", STRICT, ROBUST),
    ("", STRICT, ROBUST),
    (None, STRICT, ROBUST),
    (with_value("correctness", 51), "correctness out of range [0, 50]: 51", "correctness out of range"),
    (with_value("total_score", 100.5), "total_score out of range [0, 100]: 100.5", "total_score out of range"),
    (with_value("logic", -1), "logic out of range [0, 25]: -1", "logic out of range"),
    (without("clarity"), "Missing field: clarity", "Missing field: clarity"),
    (with_value("logic", '"20"'), "logic is not a number: 20", "logic is not a number"),
    (with_value("logic", "null"), "logic is not a number: None", "logic is not a number"),
    (with_value("logic", "[2]"), "logic is not a number: [2]", "logic is not a number"),
    (with_value("logic", "true"), 78.0, 78.0),
    (with_value("total_score", "77.5"), 77.5, 77.5),
    (f"before {GOOD} after", 78.0, 78.0),
    (GOOD + " and " + with_value("total_score", 1), 78.0, 78.0),
    (f'<result>{{"correctness": }}</result>{GOOD}', STRICT, 78.0),
    (f"<result>{GOOD}", 78.0, 78.0),
    (GOOD[:-1] + ', "brief_comment": "a {b} c"} and prose', STRICT, 78.0),
    (f"prose\n\n{GOOD}\n\nprose", 78.0, ROBUST),
    (f"<result>{without('correctness')}</result>{GOOD}", "Missing field: correctness", "Missing field: correctness"),
    ('{"total_score": 5}', STRICT, "Missing field: correctness"),
    ('{"note": 1} text {"total_score": 5}', STRICT, "Missing field: correctness"),
    ('{"note": 1}', STRICT, ROBUST),
    (GOOD.replace('"correctness": 40', '"correctness": NaN'), STRICT, ROBUST),
    ('{ "correctness" : 50, "x": {}} {"total_score": 7}', STRICT, "Missing field: correctness"),
    (GOOD[:-1] + ', "correctness": 99}', "correctness out of range [0, 50]: 99", "correctness out of range"),
]


@pytest.mark.parametrize("mode, spot", [("strict", 1), ("robust", 2)])
def test_outcomes(scored, mode, spot):
    found = scored([c[0] for c in CASES], mode)
    wrong = [(c[0], c[spot], f) for c, f in zip(CASES, found) if c[spot] != f]
    assert not wrong


def test_column_functions_agree_with_operator(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "original_idx int, response string")
    for mode, extract in (("strict", S.extract_score_strict), ("robust", S.extract_score_robust)):
        operator = scoring.score_responses(rows, mode)
        direct = operator.select(
            F.to_json("extracted").alias("a"),
            F.to_json(extract(F.col("response"))).alias("b"),
            "error",
            S.validate_scores(F.col("extracted"), mode == "strict").alias("v"),
        )
        for r in direct.collect():
            assert r.a == r.b and r.error == r.v.error and r.v.ok == (r.error is None)


def test_missing_fields_come_before_ranges(scored):
    bad = with_value("correctness", 99).replace('"total_score": 78', '"t": 78')
    assert scored([bad], "robust") == ["Missing field: total_score"]


def test_failed_rows(spark):
    rows = spark.createDataFrame(
        [(1, 0, "中" * 300), (1, 1, with_value("logic", '"x"')), (1, 2, GOOD), (2, 0, None)],
        "original_idx bigint, output_idx int, response string",
    ).withColumn("file", F.lit("f")).withColumn("line", F.col("output_idx"))
    ok, failed = scoring.split_ok_failed(scoring.score_responses(rows))
    found = {(r.original_idx, r.output_idx): r for r in failed.collect()}
    assert set(found) == {(1, 0), (1, 1), (2, 0)}
    assert found[1, 0].response_preview == "中" * 200 and found[1, 0].extracted_score is None
    assert found[1, 1].response_preview is None and json.loads(found[1, 1].extracted_score)["logic"] == "x"
    assert found[2, 0].response_preview == "" and found[2, 0].line == 1
    assert [r.output_idx for r in ok.collect()] == [2] and "response" not in ok.columns


def test_run_report_of_nothing(spark):
    empty = spark.createDataFrame([], "original_idx bigint, response string")
    report = scoring.run_report(scoring.score_responses(empty)).first()
    assert (report.total, report.success, report.success_rate) == (0, 0, None)


def test_each_text_is_searched_once(spark):
    """Filters on the outcome must not bring a second copy of the search."""
    rows = spark.createDataFrame([(1, GOOD)], "original_idx bigint, response string")
    plan = scoring.ok_rows(scoring.score_responses(rows))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(re.escape("<think>.*?</think>"), plan)) == 1
    assert plan.count("parseJson") == 3  # tag, braces, scan


def test_best_and_worst_come_from_one_search(spark):
    """Texts are searched by the job that writes the rows, and by no other."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def step(text):
        seen.add(1)
        return text

    names = "original_idx bigint, output_idx int, question string, reference_answer string, model_answer string, response string"
    rows = spark.createDataFrame([(1, 0, "q", "r", "m", GOOD)], names).withColumn("response", step.asNondeterministic()("response"))
    found = analysis.best_worst(scoring.ok_rows(scoring.score_responses(rows)))
    assert "<think>" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.first().num_answers == 1 and found.count() == 1 and seen.value == 1


@pytest.mark.parametrize(
    "piece",
    ["<result>{ ", '{"correctness": 1 ', "<think> x", "<|begin_of_thought|> ", '{ "total_score" ', "<result> ", "</result>{", "} \n\n", '"correctness"{'],
)
def test_texts_without_ends_stay_linear(spark, piece):
    """A megabyte of openings that nothing closes, and the same with one late close."""
    text = piece * (1_000_000 // len(piece))
    rows = [(text,), (text + "</result>",), (text + "} </result>",), (text + "</think>",)]
    df = spark.createDataFrame(rows, "response string").repartition(4)
    start = time.perf_counter()
    for mode in ("strict", "robust"):
        assert scoring.score_responses(df, mode).where("error is null").count() == 0
    df.select(F.length(strip_think_tokens(F.col("response")))).collect()
    assert time.perf_counter() - start < 60
