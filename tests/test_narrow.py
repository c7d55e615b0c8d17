"""Groupings carry keys, positions and numbers; texts are fetched for the rows that were picked."""

from pyspark.sql import functions as F

from replyloom import materialize
from replyloom.functions import conversations as C
from replyloom.operators import analysis, matching
from replyloom.session import ROW, number_rows

TEXTS = {"question", "reference_answer", "model_answer", "conversations", "thinking_answer_text", "response", "_response", "_source"}
SCORED = (
    "original_idx bigint, output_idx int, question string, reference_answer string, model_answer string, "
    "scores struct<correctness:double,logic:double,clarity:double,completeness:double,total_score:double,brief_comment:string>"
)


def scored(spark):
    rows = [(q, i, f"q{q}", f"r{q}", f"a{q}/{i}", (1.0, 2.0, 3.0, 4.0, float((q * 7 + i * 3) % 5), "c")) for q in range(20) for i in range(4)]
    return materialize(spark.createDataFrame(rows, SCORED), "scored")


def test_no_text_below_an_aggregate(spark, grouped_columns):
    rows = scored(spark)
    context = rows.select("original_idx", "question", "reference_answer").where("output_idx = 0")
    for df in (
        analysis.best_worst(rows),
        analysis.best_worst(rows, all_scores=False),
        analysis.aggregate_scores(rows),
        analysis.aggregate_scores(rows, context=context),
    ):
        found = grouped_columns(df)
        assert "original_idx" in found and not found & TEXTS


def test_merges_group_no_text(spark, grouped_columns):
    turns = f"id string, conversations {C.CONVERSATION}, thinking_answer_text string"
    source = materialize(spark.createDataFrame([("a", [("human", "q")], "t"), ("a", [("human", "p")], "u"), ("b", [], "v")], turns), "source")
    output = materialize(spark.createDataFrame([("a", "x"), ("b", "y")], "id string, response string"), "output")
    scores = materialize(spark.createDataFrame([(1, "s")], "original_idx long, n string"), "scores")
    original = source.withColumn("original_idx", F.lit(1))
    for df in (matching.merge_stage1(source, output), matching.merge_stage2(source, output), matching.enrich_with_conversations(scores, original)):
        found = grouped_columns(df)
        assert ROW in found or "_hash" in found
        assert not found & TEXTS


def test_context_is_of_the_lowest_output(spark):
    rows = spark.createDataFrame([(1, 2, "late", "l", "a", None), (1, 0, "first", "f", "a", None), (1, 0, "first", "f", "b", None)], SCORED)
    assert [tuple(r) for r in analysis.context_of(rows).collect()] == [(1, "first", "f")]


def test_numbered_rows_are_written_once(spark):
    rows = number_rows(scored(spark).repartition(3), "numbered")
    assert rows.select(ROW).distinct().count() == 80
    assert number_rows(rows, "again") is rows
    assert rows.exceptAll(rows).count() == 0
