import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyloom.functions import fixed_values as fixed
from replyloom.operators import analysis
from replyloom.sources import sinks

SCHEMA = (
    "original_idx bigint, output_idx int, question string, reference_answer string, model_answer string, "
    "scores struct<correctness:double,logic:double,clarity:double,completeness:double,total_score:double,brief_comment:string>"
)


def answer(question, output, total):
    return (question, output, f"q{question}", f"r{question}", f"answer {question}/{output}", (total / 2, total / 4, 1.0, 2.0, float(total), "ok"))


@pytest.fixture(scope="module")
def answers():
    """A third of all answers belong to question 0; totals repeat, some questions have one answer."""
    rng = random.Random(5)
    rows = [answer(0, i, rng.randint(0, 100)) for i in range(2000)]
    for q in range(1, 1000):
        rows += [answer(q, i, rng.choice([0, 10, 50, 50, 99, 100, 87.5])) for i in range(rng.randint(1, 7))]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def scored(spark, answers):
    return spark.createDataFrame(answers, SCHEMA).repartition(11).cache()


@pytest.fixture(scope="module")
def totals(answers):
    groups = {}
    for row in answers:
        groups.setdefault(row[0], []).append((row[5][4], row[1]))
    return groups


def test_best_worst(scored, totals):
    rows = analysis.best_worst(scored).withColumn("listed", analysis.list_scores(F.col("all_scores"))).collect()
    assert len(rows) == len(totals)
    for r in rows:
        # a stable descending sort of the answers in output order
        ranked = sorted(sorted(totals[r.original_idx], key=lambda t: t[1]), key=lambda t: -t[0])
        assert r.num_answers == len(ranked)
        assert (r.best_answer.scores.total_score, r.best_answer.output_idx) == ranked[0]
        assert (r.worst_answer.scores.total_score, r.worst_answer.output_idx) == ranked[-1]
        assert r.best_answer.answer == f"answer {r.original_idx}/{ranked[0][1]}"
        assert r.question == f"q{r.original_idx}" and r.reference_answer == f"r{r.original_idx}"
        assert r.score_range == ranked[0][0] - ranked[-1][0]
        assert r.listed == [t[0] for t in ranked]


def test_best_worst_without_list(scored, totals):
    narrow = analysis.best_worst(scored, all_scores=False)
    assert "all_scores" not in narrow.columns and narrow.count() == len(totals)
    whole = analysis.best_worst(scored).drop("all_scores")
    assert narrow.exceptAll(whole).count() == 0
    counts = {(r.original_idx, r.total_score): r.answers for r in analysis.score_counts(scored).collect()}
    assert counts == Counter((q, t[0]) for q, values in totals.items() for t in values)


def test_best_worst_with_copies(spark):
    """The same row several times counts as several answers and yields one result row."""
    rows = [answer(1, 0, 50)] * 3 + [answer(1, 1, 50)] * 2
    (r,) = analysis.best_worst(spark.createDataFrame(rows, SCHEMA)).collect()
    assert (r.num_answers, r.best_answer.output_idx, r.worst_answer.output_idx) == (5, 0, 1)
    assert [tuple(a) for a in r.all_scores] == [(50.0, 5)]


def test_summary_and_histogram(scored, totals, answers):
    best = [max(t)[0] for t in totals.values()]
    worst = [min(t)[0] for t in totals.values()]
    s = analysis.best_worst_summary(scored).first()
    assert s.total_questions == len(totals)
    assert s.avg_best_score == pytest.approx(statistics.mean(best))
    assert s.avg_score_range == pytest.approx(statistics.mean(b - w for b, w in zip(best, worst)))
    bins = {r.bin: (r.answers, r.percent) for r in analysis.score_histogram(scored).collect()}
    for b, (n, percent) in bins.items():
        assert n == sum(1 for a in answers if a[5][4] // 10 * 10 == b)
        assert percent == pytest.approx(100 * n / len(answers))
    assert bins[100][0] == sum(1 for a in answers if a[5][4] == 100)


def test_spread(scored, totals):
    detail = {r.original_idx: r for r in analysis.spread_detail(scored).collect()}
    wanted = {q: [x[0] for x in t] for q, t in totals.items() if len(t) >= 2}
    assert set(detail) == set(wanted)
    for q, values in wanted.items():
        r = detail[q]
        assert r.variance == max(values) - min(values) and r.num_answers == len(values)
        assert r.mean_score == pytest.approx(np.mean(values)) and r.std_score == pytest.approx(np.std(values))
    spreads = np.array([max(v) - min(v) for v in wanted.values()])
    spread = analysis.score_spread(scored)
    stats = analysis.spread_stats(spread).first()
    assert stats.total_questions == len(spreads)
    assert stats.mean_variance == pytest.approx(spreads.mean())
    assert stats.median_variance == pytest.approx(np.median(spreads))
    assert stats.std_variance == pytest.approx(spreads.std())
    for p in fixed.SPREAD_PERCENTILES:
        assert stats[f"p{p}"] == pytest.approx(np.percentile(spreads, p))
    assert analysis.spread_stats(spread, approximate=True).first().p50 == pytest.approx(np.median(spreads), abs=1)
    counts = [r.n for r in analysis.spread_histogram(spread).orderBy("bin").collect()]
    assert counts == list(np.histogram(spreads, bins=fixed.SPREAD_EDGES)[0])
    top = analysis.top_spread(spread).collect()
    ranked = sorted(((max(v) - min(v), q) for q, v in wanted.items()), key=lambda t: (-t[0], t[1]))
    cut = np.percentile(spreads, 90)
    assert [(r.variance, r.original_idx) for r in top] == [t for t in ranked if t[0] >= cut][:10]


@pytest.mark.parametrize("mean, p75, level, tight", [(9.9, 14.9, "low", True), (10, 15, "moderate", False), (20, 30, "high", False)])
def test_verdict(spark, mean, p75, level, tight):
    stats = spark.createDataFrame([(float(mean), float(p75))], "mean_variance double, p75 double")
    verdict = analysis.spread_verdict(stats).first()
    assert (verdict.consistency, verdict.p75_below_15) == (level, tight)


def test_aggregate_and_explode(spark, scored, totals):
    aggregated = analysis.aggregate_scores(scored, "out_").cache()
    for r in aggregated.collect():
        assert {k: v.total_score for k, v in r.scores.items()} == {f"out_{i}": t for t, i in totals[r.original_idx]}
        assert r.question == f"q{r.original_idx}"
    assert analysis.explode_scores(aggregated).count() == scored.count()
    context = scored.select("original_idx", "question", "reference_answer").distinct()
    narrow = analysis.aggregate_scores(scored.drop("question", "reference_answer"), "out_", context=context)
    key = ["original_idx", "question", "reference_answer"]
    shown = [*key, F.to_json("scores").alias("scores")]
    assert narrow.select(shown).exceptAll(aggregated.select(shown)).count() == 0 and narrow.count() == aggregated.count()
    t = analysis.evaluation_totals(aggregated).first()
    assert (t.samples, t.evaluations) == (len(totals), scored.count())
    twice = spark.createDataFrame([(*answer(1, 0, 90), 1), (*answer(1, 0, 20), 2)], SCHEMA + ", line int")
    (r,) = analysis.aggregate_scores(twice, order_by=["line"]).collect()
    assert r.scores["output_0"].total_score == 20.0


def test_output_stats_and_ranks(scored, answers):
    stats = analysis.output_stats(analysis.output_scores(scored)).cache()
    by_output = {}
    for a in answers:
        by_output.setdefault(f"output_{a[1]}", []).append(a[5])
    rows = {r.output_name: r for r in stats.collect()}
    assert set(rows) == set(by_output)
    for name in ("output_0", "output_3", "output_1999"):
        values = [s[4] for s in by_output[name]]
        r = rows[name]
        assert r.samples == len(values) and r.median_total == pytest.approx(np.median(values))
        assert r.std_total == pytest.approx(np.std(values)) and r.max_total == max(values)
        assert r.std_logic == pytest.approx(np.std([s[1] for s in by_output[name]]))
    ranked = analysis.rank_outputs(stats).orderBy("rank").collect()
    wanted = sorted(rows.values(), key=lambda r: (-r.mean_total, r.output_name))
    assert [r.output_name for r in ranked] == [r.output_name for r in wanted]
    assert [r["rank"] for r in ranked] == list(range(1, len(wanted) + 1))
    best = {r.dimension: r.output_name for r in analysis.best_per_dimension(stats).collect()}
    assert set(best) == set(fixed.DIMENSIONS)
    assert best["clarity"] == min(rows)  # all equal: the first name


def test_grade_bands(spark):
    rows = spark.createDataFrame([answer(1, i, t) for i, t in enumerate([0, 49.5, 50, 59, 69.9, 80, 90, 100])], SCHEMA)
    bands = analysis.grade_bands(rows).orderBy("bin").collect()
    assert [(r.label, r.n) for r in bands] == list(zip(fixed.GRADE_LABELS, [2, 2, 1, 0, 1, 2]))
    assert sum(r.percent for r in bands) == pytest.approx(100)


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert analysis.best_worst(empty).count() == 0
    assert analysis.best_worst_summary(empty).first().avg_best_score is None
    assert analysis.score_histogram(empty).count() == 0
    spread = analysis.score_spread(empty)
    stats = analysis.spread_stats(spread)
    assert stats.first().total_questions == 0 and stats.first().p90 is None
    assert analysis.spread_verdict(stats).first().consistency is None
    assert [r.n for r in analysis.spread_histogram(spread).collect()] == [0] * 9
    assert [r.percent for r in analysis.grade_bands(empty).collect()] == [None] * 6
    assert analysis.top_spread(spread).count() == 0
    totals = analysis.evaluation_totals(analysis.aggregate_scores(empty)).first()
    assert tuple(totals) == (0, 0, 0.0)
    assert analysis.rank_outputs(analysis.output_stats(analysis.output_scores(empty))).count() == 0


def test_samples_without_scores_count(spark):
    rows = spark.createDataFrame([(1, None)], f"original_idx bigint, scores {analysis._SCORES}")
    assert tuple(analysis.evaluation_totals(rows).first()) == (1, 0, 0.0)


def test_groupings_combine_before_the_shuffle(scored):
    for df in (analysis.best_worst(scored), analysis.score_spread(scored), analysis.aggregate_scores(scored)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan and "Window" not in plan and "CartesianProduct" not in plan


def test_csv(spark, tmp_path):
    rows = spark.createDataFrame([answer(1, 0, 50)], SCHEMA)
    odd = rows.withColumn("scores", F.col("scores").withField("brief_comment", F.lit('say "hi",\nthen')))
    path = str(tmp_path / "csv")
    sinks.scores_to_csv(analysis.aggregate_scores(odd), path)
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    assert back.columns == list(fixed.CSV_COLUMNS)
    assert back.first().brief_comment == 'say "hi",\nthen' and back.first().output_name == "output_0"
