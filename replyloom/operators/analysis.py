"""Statistics over validated scores.

Every grouping here has partial (map-side) aggregation, so one question or one output may
hold any share of the rows. Lists of scores are kept as ``(total_score, answers)`` counts:
repeated scores are counted before they are brought together. What still grows is said where
it does: with the number of *different* totals, exact percentiles and those lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed_values as fixed
from ..functions.scores import SCORE
from ..session import ROW, number_rows
from .quantiles import exact_quantiles

_SCORES = f"map<string,{SCORE}>"


def _total() -> Column:
    return F.col("scores.total_score")


# -- per question ---------------------------------------------------------------


def aggregate_scores(
    scored: DataFrame,
    prefix: str = "output_",
    order_by: Sequence[str] = (),
    context: DataFrame | None = None,
) -> DataFrame:
    """One row per question: a map from output name to scores.

    A repeated output takes its last scores in ``order_by``. Question and reference come
    from ``context`` (one row per ``original_idx``, such as
    :func:`~replyloom.operators.records.judge_context` of the source), without it from
    :func:`context_of` the rows themselves. Either way only scores are grouped.
    """
    if context is None:
        scored = number_rows(scored, "scored")
        context = context_of(scored)
    texts = ("question", "reference_answer")
    order = F.struct(*order_by, "scores")
    outputs = scored.groupBy("original_idx", "output_idx").agg(F.max_by("scores", order).alias("scores"))
    name = F.concat(F.lit(prefix), F.col("output_idx").cast("string"))
    entry = F.struct(name.alias("key"), F.col("scores").alias("value"))
    questions = outputs.groupBy("original_idx").agg(F.collect_list(entry).alias("entries"))
    scores = F.map_from_entries(F.array_sort("entries")).alias("scores")
    joined = questions.join(context.select("original_idx", *texts), "original_idx", "left")
    return joined.select("original_idx", *texts, scores)


def context_of(scored: DataFrame) -> DataFrame:
    """``original_idx, question, reference_answer`` as the lowest output of each question has them."""
    rows = number_rows(scored, "scored")
    lowest = rows.groupBy("original_idx").agg(F.min(F.struct("output_idx", ROW)).alias("lowest"))
    picked = lowest.select("original_idx", F.col(f"lowest.{ROW}").alias(ROW))
    return picked.join(rows.select(ROW, "question", "reference_answer"), ROW).drop(ROW)


def explode_scores(aggregated: DataFrame) -> DataFrame:
    """Scores map to one row per (question, output)."""
    return aggregated.select(
        "original_idx", F.explode("scores").alias("output_name", "score")
    ).select("original_idx", "output_name", "score.*")


def score_counts(scored: DataFrame) -> DataFrame:
    """``original_idx, total_score, answers``: how often each question got each total."""
    return scored.groupBy("original_idx", _total().alias("total_score")).agg(
        F.count(F.lit(1)).alias("answers")
    )


def score_runs(scored: DataFrame) -> DataFrame:
    """Per question all totals, descending, as ``all_scores: ARRAY<STRUCT<total_score, answers>>``.

    Equal totals are counted first, so the list has one entry per different total: at most
    101 for whole numbers. :func:`list_scores` spells it out; :func:`score_counts` has the
    same as rows, for totals with so many decimals that hardly two are equal.
    """
    return score_counts(scored).groupBy("original_idx").agg(
        F.sort_array(F.collect_list(F.struct("total_score", "answers")), asc=False).alias("all_scores")
    )


def list_scores(runs: Column) -> Column:
    """``all_scores`` counts as the plain descending list of totals."""
    return F.flatten(
        F.transform(runs, lambda r: F.array_repeat(r["total_score"], r["answers"].cast("int")))
    )


def _answer(output: str) -> Column:
    return F.struct(
        F.col(f"{output}.output_idx").alias("output_idx"),
        F.col(f"{output}.model_answer").alias("answer"),
        F.col(f"{output}.scores").alias("scores"),
    )


def best_worst(
    scored: DataFrame, order_by: Sequence[str] = ("output_idx",), all_scores: bool = True
) -> DataFrame:
    """Best and worst answer of each question, with all totals unless told not to.

    Among equal totals the best is the first and the worst the last in ``order_by``. Only
    totals, positions and row numbers are grouped; texts are fetched for the two rows of each
    question. For that the rows are written, unless :func:`~replyloom.session.number_rows` has
    done so before. ``all_scores`` has one entry per different total.
    """
    rows = number_rows(scored, "scored")
    position = F.struct(*order_by, ROW)
    narrow = rows.select("original_idx", _total().alias("total_score"), position.alias("position"))
    if all_scores:
        per_total = narrow.groupBy("original_idx", "total_score").agg(
            F.min("position").alias("first"), F.max("position").alias("last"), F.count(F.lit(1)).alias("answers")
        )
        runs = F.sort_array(F.collect_list(F.struct("total_score", "answers")), asc=False)
        ends = per_total.groupBy("original_idx").agg(
            F.max_by("first", "total_score").alias("best"),
            F.min_by("last", "total_score").alias("worst"),
            F.sum("answers").alias("num_answers"),
            runs.alias("all_scores"),
        )
    else:
        order = F.struct(-F.col("total_score"), "position")
        ends = narrow.groupBy("original_idx").agg(
            F.min_by("position", order).alias("best"),
            F.max_by("position", order).alias("worst"),
            F.count(F.lit(1)).alias("num_answers"),
        )
    answer = F.struct("output_idx", "model_answer", "scores")
    best = rows.select(F.col(ROW).alias("_best"), "question", "reference_answer", answer.alias("best"))
    worst = rows.select(F.col(ROW).alias("_worst"), answer.alias("worst"))
    listed = ["all_scores"] if all_scores else []
    ends = ends.select(
        "original_idx", "num_answers", *listed, F.col(f"best.{ROW}").alias("_best"), F.col(f"worst.{ROW}").alias("_worst")
    )
    return ends.join(best, "_best").join(worst, "_worst").select(
        "original_idx",
        "question",
        "reference_answer",
        "num_answers",
        _answer("best").alias("best_answer"),
        _answer("worst").alias("worst_answer"),
        (F.col("best.scores.total_score") - F.col("worst.scores.total_score")).alias("score_range"),
        *listed,
    )


def question_ranges(scored: DataFrame) -> DataFrame:
    """Per question: number of answers, best and worst total, their difference."""
    return (
        scored.groupBy("original_idx")
        .agg(
            F.count(F.lit(1)).alias("num_answers"),
            F.max(_total()).alias("best_score"),
            F.min(_total()).alias("worst_score"),
        )
        .withColumn("score_range", F.col("best_score") - F.col("worst_score"))
    )


def best_worst_summary(scored: DataFrame) -> DataFrame:
    """One row: questions, mean best, mean worst and mean range."""
    return question_ranges(scored).agg(
        F.count(F.lit(1)).alias("total_questions"),
        F.avg("best_score").alias("avg_best_score"),
        F.avg("worst_score").alias("avg_worst_score"),
        F.avg("score_range").alias("avg_score_range"),
    )


def score_histogram(scored: DataFrame, width: int = 10) -> DataFrame:
    """Answers per bin of ``width`` points, with their share of all answers in percent."""
    bins = scored.groupBy((F.floor(_total() / width) * width).alias("bin")).agg(
        F.count(F.lit(1)).alias("answers")
    )
    # At most 100 / width + 1 rows reach this window.
    everything = F.sum("answers").over(Window.partitionBy())
    return bins.withColumn("percent", F.col("answers") * 100.0 / everything)


# -- spread ---------------------------------------------------------------------


def score_spread(scored: DataFrame) -> DataFrame:
    """Per question with two or more answers: totals' max, min, difference, mean, deviation."""
    return (
        scored.groupBy("original_idx")
        .agg(
            F.count(F.lit(1)).alias("num_answers"),
            F.max(_total()).alias("max_score"),
            F.min(_total()).alias("min_score"),
            F.avg(_total()).alias("mean_score"),
            F.stddev_pop(_total()).alias("std_score"),
        )
        .where(F.col("num_answers") >= 2)
        .withColumn("variance", F.col("max_score") - F.col("min_score"))
    )


def spread_detail(scored: DataFrame) -> DataFrame:
    """:func:`score_spread` with the totals of each question, all from the counted totals."""
    runs = score_runs(scored)
    zero = F.lit(0.0)
    answers = F.aggregate("all_scores", F.lit(0).cast("bigint"), lambda a, r: a + r["answers"])
    total = F.aggregate("all_scores", zero, lambda a, r: a + r["total_score"] * r["answers"])
    averaged = runs.withColumns({"num_answers": answers, "_total": total}).withColumn(
        "mean_score", F.col("_total") / F.col("num_answers")
    )
    mean = F.col("mean_score")
    squares = F.aggregate(
        "all_scores", zero, lambda a, r: a + F.pow(r["total_score"] - mean, 2.0) * r["answers"]
    )
    highest = F.try_element_at("all_scores", F.lit(1))["total_score"]
    lowest = F.try_element_at("all_scores", F.lit(-1))["total_score"]
    return averaged.where(F.col("num_answers") >= 2).select(
        "original_idx",
        "num_answers",
        highest.alias("max_score"),
        lowest.alias("min_score"),
        "mean_score",
        F.sqrt(squares / F.col("num_answers")).alias("std_score"),
        (highest - lowest).alias("variance"),
        "all_scores",
    )


def spread_stats(spread: DataFrame, approximate: bool = False, ranked: bool = False) -> DataFrame:
    """One row over all spreads: count, mean, median, deviation, min, max, percentiles.

    The exact percentiles interpolate linearly; their buffer counts equal values, so it
    grows with the number of different spreads, not of questions. ``ranked`` gives the same
    values without a buffer, by :func:`~replyloom.operators.quantiles.exact_quantiles`, for
    scores with many decimals; ``approximate`` bounds the buffer.
    """
    ranks = [p / 100 for p in fixed.SPREAD_PERCENTILES]
    if ranked:
        found = exact_quantiles(spread, "variance", ranks).select("quantiles").scalar()
    elif approximate:
        found = F.percentile_approx("variance", ranks, 10_000)
    else:
        found = F.percentile("variance", F.array(*[F.lit(r) for r in ranks]))
    stats = spread.agg(
        F.count(F.lit(1)).alias("total_questions"),
        F.avg("variance").alias("mean_variance"),
        F.stddev_pop("variance").alias("std_variance"),
        F.min("variance").alias("min_variance"),
        F.max("variance").alias("max_variance"),
        *([] if ranked else [found.alias("found")]),
    )
    if ranked:
        stats = stats.withColumn("found", found)
    percentiles = [
        F.col("found")[i].alias(f"p{p}") for i, p in enumerate(fixed.SPREAD_PERCENTILES)
    ]
    median = F.col("found")[fixed.SPREAD_PERCENTILES.index(50)].alias("median_variance")
    return stats.select(
        "total_questions",
        "mean_variance",
        median,
        "std_variance",
        "min_variance",
        "max_variance",
        *percentiles,
    )


def _binned(df: DataFrame, value: Column, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Rows per bin, empty bins included; a bin holds its lower edge, the last also its upper.

    All bins are counted in one aggregation without keys and then unfolded.
    """
    last = len(labels) - 1
    counts = []
    for i, label in enumerate(labels):
        below = value <= edges[i + 1] if i == last else value < edges[i + 1]
        counts.append(F.count_if((value >= edges[i]) & below).alias(f"n{i}"))
    bins = [
        F.struct(F.lit(i).alias("bin"), F.lit(label).alias("label"), F.col(f"n{i}").alias("n"))
        for i, label in enumerate(labels)
    ]
    total = F.count(value).alias("total")
    counted = df.agg(total, *counts).select("total", F.inline(F.array(*bins)))
    return counted.withColumn("percent", F.try_divide(F.col("n") * 100.0, F.col("total"))).drop("total")


def spread_histogram(spread: DataFrame) -> DataFrame:
    """Questions per spread bin with their share in percent."""
    edges = fixed.SPREAD_EDGES
    labels = [f"{low}-{high}" for low, high in zip(edges, edges[1:])]
    return _binned(spread, F.col("variance"), edges, labels)


def grade_bands(scored: DataFrame) -> DataFrame:
    """Answers per grade with their share in percent."""
    return _binned(scored, _total(), fixed.GRADE_EDGES, fixed.GRADE_LABELS)


def spread_verdict(stats: DataFrame) -> DataFrame:
    """Verdict on :func:`spread_stats`: level of the mean, and whether p75 is tight."""
    mean = F.col("mean_variance")
    level = (
        F.when(mean < fixed.LOW_SPREAD, "low")
        .when(mean < fixed.MODERATE_SPREAD, "moderate")
        .when(mean.isNotNull(), "high")
    )
    return stats.select(
        "mean_variance",
        level.alias("consistency"),
        "p75",
        (F.col("p75") < fixed.TIGHT_P75).alias("p75_below_15"),
    )


def spread_report(spread: DataFrame, approximate: bool = False) -> DataFrame:
    """The whole report as rows of one output: ``section`` (statistics, distribution, details)
    and ``entry``, a JSON object. There is one detail per question."""
    sections = {
        "statistics": spread_stats(spread, approximate),
        "distribution": spread_histogram(spread),
        "details": spread,
    }
    rows = [
        df.select(F.lit(name).alias("section"), F.to_json(F.struct("*")).alias("entry"))
        for name, df in sections.items()
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


def top_spread(
    spread: DataFrame, k: int = 10, pct: float = 0.9, approximate: bool = False, ranked: bool = False
) -> DataFrame:
    """The ``k`` widest questions among those at or above the ``pct`` percentile.

    ``approximate`` and ``ranked`` are as in :func:`spread_stats`.
    """
    if ranked:
        threshold = exact_quantiles(spread, "variance", [pct]).select(F.col("quantiles")[0]).scalar()
    else:
        exact = F.percentile("variance", F.lit(pct))
        found = F.percentile_approx("variance", pct, 10_000) if approximate else exact
        threshold = spread.agg(found).scalar()
    return (
        spread.where(F.col("variance") >= threshold)
        .orderBy(F.desc("variance"), "original_idx")
        .limit(k)
    )


# -- per output -----------------------------------------------------------------


def output_scores(scored: DataFrame, prefix: str = "output_") -> DataFrame:
    """Scored rows under their output name, one column per score."""
    name = F.concat(F.lit(prefix), F.col("output_idx").cast("string"))
    return scored.select("original_idx", name.alias("output_name"), "scores.*")


def output_stats(rows: DataFrame, approximate: bool = False, ranked: bool = False) -> DataFrame:
    """Statistics per output name, from :func:`explode_scores` or :func:`output_scores`.

    The exact median's buffer grows with the number of different totals; ``ranked`` and
    ``approximate`` are as in :func:`spread_stats`.
    """
    if ranked:
        medians = exact_quantiles(rows, "total_score", [0.5], ["output_name"])
        medians = medians.select("output_name", F.col("quantiles")[0].alias("median_total"))
        others = output_stats(rows, approximate=True).drop("median_total")
        return others.join(medians, "output_name", "left")
    median = F.percentile_approx("total_score", 0.5, 10_000) if approximate else F.median("total_score")
    dims = []
    for dim in fixed.DIMENSIONS:
        dims += [F.avg(dim).alias(f"mean_{dim}"), F.stddev_pop(dim).alias(f"std_{dim}")]
    return rows.groupBy("output_name").agg(
        F.count(F.lit(1)).alias("samples"),
        F.avg("total_score").alias("mean_total"),
        median.alias("median_total"),
        F.stddev_pop("total_score").alias("std_total"),
        F.max("total_score").alias("max_total"),
        F.min("total_score").alias("min_total"),
        *dims,
    )


def evaluation_totals(aggregated: DataFrame) -> DataFrame:
    """One row: samples, evaluations, evaluations per sample (0 if there are none)."""
    counted = aggregated.agg(
        F.count(F.lit(1)).alias("samples"),
        F.coalesce(F.sum(F.size(F.coalesce("scores", F.create_map().cast(_SCORES)))), F.lit(0)).alias(
            "evaluations"
        ),
    )
    per_sample = F.try_divide(F.col("evaluations"), F.col("samples"))
    return counted.withColumn("per_sample", F.coalesce(per_sample, F.lit(0.0)))


def rank_outputs(stats: DataFrame) -> DataFrame:
    """Outputs by mean total, descending; equal means in name order, ranks without gaps."""
    # One row per output name: the window sees as many rows as there are outputs.
    order = Window.partitionBy().orderBy(F.desc("mean_total"), "output_name")
    return stats.select(F.row_number().over(order).alias("rank"), "output_name", "mean_total")


def best_per_dimension(stats: DataFrame) -> DataFrame:
    """For each dimension the output with the highest mean; equal means: first name."""
    means = [
        F.struct(F.lit(dim).alias("dimension"), F.col(f"mean_{dim}").alias("mean"))
        for dim in fixed.DIMENSIONS
    ]
    rows = stats.select("output_name", F.inline(F.array(*means)))
    best = rows.groupBy("dimension").agg(
        F.min(F.struct((-F.col("mean")).alias("descending"), "output_name")).alias("best")
    )
    return best.select(
        "dimension", "best.output_name", (-F.col("best.descending")).alias("mean")
    )
