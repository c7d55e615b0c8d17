import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyloom.operators import analysis
from replyloom.operators.quantiles import exact_quantiles

RANKS = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]


def test_a_million_different_values(spark):
    df = spark.range(1_000_000).select((F.xxhash64("id") / F.lit(1e15)).alias("v"))
    (found,) = exact_quantiles(df, "v", RANKS).collect()
    want = df.agg(F.percentile("v", F.array(*[F.lit(r) for r in RANKS]))).first()[0]
    assert found.n == 1_000_000 and found.quantiles == pytest.approx(want, rel=1e-12)


def test_groups_of_any_size(spark):
    r = random.Random(3)
    rows = [("hot", r.choice([0.0, 1.5, r.random()])) for _ in range(5000)]
    rows += [(g, r.gauss(0, 1)) for g in ("a", "b", None) for _ in range(r.randrange(1, 40))]
    rows += [("one", 7.25), ("none", None), ("two", 1.0), ("two", 2.0), ("same", 4.0), ("same", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    found = {row.g: row for row in exact_quantiles(df, "v", RANKS, ["g"]).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(found) == set(groups)
    for g, values in groups.items():
        assert found[g].n == len(values) and found[g].quantiles == pytest.approx(list(np.quantile(values, RANKS)))


def test_nothing_and_whole_numbers(spark):
    empty = spark.createDataFrame([], "v int, g string")
    assert exact_quantiles(empty, "v", RANKS).count() == 0 == exact_quantiles(empty, "v", RANKS, ["g"]).count()
    whole = spark.range(10).select(F.col("id").cast("int").alias("v"))
    assert exact_quantiles(whole, "v", [0.5, 0.95]).first().quantiles == pytest.approx([4.5, 8.55])


def test_no_buffer_grows_with_the_values(spark, grouped_columns):
    df = spark.range(1000).select(F.rand(1).alias("v"))
    plan = exact_quantiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString().lower()
    assert "percentile" not in plan and "collect_set" not in plan


def test_ranked_statistics_are_the_same(spark):
    spread = spark.range(3000).select(F.col("id").alias("original_idx"), (F.pmod(F.xxhash64("id"), F.lit(9973)) / 100.0).alias("variance"))
    for a, b in ((analysis.spread_stats(spread), analysis.spread_stats(spread, ranked=True)), (analysis.top_spread(spread), analysis.top_spread(spread, ranked=True))):
        rows = list(zip(a.collect(), b.collect(), strict=True))
        assert a.columns == b.columns and rows
        for x, y in rows:
            assert list(x) == pytest.approx(list(y))
    none = analysis.spread_stats(spread.limit(0), ranked=True).first()
    assert none.total_questions == 0 and none.p90 is None and analysis.top_spread(spread.limit(0), ranked=True).count() == 0
